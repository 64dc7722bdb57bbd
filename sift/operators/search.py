"""Keyword search over the TF-IDF index.

The reference answers one query per web request: tokens -> songs holding at
least ``need`` of them (1 for OR, all for AND) -> total score of each such
song -> names -> ordered view -> pages of 20. Here the same plan runs for a
whole table of queries in one job:

    queries --tokens--> (query_id, token, need)
       join index on token          (frequent tokens salted; small query side broadcast by AQE)
       group by (query_id, song)    (partial aggregate; count >= need)
       join song totals on song     (query-independent, precomputed)
       keep songs that have names   (semi-join on the id)
       rank within query            (range-partitioned, skew-safe; a page: top k per query)
       join names on song           (last, for the rows shown; joined once at build)

Semantics kept from the reference: a song's score is the sum of *all* its
token scores (``score_scope='document'``); any mode other than ``and`` is OR;
songs without an artist row are dropped by the inner joins; the result count
ignores null song names. Deliberate differences: AND uses distinct query
tokens, apostrophes are not doubled, an empty token list gives an empty
result, and ties are broken by song id.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import paging
from ..functions.text import explode_terms, query_tokens
from .ranking import rank_within
from .skew import salted_join, split_hot_join

if TYPE_CHECKING:
    from .ranked import RankedIndex

SCORE_DIGITS = 6


def result_order() -> list[Column]:
    """O1: best score first, ties by song id."""
    return [F.desc("score"), F.asc("song_id")]


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, need, token) from (query_id, text, mode)."""
    toks = queries.select("query_id", "mode",
                          F.array_distinct(query_tokens(F.col("text"))).alias("tokens"))
    need = F.when(F.col("mode") == "and", F.size("tokens")).otherwise(F.lit(1))
    return explode_terms(toks.select("query_id", need.cast("long").alias("need"), "tokens"),
                         F.col("tokens"), "token", "query_id", "need")


def match(scores: DataFrame, terms: DataFrame, totals: DataFrame | None = None,
          score_scope: str = "document", frequencies: DataFrame | None = None) -> DataFrame:
    """(query_id, song_id, score) for songs holding >= need query tokens.

    ``score_scope='document'`` scores a song by all its tokens (the
    reference); ``'query'`` by the matched tokens only. With the stored
    ``frequencies`` the postings of frequent tokens are salted, so a token in
    most songs does not meet in one task when the terms are too many to
    broadcast.
    """
    if frequencies is None:
        hits = scores.join(terms, "token")
    else:
        hits = salted_join(scores, terms, "token", frequencies, "df", "song_id",
                           max_hot=1000, salts=16)
    grouped = (hits.groupBy("query_id", "song_id", "need")
               .agg(F.count(F.lit(1)).alias("matched"), F.sum("score").alias("qscore"))
               .where(F.col("matched") >= F.col("need")))
    if score_scope == "query":
        return grouped.select("query_id", "song_id", F.col("qscore").alias("score"))
    if totals is None:
        raise ValueError("score_scope='document' needs the song totals")
    return (grouped.select("query_id", "song_id")
            .join(totals, "song_id")
            .select("query_id", "song_id", F.col("total").alias("score")))


def name_table(songs: DataFrame, artists: DataFrame) -> DataFrame:
    """J3, J4 done once: (song_id, song, artist_name, page_link).

    The song -> artist join is inner (songs without an artist row drop out,
    as in the reference). One artist may own a large share of all songs, so
    the join goes through ``split_hot_join`` weighted by songs per artist.
    Built with the index, it leaves searches a single join on the unique
    song id.
    """
    per_artist = songs.groupBy("artist_id").agg(F.count(F.lit(1)).alias("_n_songs"))
    weighted = artists.join(per_artist, "artist_id")
    return (split_hot_join(songs, weighted, "artist_id", "_n_songs")
            .select("song_id", F.col("song_name").alias("song"), "artist_name", "page_link"))


def with_names(matched: DataFrame, names: DataFrame) -> DataFrame:
    """Attach song name, artist name and link to rows with a song id."""
    return matched.join(names, "song_id").select(
        "query_id", "song_id", "song", "artist_name", "page_link",
        *[c for c in matched.columns if c not in ("query_id", "song_id")])


def search_batch(scores: DataFrame, totals: DataFrame, names: DataFrame,
                 queries: DataFrame,
                 score_scope: str = "document",
                 num_queries: int | None = None,
                 frequencies: DataFrame | None = None,
                 by_rank: Callable[[], RankedIndex] | None = None) -> DataFrame:
    """Ranked results of every query in ``queries`` (query_id, text, mode).

    Scores are rounded to 6 digits before ranking, so ordering does not
    depend on the summation order of floating-point partial sums. Only ids
    and scores are ranked; the names follow.

    Every (query, song, token) met is a row here, and every result is sorted.
    With ``by_rank``, which opens the rank-ordered postings of the same songs,
    document scores are read from bitmaps in rank order instead
    (``ranked.results``); rows that share their query's id still go this way.
    """
    if by_rank is not None and score_scope == "document":
        from . import ranked as in_rank_order
        asked = queries.groupBy("query_id").agg(F.count(F.lit(1)).alias("asked"))
        once = in_rank_order.results(by_rank(), queries.join(asked.where("asked = 1"), "query_id", "left_semi"))
        again = queries.join(asked.where("asked > 1"), "query_id", "left_semi")
        if again.isEmpty():
            return once
        return once.unionByName(search_batch(scores, totals, names, again, num_queries=num_queries,
                                             frequencies=frequencies))
    ranked = rank_within(batch_matches(scores, totals, names, queries, score_scope, frequencies),
                         "query_id", result_order(), num_groups=num_queries)
    return with_names(ranked, names)


def batch_matches(scores: DataFrame, totals: DataFrame, names: DataFrame,
                  queries: DataFrame, score_scope: str = "document",
                  frequencies: DataFrame | None = None) -> DataFrame:
    """(query_id, song_id, score) of every query, of songs that have names;
    not yet ranked or named (enough for result counts)."""
    matched = match(scores, query_terms(queries), totals, score_scope, frequencies)
    return (matched.join(names.select("song_id"), "song_id", "left_semi")
            .select("query_id", "song_id", F.round("score", SCORE_DIGITS).alias("score")))


def batch_page(matches: DataFrame, names: DataFrame, page_num: int,
               size: int = paging.PAGE_SIZE) -> DataFrame:
    """O2, O3, R2 for a batch: one page of every query, without ranking the
    rest. Spark cuts each task's rows to the first ``page_num * size`` of a
    query before the shuffle, so a query that matches everything is safe."""
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(*result_order()))
    ranked = matches.withColumn("rank", place).where(F.col("rank") <= page_num * size)
    return with_names(page(ranked, page_num, size), names)


def result_counts(matches: DataFrame, names: DataFrame) -> DataFrame:
    """A5: (query_id, num_results), counting songs with a non-null name."""
    named = names.where(F.col("song").isNotNull()).select("song_id")
    return (matches.join(named, "song_id", "left_semi")
            .groupBy("query_id").agg(F.count(F.lit(1)).alias("num_results")))


def page(results: DataFrame, page_num: Column | int, size: int = paging.PAGE_SIZE) -> DataFrame:
    """O2, O3: rows of page ``page_num`` (1-based) of each query, by rank.

    On a written result snapshot this is a filter on ``rank`` that the scan
    evaluates; no sort is needed because the rank is stored.
    """
    p = F.lit(page_num) if isinstance(page_num, int) else page_num
    lo = (p - 1) * size
    return results.where((F.col("rank") > lo) & (F.col("rank") <= lo + size))


def page_info(requests: DataFrame, counts: DataFrame) -> DataFrame:
    """Paging state for (query_id, page) requests given result counts.

    Queries without results count 0 (left join), as the reference shows an
    empty page for them.
    """
    joined = (requests.join(counts, "query_id", "left")
              .withColumn("num_results", F.coalesce("num_results", F.lit(0)).cast("long")))
    n, p = F.col("num_results"), F.col("page").cast("long")
    rng = paging.result_range(n, p)
    return joined.select(
        "query_id", p.alias("page"), n.alias("num_results"),
        paging.num_pages(n).alias("num_pages"),
        paging.prev_valid(p).alias("prev_valid"),
        paging.next_valid(n, p).alias("next_valid"),
        rng["first"].alias("first_result"), rng["last"].alias("last_result"),
        paging.page_list(n, p).alias("page_list"))


def single_query_terms(spark: SparkSession, query: str, mode: str) -> tuple[list[str], int]:
    """Tokens of one interactive query (bounded by the query's length)."""
    q = spark.createDataFrame([(query,)], "text string")
    row = q.select(F.array_distinct(query_tokens(F.col("text"))).alias("t")).first()
    tokens = list(row["t"]) if row and row["t"] else []
    need = len(tokens) if mode == "and" else 1
    return tokens, need


def search_one(spark: SparkSession, scores: DataFrame, totals: DataFrame,
               names: DataFrame, query: str, mode: str,
               score_scope: str = "document") -> DataFrame:
    """One query, as the web layer asks it: the token list is pushed into the
    index scan as ``token IN (...)`` (P4), so parquet skips row groups whose
    token range misses every query token. Result: (song_id, song,
    artist_name, page_link, score), unranked; order with
    ``orderBy(desc('score'), 'song_id')`` and take a page with offset/limit."""
    tokens, need = single_query_terms(spark, query, mode)
    terms = spark.createDataFrame([(0, need, t) for t in tokens],
                                  "query_id long, need long, token string")
    pruned = scores.where(F.col("token").isin(tokens))
    matched = match(pruned, terms, totals, score_scope)
    return (with_names(matched, names)
            .withColumn("score", F.round("score", SCORE_DIGITS))
            .drop("query_id"))


def ordered_page(results: DataFrame, page_num: int, size: int = paging.PAGE_SIZE) -> DataFrame:
    """O2/O3 without a stored rank: top-k with offset (TakeOrderedAndProject)."""
    return (results.orderBy(F.desc("score"), F.asc("song_id"))
            .offset((page_num - 1) * size).limit(size))


def write_snapshot(results: DataFrame, path: str) -> None:
    """Store ranked results for paging.

    Each file is sorted by (query, rank), so parquet min/max statistics let a
    page read skip the row groups of other queries and ranks.
    Unlike the reference's single global view, one snapshot holds many
    queries and concurrent users do not overwrite each other.
    """
    results.sortWithinPartitions("query_id", "rank").write.mode("overwrite").parquet(path)


def read_page(spark: SparkSession, path: str, query_id: int, page_num: int,
              size: int = paging.PAGE_SIZE) -> DataFrame:
    """O2/O3 on a snapshot: ``query_id = q AND rank IN (lo, hi]`` is pushed
    to the parquet scan."""
    snap = spark.read.parquet(path).where(F.col("query_id") == query_id)
    return page(snap, page_num, size).orderBy("rank")
