"""TF-IDF index: token counts, document frequency, scores.

Plan at scale:

* ``token_counts``: count cleaned words per (song, token) in the task that read
  the song (``term_counts``), so the shuffle carries one row per distinct
  (song, token), keyed on both columns: no single hot token can gather its rows
  in one task here.
* ``doc_frequency``: count songs per token; partial aggregation again, so a
  token present in every song costs one row per map task.
* ``tfidf``: counts joined back to frequencies on ``token`` with
  ``skew.split_hot_join``: tokens holding more than 1/10,000 of all postings
  (at most 10,000 of them) join by broadcast; the rest by an ordinary join
  in which no token is large. The corpus size is a scalar subquery,
  evaluated once. A build scores its tokens in the partitions in which they
  are stored instead (``write_scores``).
* ``song_totals``: the query-independent total score per song, which is what
  the reference's search ranks by; computed once per index.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_words
from ..session import partitions_for
from . import term_counts
from .search import name_table
from .skew import DEFAULT_MAX_HOT, hot_keys, split_hot_join


def token_counts(texts: DataFrame, id_col: str = "song_id",
                 text_col: str = "text") -> DataFrame:
    """token(song_id, token, count) from raw texts."""
    words = texts.select(F.col(id_col).alias("id"), clean_words(F.col(text_col)).alias("words"))
    return term_counts.per_text(words).select(F.col("id").alias("song_id"), F.col("term").alias("token"), "count")


def doc_frequency(tokens: DataFrame) -> DataFrame:
    """A1: (token, df) = number of songs holding the token."""
    return tokens.groupBy("token").agg(F.count("song_id").alias("df"))


def _score(n_songs: Column) -> Column:
    return F.col("count") * F.log10(n_songs.cast("double") / F.col("df"))


def tfidf(tokens: DataFrame, songs: DataFrame, frequencies: DataFrame | None = None) -> DataFrame:
    """score = count * log10(N / df), N = number of songs.

    ``log10`` because the reference's database ``LOG`` is base 10. Pass a
    stored ``doc_frequency`` table as ``frequencies`` when there is one: the
    skew split reads it several times.
    """
    n_songs = songs.select(F.count("song_id")).scalar()
    df = doc_frequency(tokens) if frequencies is None else frequencies
    # A token in most songs owns a large share of the postings; frequent
    # tokens join by bounded broadcast, the rest by a balanced shuffle.
    return (split_hot_join(tokens, df, "token", "df")
            .select("song_id", "token", _score(n_songs).alias("score")))


def song_totals(scores: DataFrame) -> DataFrame:
    """(song_id, total): sum of all token scores of a song."""
    return scores.groupBy("song_id").agg(F.sum("score").alias("total"))


def write_scores(tokens: DataFrame, songs: DataFrame, frequencies: DataFrame, path: str, partitions: int,
                 max_hot: int = DEFAULT_MAX_HOT) -> None:
    """Persist the score table (``tfidf``) clustered by token.

    Range-partitioning and sorting by token gives each parquet row group a
    narrow token range, so a search's ``token IN (...)`` filter skips most
    row groups from the footer statistics alone. The rows of a token below
    ``1 / max_hot`` of all postings stay together, so its frequency is counted
    where they lie; hot tokens, at most ``max_hot``, get theirs by broadcast, and
    bounds that hold the song spread them over neighbouring files.
    ``tokens`` is read several times (samples, shuffles): pass a stored table,
    and the ``doc_frequency`` of it.
    """
    n_songs = songs.select(F.count("song_id")).scalar()
    hot = F.broadcast(hot_keys(frequencies, "df", max_hot))
    known = tokens.where(F.col("token").isNotNull())
    cold = (known.join(hot.select("token"), "token", "left_anti")
            .repartitionByRange(partitions, "token").sortWithinPartitions("token", "song_id")
            .withColumn("df", F.count("song_id").over(Window.partitionBy("token"))))
    spread = (known.join(hot, "token")
              .repartitionByRange(partitions, "token", "song_id").sortWithinPartitions("token", "song_id"))
    columns = ["song_id", "token", _score(n_songs).alias("score")]
    spread.select(*columns).unionByName(cold.select(*columns)).write.mode("overwrite").parquet(path)


@dataclass
class Index:
    tokens: DataFrame   # token(song_id, token, count)
    frequencies: DataFrame  # (token, df)
    scores: DataFrame   # tfidf(song_id, token, score), clustered by token
    totals: DataFrame   # (song_id, total), clustered by song
    songs: DataFrame    # song(song_id, artist_id, song_name, page_link)
    artists: DataFrame  # artist(artist_id, artist_name)
    names: DataFrame    # (song_id, song, artist_name, page_link)


def build(texts: DataFrame | None, songs: DataFrame, artists: DataFrame, path: str,
          partitions: int | None = None, tokens: DataFrame | None = None) -> Index:
    """Build and persist the search catalog and index under ``path`` (a
    shared folder); every later search reads only these stored tables. The
    token table is counted from ``texts``, or given as ``tokens``
    (song_id, token, count), as when it is loaded from a file.

    * token: written once and read back, so text cleaning runs once although
      counts and frequencies both read it, and later failures recompute from
      files rather than from raw text;
    * dfreq: document frequency per token, aggregated once and read by each
      branch of the hot/cold split;
    * tfidf: scored in the partitions it is clustered into (see
      ``write_scores``), sized by the bytes of the token table;
    * totals: the query-independent score of each song, aggregated once here
      instead of in every search;
    * song, artist: the catalog; names: both joined once, what results are
      named from.
    """
    spark = songs.sparkSession
    if (texts is None) == (tokens is None):
        raise ValueError("give either texts or tokens")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    song = stored(songs, "song")
    artist = stored(artists, "artist")
    token = stored(token_counts(texts) if tokens is None
                   else tokens.select("song_id", "token", "count"), "token")
    frequencies = stored(doc_frequency(token), "dfreq")
    n = partitions or partitions_for(spark, f"{path}/token")
    write_scores(token, song, frequencies, f"{path}/tfidf", n)
    scores = spark.read.parquet(f"{path}/tfidf")
    totals = stored(song_totals(scores), "totals")
    names = stored(name_table(song, artist), "names")
    return Index(token, frequencies, scores, totals, song, artist, names)


def open_index(spark, path: str) -> Index:
    """Open an index stored by ``build`` (e.g. from another application)."""
    read = lambda name: spark.read.parquet(f"{path}/{name}")
    return Index(read("token"), read("dfreq"), read("tfidf"), read("totals"), read("song"),
                 read("artist"), read("names"))
