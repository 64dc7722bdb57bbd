"""Contract queries: one ``(spark, sf_dir) -> DataFrame`` per operator.

Each query reads the generated tables through ``sources.tables`` and runs the
library operators over them whole. Computed columns carry the same names as
in ``plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import blocks, frequent, index, quality, ranked, reports, sampling, search, segments, sentiment, term_counts, term_fit
from ..session import new_scratch_path
from ..sources import tables

# Parameters of the single-query searches (the web form's inputs). Queries
# are not lower-cased (as in the reference), so "Thunder" matches nothing in
# the lower-case index while "the" and "ocean" do.
OR_QUERY = "Thunder, the ocean!"
AND_QUERY = "of the"
PAGE_NUMBER = 2


# --- shared builders -------------------------------------------------------

_INDEXES: dict = {}


def built_index(spark: SparkSession, sf: str, rebuild: bool = False) -> index.Index:
    """The persisted index of the songs at ``sf``.

    Built once per application and data directory, like the reference's
    score table that is loaded once and then serves every search; later
    queries read the stored parquet. ``rebuild=True`` forces a fresh build.
    """
    from ..sources.files import path_exists
    key = (spark.sparkContext.applicationId, sf)
    cached = _INDEXES.get(key)
    if rebuild or cached is None or not path_exists(spark, cached[0] + "/tfidf/_SUCCESS"):
        path = new_scratch_path(spark, "index")
        idx = index.build(tables.song_texts(spark, sf), tables.songs(spark, sf),
                          tables.artists(spark, sf), path)
        _INDEXES[key] = (path, idx)
    return _INDEXES[key][1]


def catalog(spark: SparkSession, sf: str):
    """(scores, totals, names) of the search index."""
    idx = built_index(spark, sf)
    return idx.scores, idx.totals, idx.names


def batch_results(spark: SparkSession, sf: str) -> DataFrame:
    idx = built_index(spark, sf)
    return search.search_batch(idx.scores, idx.totals, idx.names, tables.search_queries(spark, sf),
                               num_queries=_query_bound(spark, sf), frequencies=idx.frequencies,
                               by_rank=lambda: ranked_index(spark, sf))


_RANKED: dict = {}


def ranked_index(spark: SparkSession, sf: str, rebuild: bool = False) -> ranked.RankedIndex:
    """The postings in rank order of the index at ``sf``, stored once per
    application and index."""
    idx = built_index(spark, sf)
    key = _INDEXES[(spark.sparkContext.applicationId, sf)][0]
    if rebuild or key not in _RANKED:
        _RANKED[key] = ranked.build(idx.tokens, idx.totals, idx.names, new_scratch_path(spark, "ranked"))
    return _RANKED[key]


_BLOCKS: dict = {}


def block_index(spark: SparkSession, sf: str) -> blocks.BlockIndex:
    """Scored postings by block of the index at ``sf``, stored once."""
    places = ranked_index(spark, sf).places
    key = _INDEXES[(spark.sparkContext.applicationId, sf)][0]
    if key not in _BLOCKS:
        _BLOCKS[key] = blocks.build(built_index(spark, sf).scores, places, new_scratch_path(spark, "blocks"))
    return _BLOCKS[key]


def batch_counts(spark: SparkSession, sf: str) -> DataFrame:
    """(query_id, num_results) of the batch, from bitmaps alone."""
    return ranked.result_counts(ranked_index(spark, sf), tables.search_queries(spark, sf))


def _query_bound(spark: SparkSession, sf: str) -> int:
    # The batch is two queries per benchmark item; counting the (small)
    # query input bounds the rank offsets table before it is broadcast.
    return 2 * tables.load(spark, sf, "benchmark").count()


def single_search(spark: SparkSession, sf: str, query: str, mode: str) -> DataFrame:
    scores, totals, names = catalog(spark, sf)
    found = search.search_one(spark, scores, totals, names, query, mode)
    ranked = search.rank_within(found.withColumn("query_id", F.lit(0)), "query_id",
                                [F.desc("score"), F.asc("song_id")], num_groups=1)
    return ranked.select("rank", "song_id", "song", "artist_name", "page_link", "score")


def label_scored(spark: SparkSession, sf: str) -> DataFrame:
    """Comments with story, both scores and flags pos = quality, neg = toxic
    (the SQL-checkable stand-in for the classifier's output)."""
    c = tables.comments(spark, sf)
    s = tables.submissions(spark, sf)
    labels = tables.load(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("quality").alias("pos"), F.col("toxic").alias("neg"))
    return sentiment.comments_with_title(c, s).join(labels, "id")


def _words(spark: SparkSession, sf: str) -> DataFrame:
    docs = tables.texts(spark, sf)
    return docs.select("doc_id", T.clean_words(F.col("text")).alias("words"))


def _term_counts(spark: SparkSession, sf: str, n: int) -> DataFrame:
    return term_counts.ngram_counts(_words(spark, sf), n)


# --- search ------------------------------------------------------------------

def q_doc_frequency(spark, sf):
    return built_index(spark, sf).frequencies


def q_tfidf_scores(spark, sf):
    scores = built_index(spark, sf, rebuild=True).scores
    return scores.select("song_id", "token", F.round("score", 6).alias("score"))


def q_search_or(spark, sf):
    return single_search(spark, sf, OR_QUERY, "or")


def q_search_and(spark, sf):
    return single_search(spark, sf, AND_QUERY, "and")


def q_search_batch(spark, sf):
    return batch_results(spark, sf).select(
        "query_id", "rank", "song_id", "song", "artist_name", "page_link", "score")


def q_search_result_count(spark, sf):
    queries = tables.search_queries(spark, sf).select("query_id")
    counts = batch_counts(spark, sf)
    return (queries.join(counts, "query_id", "left")
            .select("query_id", F.coalesce("num_results", F.lit(0)).alias("num_results")))


RESULT_COLUMNS = ["query_id", "rank", "song_id", "song", "artist_name", "page_link", "score"]


def q_ranked_postings(spark, sf):
    """Postings per token in the rank-ordered index, built anew."""
    rows = ranked_index(spark, sf, rebuild=True).postings
    return rows.groupBy("token").agg(F.sum("n").alias("n_songs"))


def q_search_page(spark, sf):
    """Page 2 of every query of the batch (O3), read best tiers first."""
    return ranked.page(ranked_index(spark, sf), tables.search_queries(spark, sf), PAGE_NUMBER).select(*RESULT_COLUMNS)


def q_search_first_page(spark, sf):
    """Page 1 of every query of the batch (O2)."""
    return ranked.page(ranked_index(spark, sf), tables.search_queries(spark, sf), 1).select(*RESULT_COLUMNS)


def q_search_matched_page(spark, sf):
    """Page 1 of every query when a song scores by its matched tokens alone."""
    return blocks.page(block_index(spark, sf), tables.search_queries(spark, sf), 1).select(*RESULT_COLUMNS)


def q_tfidf_segments(spark, sf):
    """S8 for songs that come in two loads: one segment each, merged at read."""
    path = new_scratch_path(spark, "segments")
    songs, texts = tables.songs(spark, sf), tables.song_texts(spark, sf)
    for half in (0, 1):
        mine = F.pmod("song_id", F.lit(2)) == half
        segments.add(path, f"load-{half}", songs.where(mine), texts.where(mine))
    return segments.scores(spark, path).select("song_id", "token", F.round("score", 6).alias("score"))


def q_search_snapshot_page(spark, sf):
    """The ranked results of all queries stored once, page 2 read back."""
    path = new_scratch_path(spark, "results")
    search.write_snapshot(batch_results(spark, sf), path)
    return search.page(spark.read.parquet(path), PAGE_NUMBER).select(*RESULT_COLUMNS)


def q_search_or_first_page(spark, sf):
    """O2: page 1 of the interactive OR query."""
    return _or_page(spark, sf, 1)


def q_search_page_info(spark, sf):
    counts = batch_counts(spark, sf)
    queries = tables.search_queries(spark, sf).select("query_id")
    # Every page of every query, plus one past the end.
    per_query = (queries.join(counts, "query_id", "left")
                 .select("query_id", F.coalesce("num_results", F.lit(0)).alias("n")))
    requests = per_query.select(
        "query_id", F.explode(F.sequence(F.lit(1).cast("long"),
                                         F.ceil(F.col("n") / 20).cast("long") + 1)).alias("page"))
    info = search.page_info(requests, counts)
    listed = F.array_join(F.transform(
        "page_list", lambda x: F.concat_ws(":", x["page"].cast("string"),
                                           x["turn"].cast("string"))), ",")
    return info.select("query_id", "page", "num_results", "num_pages", "prev_valid",
                       "next_valid", "first_result", "last_result",
                       listed.alias("page_list"))


def _or_page(spark, sf, page: int) -> DataFrame:
    """One page of the interactive OR query by offset/limit (a bounded top-k,
    no full sort), with full links (F27)."""
    from ..functions.paging import full_link
    scores, totals, names = catalog(spark, sf)
    found = search.search_one(spark, scores, totals, names, OR_QUERY, "or")
    return search.ordered_page(found, page).select(
        "song_id", "song", "artist_name", full_link(F.col("page_link")).alias("url"), "score")


def q_search_or_page(spark, sf):
    """O3 without a stored rank: page 2 of the interactive OR query."""
    return _or_page(spark, sf, PAGE_NUMBER)


def q_query_tokens(spark, sf):
    queries = tables.search_queries(spark, sf)
    return queries.select("query_id", F.posexplode(T.query_tokens(F.col("text")))
                          .alias("position", "token"))


# --- cleaning and n-grams ------------------------------------------------------

def q_clean_tokens(spark, sf):
    return _words(spark, sf).select("doc_id", F.size("words").alias("n_words"),
                                    F.array_join("words", " ").alias("words"))


def q_unigram_counts(spark, sf):
    return _term_counts(spark, sf, 1)


def q_bigram_counts(spark, sf):
    return _term_counts(spark, sf, 2)


def q_trigram_counts(spark, sf):
    return _term_counts(spark, sf, 3)


def q_ngram_features(spark, sf):
    w = _words(spark, sf)
    features = w.select("doc_id", T.ngram_features(F.col("words")).alias("features"))
    return features.select("doc_id", F.size("features").alias("n_features"),
                           F.md5(F.array_join("features", " ")).alias("features_md5"))


def _labelled_words(spark, sf):
    labeled = sentiment.labeled_comments(tables.labeled_data(spark, sf),
                                         tables.comments(spark, sf))
    return labeled.select(T.clean_words(F.col("body")).alias("words"))


def q_ngram_vocabulary(spark, sf):
    """Terms in at least 10 labelled comments (CountVectorizer's minDF=10)."""
    # Cleaned once: the sketch and the exact count both read the words.
    path = new_scratch_path(spark, "labelled-words")
    _labelled_words(spark, sf).write.parquet(path)
    words = spark.read.parquet(path)
    feats = words.select(F.array_distinct(T.ngram_features(F.col("words"))).alias("f"))
    n_words = words.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    return frequent.frequent_terms(T.explode_terms(feats, F.col("f"), "term"), 10, 3 * n_words)


def q_strip_links(spark, sf):
    """F5 over texts of which every fourth opens with a link."""
    return tables.marked_texts(spark, sf).select("doc_id", T.strip_links(F.col("text")).alias("text"))


def q_clean_marked_tokens(spark, sf):
    """words of texts with links and page addresses."""
    words = tables.marked_texts(spark, sf).select("doc_id", T.clean_words(F.col("text")).alias("words"))
    return words.select("doc_id", F.array_join("words", " ").alias("words"))


def q_clean_text(spark, sf):
    return tables.texts(spark, sf).select("doc_id", T.clean_text(F.col("text")).alias("parsed"))


def q_filter_sarcasm_quote(spark, sf):
    """P12, U4 over texts of which half carry one of the marks."""
    marked = tables.marked_texts(spark, sf)
    return marked.where(~T.is_sarcasm_or_quote(F.col("text"))).select("doc_id", "text")


# --- labels, joins, sampling -------------------------------------------------

def q_label_flags(spark, sf):
    from ..functions.flags import negative_flag, positive_flag
    ld = tables.labeled_data(spark, sf)
    flagged = ld.select("Input_id", "labeldjt",
                        positive_flag(F.col("labeldjt")).alias("positive"),
                        negative_flag(F.col("labeldjt")).alias("negative"))
    return flagged.where(F.col("positive").isNotNull())


def q_labeled_comments(spark, sf):
    j = sentiment.labeled_comments(tables.labeled_data(spark, sf), tables.comments(spark, sf))
    return j.select("Input_id", "labeldjt", "id", "author", "author_flair_text",
                    "created_utc", "link_id", "score", "body")


def q_comments_with_title(spark, sf):
    j = sentiment.comments_with_title(tables.comments(spark, sf), tables.submissions(spark, sf))
    return j.select("id", "sid", "title", "flair", "created_utc", "body", "cscore", "sscore")


def q_story_scores(spark, sf):
    return label_scored(spark, sf).select("id", "pos", "neg", "cscore", "sscore", "sid")


def q_sample_comments_bernoulli(spark, sf):
    """P13 as the reference draws it: Bernoulli 2%, seed 0 (depends on the
    partition layout, so checked by row count only)."""
    c = tables.comments(spark, sf)
    return sampling.random_sample(c).select("id", "created_utc", "link_id")


def q_sample_comments(spark, sf):
    c = tables.comments(spark, sf)
    return sampling.hash_sample(c, "id").select("id", "created_utc", "link_id")


# --- shares and reports --------------------------------------------------------

def q_share_overall(spark, sf):
    return sentiment.share_overall(label_scored(spark, sf))


def q_share_by_day(spark, sf):
    return sentiment.share_by_day(label_scored(spark, sf))


def q_share_by_state(spark, sf):
    return sentiment.share_by_state(label_scored(spark, sf))


def q_share_by_comment_score(spark, sf):
    return sentiment.share_by(label_scored(spark, sf), "cscore")


def q_share_by_submission_score(spark, sf):
    return sentiment.share_by(label_scored(spark, sf), "sscore")


def q_share_by_story(spark, sf):
    return sentiment.share_by(label_scored(spark, sf), "sid")


def q_share_all(spark, sf):
    """A7-A12 from one pass; keys as text."""
    shares = sentiment.share_all(label_scored(spark, sf))
    key = F.coalesce(*[F.col(k).cast("string") for k in sentiment.SHARE_KEYS.values() if k])
    return shares.select("dimension", key.alias("key"), "count", "pos_count", "neg_count", "pos_share", "neg_share")


def q_roc_area(spark, sf):
    """M6, exact: how well a comment's score tells both labels, ties included."""
    scored = label_scored(spark, sf)
    sides = [scored.select(F.lit(s).alias("side"), F.col("cscore").alias("score"), F.col(s).alias("label"))
             for s in ("pos", "neg")]
    return (term_fit.area_under_roc(sides[0].unionByName(sides[1]), "side", "score", "label")
            .select("side", F.round("auc", 9).alias("auc")))


def q_top_stories_pos(spark, sf):
    by_story = sentiment.share_by(label_scored(spark, sf), "sid")
    return sentiment.top_stories(by_story, "pos_share")


def q_top_stories_neg(spark, sf):
    by_story = sentiment.share_by(label_scored(spark, sf), "sid")
    return sentiment.top_stories(by_story, "neg_share")


def _through_csv(spark, df: DataFrame, schema) -> DataFrame:
    """A share table written as CSV by the executors, read back."""
    from ..sources import files
    path = new_scratch_path(spark, "report-csv")
    files.write_report(df, path)
    return files.read_report(spark, path, schema)


# The event times are moved so that the first day is this one; the date that
# the report drops then lies among them.
REPORT_START = "2018-12-26"


def _moved(scored: DataFrame) -> DataFrame:
    from ..functions.flags import SECONDS_PER_DAY
    first = F.floor(scored.select(F.min("created_utc")).scalar() / SECONDS_PER_DAY)
    start = F.unix_date(F.lit(REPORT_START).cast("date"))
    return scored.withColumn("created_utc", (F.col("created_utc") + (start - first) * SECONDS_PER_DAY)
                             .cast("long"))


def q_report_days(spark, sf):
    from ..sources import schemas
    by_day = sentiment.share_by_day(_moved(label_scored(spark, sf)))
    return reports.report_days(_through_csv(spark, by_day, schemas.DAYS_REPORT))


def q_report_states(spark, sf):
    from ..sources import schemas
    by_state = sentiment.share_by_state(label_scored(spark, sf))
    return reports.report_states(spark, _through_csv(spark, by_state, schemas.STATES_REPORT))


def q_report_scores(spark, sf):
    from ..sources import schemas
    scored = label_scored(spark, sf)
    return reports.report_scores(
        _through_csv(spark, sentiment.share_by(scored, "sscore"), schemas.SSCORE_REPORT),
        _through_csv(spark, sentiment.share_by(scored, "cscore"), schemas.CSCORE_REPORT))


# --- data quality ----------------------------------------------------------------

def q_dq_duplicate_keys(spark, sf):
    idx = built_index(spark, sf)
    scores, toks, song, art = idx.scores, idx.tokens, idx.songs, idx.artists
    return quality.union_all([
        quality.duplicate_keys(art, "artist", ["artist_id"]),
        quality.duplicate_keys(song, "song", ["song_id"]),
        quality.duplicate_keys(toks, "token", ["song_id", "token"]),
        quality.duplicate_keys(scores, "tfidf", ["song_id", "token"]),
    ])


def q_dq_orphans(spark, sf):
    idx = built_index(spark, sf)
    toks, song, art = idx.tokens, idx.songs, idx.artists
    return quality.union_all([
        quality.orphans(song, art, "artist_id", "artist_id", "song.artist_id -> artist"),
        quality.orphans(toks, song, "song_id", "song_id", "token.song_id -> song"),
        quality.orphans(tables.labeled_data(spark, sf), tables.comments(spark, sf),
                        "Input_id", "id", "labeled_data.Input_id -> comments"),
    ])


def q_dq_lengths(spark, sf):
    from ..sources.schemas import MAX_LENGTH
    idx = built_index(spark, sf)
    toks, song, art = idx.tokens, idx.songs, idx.artists
    frames = {"artist": art, "song": song, "token": toks}
    return quality.union_all([
        quality.length_violations(frames[t], t, c, n) for (t, c), n in MAX_LENGTH.items()])


def _loaded_with_violations(spark, sf):
    """The song table from a CSV into which bad rows are put by a rule on the id."""
    from ..operators import loading
    from ..sources import files
    songs, art = tables.songs(spark, sf), tables.artists(spark, sf)
    rule, text = F.pmod("song_id", F.lit(50)), F.col("song_id").cast("string")
    raw = songs.select(
        F.when(rule == 1, F.concat(F.lit("x"), text)).otherwise(text).alias("song_id"),
        F.when(rule == 4, F.lit("-1")).otherwise(F.col("artist_id").cast("string")).alias("artist_id"),
        F.when(rule == 2, F.rpad("song_name", 300, "!")).otherwise(F.col("song_name")).alias("song_name"), "page_link")
    again = songs.where(rule == 3).select(text.alias("song_id"), F.col("artist_id").cast("string").alias("artist_id"),
                                          "song_name", F.concat(F.lit("~"), "page_link").alias("page_link"))
    path = new_scratch_path(spark, "violations")
    files.write_catalog_table(raw.unionByName(again), f"{path}/song.csv")
    return loading.load(spark, f"{path}/song.csv", "song", path, art)


def q_load_rejects(spark, sf):
    """What does not load, and why."""
    return _loaded_with_violations(spark, sf).rejects


def q_load_accepted(spark, sf):
    """The rest, typed."""
    return _loaded_with_violations(spark, sf).accepted


# --- sources and sinks (write a scratch file, read it back) ---------------------

def _catalog_csv(spark, sf, table: str, df: DataFrame) -> DataFrame:
    from ..sources import files
    path = new_scratch_path(spark, f"{table}-csv")
    files.write_catalog_table(df, path)
    return files.read_catalog_table(spark, path, table)


def _tokens_csv(spark, sf) -> DataFrame:
    toks = index.token_counts(tables.song_texts(spark, sf))
    return _catalog_csv(spark, sf, "token", toks.select("song_id", "token", "count"))


def q_src_csv_catalog(spark, sf):
    """The token table through headerless, double-quoted CSV."""
    return _tokens_csv(spark, sf)


def q_src_csv_artist(spark, sf):
    """The artist table through CSV."""
    return _catalog_csv(spark, sf, "artist", tables.artists(spark, sf).select("artist_id", "artist_name"))


def q_src_csv_song(spark, sf):
    """The song table through CSV."""
    return _catalog_csv(spark, sf, "song", tables.songs(spark, sf))


def q_tfidf_from_token_csv(spark, sf):
    """The index built from a loaded token table, scored."""
    idx = index.build(None, tables.songs(spark, sf), tables.artists(spark, sf),
                      new_scratch_path(spark, "index"), tokens=_tokens_csv(spark, sf))
    return idx.scores.select("song_id", "token", F.round("score", 6).alias("score"))


def q_src_csv_labels(spark, sf):
    """Labelled comments through CSV with a header (strings only)."""
    from ..sources import files
    path = new_scratch_path(spark, "labels-csv")
    files.write_labeled(tables.labeled_data(spark, sf), path)
    return files.read_labeled(spark, path)


def _comments_json(spark, sf) -> str:
    from ..sources import files
    path = new_scratch_path(spark, "comments-json")
    files.write_json_lines(tables.comments(spark, sf), path, compression="bzip2")
    return path


def q_src_json_comments(spark, sf):
    """S3: comments through bz2 JSON lines with a declared schema."""
    from ..sources import files
    c = files.read_comments(spark, _comments_json(spark, sf))
    return c.select("id", "author", "author_flair_text", "created_utc", "link_id", "score", "body")


def q_src_json_submissions(spark, sf):
    """S3: submissions through bz2 JSON lines with a declared schema."""
    from ..sources import files
    path = new_scratch_path(spark, "submissions-json")
    files.write_json_lines(tables.submissions(spark, sf), path, compression="bzip2")
    return files.read_submissions(spark, path)


def q_sink_csv_report(spark, sf):
    """The day share table through CSV."""
    from ..sources import schemas
    return _through_csv(spark, sentiment.share_by_day(label_scored(spark, sf)), schemas.DAYS_REPORT)


def q_sink_csv_overall(spark, sf):
    from ..sources import schemas
    return _through_csv(spark, sentiment.share_overall(label_scored(spark, sf)), schemas.OVERALL_REPORT)


def q_sink_csv_states(spark, sf):
    from ..sources import schemas
    return _through_csv(spark, sentiment.share_by_state(label_scored(spark, sf)), schemas.STATES_REPORT)


def q_sink_csv_submission_scores(spark, sf):
    from ..sources import schemas
    return _through_csv(spark, sentiment.share_by(label_scored(spark, sf), "sscore"), schemas.SSCORE_REPORT)


def q_sink_csv_comment_scores(spark, sf):
    from ..sources import schemas
    return _through_csv(spark, sentiment.share_by(label_scored(spark, sf), "cscore"), schemas.CSCORE_REPORT)


def q_materialize_stage(spark, sf):
    """Labelled comments as a parquet stage (built once, then read)."""
    from ..sources import files
    path = new_scratch_path(spark, "labeled-comments")

    def build():
        return sentiment.labeled_comments(tables.labeled_data(spark, sf),
                                          tables.comments(spark, sf))
    first = files.stage(spark, path, build)
    again = files.stage(spark, path, build)  # second call only reads
    assert first.columns == again.columns
    return again.select("Input_id", "labeldjt", "id", "author", "author_flair_text",
                        "created_utc", "link_id", "score", "body")


def q_preview_ngrams(spark, sf):
    """The first 99 comments (by id) of a JSON dump with their n-grams."""
    from ..sources import files
    c = files.read_comments(spark, _comments_json(spark, sf))
    first = c.orderBy(F.col("id").cast("long")).limit(99)
    feats = T.with_features(first, "body")
    return feats.select("id", "author", F.length("body").alias("body_length"),
                        F.array_join("features", " ").alias("ngrams"))


# --- machine learning (rows-only checks) ------------------------------------------

_MODELS: dict = {}


def _labeled(spark, sf):
    return sentiment.labeled_comments(tables.labeled_data(spark, sf), tables.comments(spark, sf))


def trained(spark, sf):
    """Train once per (application, scale); later ML queries reuse the models."""
    from ..operators import ml
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        _MODELS[key] = ml.train(_labeled(spark, sf))
    return _MODELS[key]


_TERM_FITS: dict = {}


def term_fitted(spark, sf):
    """(labelled comments, pairs, dictionary, encoded pairs, model), fitted once."""
    from ..operators import ml
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TERM_FITS:
        path = new_scratch_path(spark, "term-fit")

        def stored(df: DataFrame, name: str) -> DataFrame:
            df.write.parquet(f"{path}/{name}")
            return spark.read.parquet(f"{path}/{name}")

        words = stored(ml.labeled_words(_labeled(spark, sf)), "words")
        labels = words.select(F.col("Input_id").alias("id"), "positive", "negative")
        pairs = term_fit.postings(words)
        terms = stored(term_fit.dictionary(pairs, ml.MIN_DF), "terms")
        encoded = stored(term_fit.encode(pairs, terms), "encoded")
        _TERM_FITS[key] = labels, terms, encoded, term_fit.fit(encoded, labels, terms)
    return _TERM_FITS[key]


def q_ml_dictionary(spark, sf):
    """M1 as a table."""
    return term_fitted(spark, sf)[1].select("term_id", "term", "df")


def q_ml_term_ids(spark, sf):
    """M2 as (comment, term id) pairs."""
    return T.explode_terms(term_fitted(spark, sf)[2], F.col("term_ids").cast("array<bigint>"), "term_id", "id")


def q_ml_term_weights(spark, sf):
    """M3, M7: weights of both sides after the fixed steps."""
    _, terms, _, model = term_fitted(spark, sf)
    return model.weights.join(terms.select("term_id", "term"), "term_id").select(
        "term", *[F.round(s, 9).alias(s) for s in ("pos", "neg")])


def q_ml_term_flags(spark, sf):
    """Probabilities and flags of both sides."""
    labels, _, encoded, model = term_fitted(spark, sf)
    return term_fit.score(labels.select("id"), encoded, model).select(
        "id", *[F.round(f"p_{s}", 8).alias(f"p_{s}") for s in ("pos", "neg")], "pos", "neg")


def q_split_train_test(spark, sf):
    from ..operators import ml
    feats = ml.labeled_features(_labeled(spark, sf))
    a, b = ml.split(feats, seed=42)
    return (a.select("Input_id", F.lit("train").alias("split"))
            .unionByName(b.select("Input_id", F.lit("test").alias("split"))))


def q_ml_features(spark, sf):
    models, _ = trained(spark, sf)
    from ..operators import ml
    vectors = models.vectorizer.transform(ml.labeled_words(_labeled(spark, sf)))
    return vectors.select("Input_id", "positive", "negative", F.size("term_ids").alias("n_active"))


def q_ml_train(spark, sf):
    models, _ = trained(spark, sf)
    rows = []
    for side in ("pos", "neg"):
        best = getattr(models, side)
        rows.append((side, best.numFeatures, best.regParam, best.maxIter))
    return spark.createDataFrame(rows, "model string, num_features int, reg_param double, max_iter int")


def q_ml_cv_auc(spark, sf):
    """M5, M6: the mean area under ROC over the folds, of each side."""
    models, _ = trained(spark, sf)
    return spark.createDataFrame([(side, float(max(getattr(models, side).avgMetrics)))
                                  for side in ("pos", "neg")], "model string, cv_auc double")


def q_ml_evaluate(spark, sf):
    from ..operators import ml
    models, halves = trained(spark, sf)
    auc = ml.evaluate(models, halves)
    return spark.createDataFrame([(k, float(v)) for k, v in auc.items()],
                                 "model string, test_auc double")


SCORED_COLUMNS = ["id", "flair", "created_utc", "title", "pos", "neg"]


def _scoring_input(spark, sf):
    return sentiment.comments_with_title(tables.comments(spark, sf),
                                         tables.submissions(spark, sf))


def q_ml_score(spark, sf):
    from ..operators import ml
    models, _ = trained(spark, sf)
    return ml.score(_scoring_input(spark, sf), models).select(*SCORED_COLUMNS)


def q_ml_save_load(spark, sf):
    from ..operators import ml
    models, _ = trained(spark, sf)
    path = new_scratch_path(spark, "models")
    models.save(path)
    loaded = ml.SentimentModels.load(path)
    return ml.score(_scoring_input(spark, sf), loaded).select(*SCORED_COLUMNS)


def q_ml_share_by_day(spark, sf):
    """The reference's end-to-end path: classifier flags -> daily shares."""
    return sentiment.share_by_day(q_ml_score(spark, sf))


def q_sentiment_job(spark, sf):
    """The whole comment job from classifier to share tables, all tables in
    one: (report, key, count, pos_count, neg_count, pos_share, neg_share)."""
    from ..sources import files, schemas
    from . import jobs
    written = jobs.sentiment_job(spark, tables.comments(spark, sf), tables.submissions(spark, sf),
                                 tables.labeled_data(spark, sf), new_scratch_path(spark, "job"))
    parts = {"count_all": (schemas.OVERALL_REPORT, None), "count_days": (schemas.DAYS_REPORT, "date"),
             "count_states": (schemas.STATES_REPORT, "flair"),
             "count_cscore": (schemas.CSCORE_REPORT, "cscore"),
             "count_sscore": (schemas.SSCORE_REPORT, "sscore")}
    frames = [files.read_report(spark, written[name], schema).withColumn(
        "key", F.col(key).cast("string") if key else F.lit(None).cast("string")).withColumn(
        "report", F.lit(name)) for name, (schema, key) in parts.items()]
    frames.append(spark.read.parquet(written["count_story"]).withColumn("key", F.col("sid"))
                  .withColumn("report", F.lit("count_story")))
    columns = ["report", "key", "count", "pos_count", "neg_count", "pos_share", "neg_share"]
    out = frames[0].select(*columns)
    for frame in frames[1:]:
        out = out.unionByName(frame.select(*columns))
    return out


# --- streaming ----------------------------------------------------------------------

def q_stream_share_by_day(spark, sf):
    """The day share table kept by a streaming query: scored comments are
    landed as files in two batches, the stream processes both, and the
    result table equals the batch ``share_by_day``."""
    from ..streaming.shares import read_shares, run_share_by_day
    scored = label_scored(spark, sf).select("id", "created_utc", "pos", "neg")
    src = new_scratch_path(spark, "stream-src")
    half = F.pmod(F.xxhash64("id"), F.lit(2))
    out = new_scratch_path(spark, "stream-out")
    ckpt = new_scratch_path(spark, "stream-ckpt")
    scored.where(half == 0).write.parquet(f"{src}/part=0")
    run_share_by_day(spark, src, scored.schema, out, ckpt).awaitTermination()
    # Second landing: the restarted query reads only the new files and
    # carries the per-day state over from its checkpoint.
    scored.where(half == 1).write.parquet(f"{src}/part=1")
    run_share_by_day(spark, src, scored.schema, out, ckpt).awaitTermination()
    return read_shares(spark, out)


QUERIES = {
    "doc_frequency": q_doc_frequency,
    "tfidf_scores": q_tfidf_scores,
    "search_or": q_search_or,
    "search_and": q_search_and,
    "search_batch": q_search_batch,
    "search_result_count": q_search_result_count,
    "ranked_postings": q_ranked_postings,
    "search_page": q_search_page,
    "search_first_page": q_search_first_page,
    "search_matched_page": q_search_matched_page,
    "tfidf_segments": q_tfidf_segments,
    "search_snapshot_page": q_search_snapshot_page,
    "search_or_first_page": q_search_or_first_page,
    "search_page_info": q_search_page_info,
    "search_or_page": q_search_or_page,
    "query_tokens": q_query_tokens,
    "clean_tokens": q_clean_tokens,
    "unigram_counts": q_unigram_counts,
    "bigram_counts": q_bigram_counts,
    "trigram_counts": q_trigram_counts,
    "ngram_features": q_ngram_features,
    "ngram_vocabulary": q_ngram_vocabulary,
    "strip_links": q_strip_links,
    "clean_marked_tokens": q_clean_marked_tokens,
    "clean_text": q_clean_text,
    "filter_sarcasm_quote": q_filter_sarcasm_quote,
    "label_flags": q_label_flags,
    "labeled_comments": q_labeled_comments,
    "comments_with_title": q_comments_with_title,
    "story_scores": q_story_scores,
    "sample_comments": q_sample_comments,
    "sample_comments_bernoulli": q_sample_comments_bernoulli,
    "share_overall": q_share_overall,
    "share_all": q_share_all,
    "roc_area": q_roc_area,
    "share_by_day": q_share_by_day,
    "share_by_state": q_share_by_state,
    "share_by_comment_score": q_share_by_comment_score,
    "share_by_submission_score": q_share_by_submission_score,
    "share_by_story": q_share_by_story,
    "top_stories_pos": q_top_stories_pos,
    "top_stories_neg": q_top_stories_neg,
    "report_days": q_report_days,
    "report_states": q_report_states,
    "report_scores": q_report_scores,
    "dq_duplicate_keys": q_dq_duplicate_keys,
    "dq_orphans": q_dq_orphans,
    "dq_lengths": q_dq_lengths,
    "load_rejects": q_load_rejects,
    "load_accepted": q_load_accepted,
    "src_csv_catalog": q_src_csv_catalog,
    "src_csv_artist": q_src_csv_artist,
    "src_csv_song": q_src_csv_song,
    "tfidf_from_token_csv": q_tfidf_from_token_csv,
    "src_csv_labels": q_src_csv_labels,
    "src_json_comments": q_src_json_comments,
    "src_json_submissions": q_src_json_submissions,
    "sink_csv_report": q_sink_csv_report,
    "sink_csv_overall": q_sink_csv_overall,
    "sink_csv_states": q_sink_csv_states,
    "sink_csv_submission_scores": q_sink_csv_submission_scores,
    "sink_csv_comment_scores": q_sink_csv_comment_scores,
    "materialize_stage": q_materialize_stage,
    "preview_ngrams": q_preview_ngrams,
    "split_train_test": q_split_train_test,
    "ml_dictionary": q_ml_dictionary,
    "ml_term_ids": q_ml_term_ids,
    "ml_term_weights": q_ml_term_weights,
    "ml_term_flags": q_ml_term_flags,
    "ml_features": q_ml_features,
    "ml_train": q_ml_train,
    "ml_cv_auc": q_ml_cv_auc,
    "ml_evaluate": q_ml_evaluate,
    "ml_score": q_ml_score,
    "ml_save_load": q_ml_save_load,
    "ml_share_by_day": q_ml_share_by_day,
    "sentiment_job": q_sentiment_job,
    "stream_share_by_day": q_stream_share_by_day,
}
