"""The reference's tables, bound to the generated parquet tables.

The reference reads a song catalog (artist, song, token) and a comment dump
(comments, submissions, labelled comments). The driver provides
``documents``, ``events``, ``conversations`` and ``labels`` instead; this
module derives the reference's tables from them with DataFrame operations
only, so every derived table grows with its inputs.

Binding (the same rule at every scale):

* song      = one per document: id ``doc_id``, name ``source-doc_id``,
              link ``/lang/doc_id``; its artist is the document's source.
* artist    = one per distinct source; id = smallest ``doc_id`` of that source.
* token     = cleaned words of ``documents.text`` counted per document.
* comment   = a document, placed in time and scored through the event
              ``(doc_id * 7919) % n_events``; story ``t3_`` + ``doc_id % n_conv``;
              flair = state ``doc_id % 51`` of the state list.
* submission= a conversation: title = its turn-0 text, score = its turn count.
* label     = ``toxic=1`` -> -1, else ``quality=1`` -> 1, else 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.flags import ntz_to_epoch
from ..operators.skew import split_hot_join
from ..session import spread

# --- fixed values (must equal the reference's for identical results) -------
# The 50 US states and the District of Columbia, as used for flair filtering.
STATES = [
    "Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado",
    "Connecticut", "Delaware", "District of Columbia", "Florida", "Georgia",
    "Hawaii", "Idaho", "Illinois", "Indiana", "Iowa", "Kansas", "Kentucky",
    "Louisiana", "Maine", "Maryland", "Massachusetts", "Michigan", "Minnesota",
    "Mississippi", "Missouri", "Montana", "Nebraska", "Nevada", "New Hampshire",
    "New Jersey", "New Mexico", "New York", "North Carolina", "North Dakota",
    "Ohio", "Oklahoma", "Oregon", "Pennsylvania", "Rhode Island",
    "South Carolina", "South Dakota", "Tennessee", "Texas", "Utah", "Vermont",
    "Virginia", "Washington", "West Virginia", "Wisconsin", "Wyoming",
]
# Comment ids and link ids carry a three-character type prefix.
LINK_PREFIX = "t3_"
# ---------------------------------------------------------------------------

# Binding constants of our own (not from the reference).
EVENT_STRIDE = 7919

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- search catalog --------------------------------------------------------

def artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """artist(artist_id, artist_name): one row per distinct source."""
    docs = load(spark, sf_dir, "documents")
    return (docs.groupBy(F.col("source").alias("artist_name"))
            .agg(F.min("doc_id").alias("artist_id"))
            .select("artist_id", "artist_name"))


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """song(song_id, artist_id, song_name, page_link). Twenty sources share
    all documents, so the artist join goes through the hot/cold split."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    art = docs.groupBy("source").agg(F.min("doc_id").alias("artist_id"),
                                     F.count(F.lit(1)).alias("_n_songs"))
    return (split_hot_join(docs, art, "source", "_n_songs")
            .select(F.col("doc_id").alias("song_id"), "artist_id",
                    F.concat_ws("-", "source", F.col("doc_id").cast("string"))
                    .alias("song_name"),
                    F.concat(F.lit("/"), "lang", F.lit("/"),
                             F.col("doc_id").cast("string")).alias("page_link")))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` scan, spread over the cores by its unique id when the
    files have fewer splits (see ``session.spread``)."""
    return spread(load(spark, sf_dir, "documents"), "doc_id")


def song_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(song_id, text): the lyrics the token table is built from."""
    return texts(spark, sf_dir).select(F.col("doc_id").alias("song_id"), "text")


def marked_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text) with the marks that comments carry and the generated
    texts lack, by a rule on the id: a markdown link to a page in front
    (remainder 0 of 4), a page address behind (1), a sarcasm mark behind (2),
    a quote mark in front (3). The page is ``doc_id % n_pages``."""
    docs = texts(spark, sf_dir).select("doc_id", "text", "source")
    pages = load(spark, sf_dir, "pages").select("page_id", "url")
    n_pages = pages.select(F.count(F.lit(1))).scalar()
    rule = F.pmod(F.col("doc_id"), F.lit(4))
    marked = (F.when(rule == 0, F.concat(F.lit("["), "source", F.lit("]("), "url", F.lit(") "), "text"))
              .when(rule == 1, F.concat("text", F.lit(" "), "url"))
              .when(rule == 2, F.concat("text", F.lit(" /s")))
              .otherwise(F.concat(F.lit("&gt; "), "text")))
    return (docs.withColumn("page_id", F.pmod("doc_id", n_pages)).join(pages, "page_id")
            .select("doc_id", marked.alias("text")))


def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of queries derived from the data: every benchmark passage is
    asked once in ``or`` mode (query_id = 2*item_id) and once in ``and`` mode
    (query_id = 2*item_id + 1), lower-cased like the index."""
    bench = load(spark, sf_dir, "benchmark")
    modes = F.array(F.lit("or"), F.lit("and"))
    return (bench.select("item_id", F.lower("text").alias("text"),
                         F.posexplode(modes).alias("m", "mode"))
            .select((F.col("item_id") * 2 + F.col("m")).alias("query_id"),
                    "text", "mode"))


# --- comment dump ------------------------------------------------------------

def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """comments(id, body, author, author_flair_text, created_utc, link_id, score)."""
    docs = texts(spark, sf_dir).select("doc_id", "text", "source")
    events = load(spark, sf_dir, "events").select("event_id", "ts", "value")
    convs = load(spark, sf_dir, "conversations")
    # Scalar subqueries: evaluated once, inlined as constants.
    n_events = events.select(F.count(F.lit(1))).scalar()
    n_conv = convs.select(F.count_distinct("conv_id")).scalar()
    states = F.array(*[F.lit(s) for s in STATES])
    placed = docs.withColumn("event_id", F.pmod(F.col("doc_id") * EVENT_STRIDE, n_events))
    return (placed.join(events, "event_id")
            .select(F.col("doc_id").cast("string").alias("id"),
                    F.col("text").alias("body"),
                    F.col("source").alias("author"),
                    F.get(states, F.pmod(F.col("doc_id"), F.lit(len(STATES))).cast("int"))
                    .alias("author_flair_text"),
                    ntz_to_epoch(F.col("ts")).alias("created_utc"),
                    F.concat(F.lit(LINK_PREFIX),
                             F.pmod(F.col("doc_id"), n_conv).cast("string")).alias("link_id"),
                    F.floor("value").cast("long").alias("score")))


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """submissions(id, title, score): one aggregation, skew-safe (partial)."""
    convs = load(spark, sf_dir, "conversations")
    return (convs.groupBy("conv_id")
            .agg(F.max(F.when(F.col("turn") == 0, F.col("text"))).alias("title"),
                 F.count(F.lit(1)).alias("score"))
            .select(F.col("conv_id").cast("string").alias("id"), "title", "score"))


def labeled_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labeled_data(Input_id, labeldjt) with string columns, like the CSV."""
    labels = load(spark, sf_dir, "labels")
    label = (F.when(F.col("toxic") == 1, F.lit("-1"))
             .when(F.col("quality") == 1, F.lit("1"))
             .otherwise(F.lit("0")))
    return labels.select(F.col("doc_id").cast("string").alias("Input_id"),
                         label.alias("labeldjt"))
