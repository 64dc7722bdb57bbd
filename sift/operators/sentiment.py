"""Sentiment shares and story rankings.

The reference computes each share table as three group-bys (all rows,
positive rows, negative rows) joined on the key: three shuffles and two
joins per table. One conditional aggregate gives the same rows with one
shuffle, and its partial aggregation makes a hot key (one story holding a
third of all comments) cost one row per map task:

    group by key: count(*), sum(pos), sum(neg)
    keep groups with pos > 0 and neg > 0 and a non-null key   (= inner joins)

``keep_all=True`` keeps the groups the reference's inner joins drop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.flags import epoch_to_date, strip_link_prefix
from ..sources.tables import STATES

# --- fixed values (must equal the reference's for identical results) -------
TOP_SHARE = 0.9   # stories whose share exceeds this are "top" stories
TOP_STORIES = 10  # length of the top lists
# ---------------------------------------------------------------------------


def _shares(df: DataFrame) -> DataFrame:
    return (df.withColumn("pos_share", F.try_divide(F.col("pos_count"), F.col("count")))
            .withColumn("neg_share", F.try_divide(F.col("neg_count"), F.col("count"))))


def share_overall(scored: DataFrame) -> DataFrame:
    """One row of count and positive / negative shares."""
    return _shares(scored.agg(F.count(F.lit(1)).alias("count"),
                              F.sum("pos").cast("long").alias("pos_count"),
                              F.sum("neg").cast("long").alias("neg_count")))


def share_by(scored: DataFrame, key: str, keep_all: bool = False) -> DataFrame:
    """Shares per value of ``key`` (one shuffle)."""
    grouped = (scored.where(F.col(key).isNotNull())
               .groupBy(key)
               .agg(F.count(F.lit(1)).alias("count"),
                    F.sum("pos").cast("long").alias("pos_count"),
                    F.sum("neg").cast("long").alias("neg_count")))
    if not keep_all:
        grouped = grouped.where((F.col("pos_count") > 0) & (F.col("neg_count") > 0))
    return _shares(grouped)


#: The name of each share table and its key.
SHARE_KEYS = {"overall": None, "day": "date", "state": "flair", "comment_score": "cscore",
              "submission_score": "sscore", "story": "sid"}


def share_all(scored: DataFrame) -> DataFrame:
    """A7-A12 in one scan and one shuffle, by grouping sets: ``dimension`` (a
    name of ``SHARE_KEYS``), its key column (the others null), count and
    shares. All groups but those of null keys and of flairs that are no state;
    ``share_table`` reads one table out of it."""
    keys = [k for k in SHARE_KEYS.values() if k]
    rows = with_date(scored).select(
        "date", F.when(F.col("flair").isin(STATES), F.col("flair")).alias("flair"), "cscore", "sscore", "sid", "pos", "neg")
    grouped = (rows.groupingSets([[F.col(k)] for k in keys] + [[]], *[F.col(k) for k in keys])
               .agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("count"),
                    F.sum("pos").cast("long").alias("pos_count"), F.sum("neg").cast("long").alias("neg_count")))
    whole = (1 << len(keys)) - 1  # the id has a bit for every key that is not grouped by
    dimension = F.when(F.col("_set") == whole, "overall")
    for at, (name, key) in enumerate((n, k) for n, k in SHARE_KEYS.items() if k):
        dimension = dimension.when((F.col("_set") == whole - (1 << (len(keys) - 1 - at)))
                                   & F.col(key).isNotNull(), name)
    return _shares(grouped.withColumn("dimension", dimension).where(F.col("dimension").isNotNull())
                   .select("dimension", *keys, "count", "pos_count", "neg_count"))


def share_table(shares: DataFrame, dimension: str, keep_all: bool = False) -> DataFrame:
    """One table of ``share_all``, as ``share_overall`` or ``share_by`` give it."""
    key = SHARE_KEYS[dimension]
    rows = shares.where(F.col("dimension") == dimension)
    if key and not keep_all:
        rows = rows.where((F.col("pos_count") > 0) & (F.col("neg_count") > 0))
    return rows.select(*([key] if key else []), "count", "pos_count", "neg_count", "pos_share", "neg_share")


def with_date(scored: DataFrame) -> DataFrame:
    """the UTC date of ``created_utc``."""
    return scored.withColumn("date", epoch_to_date(F.col("created_utc")))


def share_by_day(scored: DataFrame, keep_all: bool = False) -> DataFrame:
    return share_by(with_date(scored), "date", keep_all)


def share_by_state(scored: DataFrame, keep_all: bool = False) -> DataFrame:
    """A9 with P5: only flairs that are a state name (a literal IN list)."""
    return share_by(scored.where(F.col("flair").isin(STATES)), "flair", keep_all)


def comments_with_title(comments: DataFrame, submissions: DataFrame) -> DataFrame:
    """Comments joined to their story on the stripped link id (inner),
    carrying both scores and the story id, so J7 needs no second pass."""
    c = comments.select("id", F.col("author_flair_text").alias("flair"), "created_utc",
                        "body", F.col("score").alias("cscore"),
                        strip_link_prefix(F.col("link_id")).alias("sid"))
    s = submissions.select(F.col("id").alias("sid"), "title", F.col("score").alias("sscore"))
    # One story may hold a large share of all comments. The join is inner and
    # neither side is aggregated before it, so adaptive skew splitting cuts
    # such a story; a small submission side is broadcast at run time.
    return c.join(s, "sid")


def labeled_comments(labeled: DataFrame, comments: DataFrame) -> DataFrame:
    """Labels joined to comments on ``Input_id = id`` (inner)."""
    return labeled.join(comments, labeled["Input_id"] == comments["id"])


def top_stories(by_story: DataFrame, share: str, limit: int = TOP_STORIES) -> DataFrame:
    """Stories with share > 0.9, highest first, ties by story id.

    The reference's negative list sorts the unfiltered frame and never cuts
    it to ten; both lists here are filtered and cut, as its notes intend.
    """
    return (by_story.where(F.col(share) > TOP_SHARE)
            .orderBy(F.desc(share), F.asc("sid"))
            .limit(limit))
