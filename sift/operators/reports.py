"""Plot data (R4): the frames behind the reference's charts, without drawing.

The reference reads its share CSVs into pandas, keeps three columns, renames
them, filters a bad date, looks states up in a dict and computes colour
shades with numpy. Each step is a DataFrame operation here; only the final,
small frame would leave Spark for plotting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import STATES

# --- fixed values (must equal the reference's for identical results) -------
DROPPED_DATES = ["2018-12-31"]                        # P8
UNMAPPED_REGIONS = ["District of Columbia", "Puerto Rico"]  # P9
POS_RANGE = (0.3, 0.7)                                # F30 shade ranges
NEG_RANGE = (0.7, 1.0)
DIFF_RANGE = (0.0, 0.7)
POSITIVE, NEGATIVE = "Positive", "Negative"           # P2 column names
# ---------------------------------------------------------------------------


def report_days(by_day: DataFrame, dropped=DROPPED_DATES) -> DataFrame:
    """(date, Positive, Negative) without the dropped dates.

    pandas compares the date text, so a null date survives there; Spark's
    ``!=`` drops it. Share tables never hold a null key, so both agree.
    """
    keep = ~F.col("date").isin([F.lit(d).cast("date") for d in dropped])
    return by_day.where(keep).select(
        "date", F.col("pos_share").alias(POSITIVE), F.col("neg_share").alias(NEGATIVE))


def _shade(v, lo_hi):
    lo, hi = lo_hi
    # 1 - sqrt((v - lo) / (hi - lo)); NaN below the range, as in numpy.
    return F.lit(1.0) - F.sqrt((v - F.lit(lo)) / F.lit(hi - lo))


def report_states(spark: SparkSession, by_state: DataFrame) -> DataFrame:
    """Per mapped state, its shares, the difference and
    the three colour shades. States without a share row get nulls (the
    reference's dict lookup would raise)."""
    regions = spark.createDataFrame(
        [(s,) for s in STATES if s not in UNMAPPED_REGIONS], "state string")
    shares = by_state.select(F.col("flair").alias("state"),
                             F.col("pos_share").alias(POSITIVE),
                             F.col("neg_share").alias(NEGATIVE))
    joined = regions.join(shares, "state", "left")
    diff = F.col(NEGATIVE) - F.col(POSITIVE)
    return joined.select(
        "state", POSITIVE, NEGATIVE, diff.alias("diff"),
        _shade(F.col(POSITIVE), POS_RANGE).alias("pos_shade"),
        _shade(F.col(NEGATIVE), NEG_RANGE).alias("neg_shade"),
        _shade(diff, DIFF_RANGE).alias("diff_shade"))


def report_scores(by_sscore: DataFrame, by_cscore: DataFrame) -> DataFrame:
    """the two scatter series, (kind, score, Positive, Negative)."""
    def series(df, key, kind):
        return df.select(F.lit(kind).alias("kind"), F.col(key).alias("score"),
                         F.col("pos_share").alias(POSITIVE),
                         F.col("neg_share").alias(NEGATIVE))
    return series(by_sscore, "sscore", "submission").unionByName(
        series(by_cscore, "cscore", "comment"))
