"""Small scalar functions of the sentiment job, as native expressions.

The reference computes these in row-at-a-time Python UDFs; here each one is a
``when``/``substring``/arithmetic expression that stays in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.ml.functions import vector_to_array

# --- fixed values (must equal the reference's for identical results) -------
# Probability of class 1 above which a comment counts as positive / negative.
POSITIVE_THRESHOLD = 0.2
NEGATIVE_THRESHOLD = 0.25
# Length of the type prefix on a comment's link id ("t3_").
LINK_PREFIX_LENGTH = 3
SECONDS_PER_DAY = 86400
# ---------------------------------------------------------------------------


def label_value(label: Column) -> Column:
    """The integer in a label string; null when absent or not an integer."""
    return label.try_cast("int")


def positive_flag(label: Column) -> Column:
    """1 when the label is 1, else 0 (null for an unusable label)."""
    v = label_value(label)
    return F.when(v.isNull(), None).otherwise((v == 1).cast("int"))


def negative_flag(label: Column) -> Column:
    """1 when the label is -1, else 0 (null for an unusable label)."""
    v = label_value(label)
    return F.when(v.isNull(), None).otherwise((v == -1).cast("int"))


def strip_link_prefix(link_id: Column) -> Column:
    """drop the three-character type prefix (``t3_abc`` -> ``abc``)."""
    return F.substring(link_id, LINK_PREFIX_LENGTH + 1, 1 << 30)


def epoch_to_date(seconds: Column) -> Column:
    """epoch seconds to the UTC calendar date, independent of the
    session time zone."""
    days = F.floor(seconds / SECONDS_PER_DAY).cast("int")
    return F.date_from_unix_date(days)


def ntz_to_epoch(ts: Column) -> Column:
    """Whole epoch seconds of a timestamp without time zone, read as UTC.

    Built from the calendar fields, which a zone-less timestamp carries as
    is; casting to a zoned timestamp would apply the session zone's offset
    (and its daylight-saving jumps)."""
    return (F.unix_date(F.to_date(ts)).cast("long") * SECONDS_PER_DAY
            + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts))).cast("long")


def class_one_above(probability: Column, threshold: float) -> Column:
    """1 when P(class 1) > threshold, else 0, from a vector of
    probabilities."""
    return above(vector_to_array(probability)[1], threshold)


def above(p1: Column, threshold: float) -> Column:
    """1 when the probability is above the threshold, else 0.

    Spark orders NaN above every number, so ``NaN > t`` would be true; the
    reference's Python comparison is false, hence the guard.
    """
    return F.when(~F.isnan(p1) & (p1 > threshold), 1).otherwise(0)
