"""Joins that stay balanced when one key holds a large share of the rows.

``split_hot_join(big, small, key, weight)`` joins a large table to a table
with one row per key, where ``weight`` is the number of large-table rows of
that key (e.g. a token's document frequency). Keys whose weight exceeds
``1 / max_hot`` of the total are *hot*: there can be at most ``max_hot`` of
them, so they are broadcast with a proven size bound, and their rows join
map-side without a shuffle. The remaining rows hold no key above that share
and go through an ordinary (shuffled or AQE-broadcast) join. The hot rows
are removed from that side before its shuffle by a broadcast anti join, so
no task receives a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_HOT = 10_000


def hot_keys(small: DataFrame, weight: str, max_hot: int = DEFAULT_MAX_HOT) -> DataFrame:
    """The rows of ``small`` whose weight exceeds ``1 / max_hot`` of the total."""
    total = small.select(F.sum(weight)).scalar()
    return small.where(F.coalesce(F.col(weight) * F.lit(max_hot) > total, F.lit(False)))


def split_hot_join(big: DataFrame, small: DataFrame, key: str, weight: str,
                   max_hot: int = DEFAULT_MAX_HOT) -> DataFrame:
    """Inner join ``big`` and ``small`` on ``key`` (``small`` unique on key)."""
    total = small.select(F.sum(weight)).scalar()
    # A null weight (or an empty side) counts as cold, so no row is lost.
    is_hot = F.coalesce(F.col(weight) * F.lit(max_hot) > total, F.lit(False))
    hot = F.broadcast(small.where(is_hot))          # < max_hot rows by construction
    cold = small.where(~is_hot)
    hot_rows = big.join(hot, key)
    cold_rows = big.join(F.broadcast(small.where(is_hot).select(key)), key, "left_anti") \
        .join(cold, key)
    return hot_rows.unionByName(cold_rows)


DEFAULT_SALTS = 64


def salted_join(big: DataFrame, small: DataFrame, key: str, weights: DataFrame, weight: str,
                salt_col: str, max_hot: int = DEFAULT_MAX_HOT,
                salts: int = DEFAULT_SALTS) -> DataFrame:
    """Inner join of ``big`` and ``small`` with hot keys salted, reading
    ``big`` once; ``small`` may hold a key more than once.

    ``weights`` is a stored table of one row per key with its number of
    ``big`` rows. The hot keys -- fewer than ``max_hot`` by construction,
    since each holds more than ``1/max_hot`` of the total -- are broadcast and
    tag both sides. Hot rows of ``big`` get a salt in ``[0, salts)`` from a
    hash of ``salt_col`` (deterministic, so a retried task salts identically);
    only hot rows of ``small`` are replicated ``salts`` times. One join on
    (key, salt) follows: a hot key is spread over ``salts`` partitions, or
    nothing of ``big`` is shuffled when ``small`` is broadcast. Nothing runs
    while the plan is built.
    """
    total = weights.select(F.sum(weight)).scalar()
    is_hot = F.coalesce(F.col(weight) * F.lit(max_hot) > total, F.lit(False))
    hot = F.broadcast(weights.where(is_hot).select(key, F.lit(True).alias("_hot")))
    tagged = big.join(hot, key, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(F.col(salt_col)), F.lit(salts)))
                  .otherwise(F.lit(0)).cast("int")).drop("_hot")
    fan = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    replicated = small.join(hot, key, "left").withColumn("_salt", F.explode(fan)).drop("_hot")
    return tagged.join(replicated, [key, "_salt"]).drop("_salt")
