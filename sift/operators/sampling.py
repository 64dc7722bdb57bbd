"""Sampling (P13); the 50/50 split (P14) is ``ml.split``.

``df.sample`` draws per partition, so the same seed gives different rows
after a repartition. ``hash_sample`` keeps a row when the md5 of its key
falls under a threshold: the same rows on any layout, any engine, any rerun.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's for identical results) -------
SAMPLE_FRACTION = 0.02  # share of comments the reference scores
SAMPLE_SEED = 0
# ---------------------------------------------------------------------------


def hash_threshold(fraction: float) -> str:
    """Eight-hex-digit bound: md5 prefixes below it are ``fraction`` of all."""
    return format(math.ceil(fraction * 2 ** 32), "08x")


def hash_sample(df: DataFrame, key: str, fraction: float = SAMPLE_FRACTION) -> DataFrame:
    """Rows whose md5 of ``key``, read as a number of 32 bits, is below
    ``fraction`` of the range (no shuffle): all rows at 1, none at 0. A null
    key counts as an empty one."""
    if fraction >= 1:
        return df
    prefix = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 8)
    return df.where(prefix < F.lit(hash_threshold(max(0.0, fraction))))


def random_sample(df: DataFrame, fraction: float = SAMPLE_FRACTION,
                  seed: int = SAMPLE_SEED) -> DataFrame:
    """The reference's Bernoulli sample without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)
