"""Key, reference and length rules of the catalog DDL (S2), as queries.

Spark does not enforce keys, so each rule becomes an aggregate or an anti
join that reports violations instead of rejecting rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(table: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """(table_name, n_rows, n_keys, duplicate_keys, duplicate_rows) for one table."""
    per_key = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count(F.when(F.col("n") > 1, 1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long")
        .alias("duplicate_rows"))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
            check: str) -> DataFrame:
    """(check_name, orphans): child rows whose key has no parent (anti join).

    Rows with a null key are not orphans (SQL foreign keys allow nulls)."""
    p = parent.select(F.col(parent_key).alias("_k"))
    c = child.where(F.col(child_key).isNotNull())
    missing = c.join(p, c[child_key] == p["_k"], "left_anti")
    return missing.agg(F.lit(check).alias("check_name"),
                       F.count(F.lit(1)).alias("orphans"))


def length_violations(table: DataFrame, name: str, column: str, max_len: int) -> DataFrame:
    """(table_name, column_name, max_length, violations, longest)."""
    n = F.length(F.col(column))
    return table.agg(F.lit(name).alias("table_name"), F.lit(column).alias("column_name"),
                     F.lit(max_len).alias("max_length"),
                     F.count(F.when(n > max_len, 1)).alias("violations"),
                     F.max(n).cast("long").alias("longest"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
