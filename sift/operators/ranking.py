"""Stable, skew-safe rank within a group.

``row_number().over(Window.partitionBy(g).orderBy(...))`` sends every row of
a group to one task. A search for a very common word can match a third of
all songs, so that task would sort a third of the corpus alone. Instead:

1. Range-partition on (group, order keys) and sort within partitions. The
   range bounds come from a sample of the full key, so one large group is
   cut across many partitions of balanced size.
2. Number rows in partition order with ``monotonically_increasing_id`` (its
   upper bits are the partition index, its lower bits the position).
3. Per (partition, group): first id and row count -- at most
   ``partitions + groups`` rows -- and, per group, the running count of rows
   in earlier partitions.
4. rank = position in partition - first position + rows before + 1.

The rows are written to the shared scratch folder twice: as they come, so that
sampling the range bounds does not compute them again, and range-partitioned
and numbered, so that steps 3 and 4 read one layout and a lost task repeats it.

The offsets table is joined back by broadcast only when its row bound
(partitions + groups) is under ``broadcast_rows``; otherwise a shuffled join
on (partition, group), which is balanced because partitions are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import delete_path, new_scratch_path, partitions_for

_PID_SHIFT = 33  # monotonically_increasing_id: partition index << 33 | row


def rank_within(df: DataFrame, group: str, order: list[Column],
                rank_col: str = "rank", num_groups: int | None = None,
                partitions: int | None = None,
                broadcast_rows: int = 2_000_000) -> DataFrame:
    """Add ``rank_col`` = 1-based position of each row within ``group`` under
    ``order``. ``order`` must be a total order within a group (end it with a
    unique key) for the rank to be deterministic."""
    spark = df.sparkSession
    raw = new_scratch_path(spark, "rank-raw")
    df.write.parquet(raw)
    n = partitions or partitions_for(spark, raw)
    keys = [F.col(group)] + list(order)
    numbered = (spark.read.parquet(raw).repartitionByRange(n, *keys)
                .sortWithinPartitions(*keys)
                .withColumn("_rid", F.monotonically_increasing_id())
                .withColumn("_pid", F.shiftright("_rid", _PID_SHIFT)))
    path = new_scratch_path(spark, "rank")
    numbered.write.parquet(path)
    delete_path(spark, raw)
    ordered = spark.read.parquet(path)
    before = Window.partitionBy(group).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (ordered.groupBy("_pid", group)
               .agg(F.min("_rid").alias("_first"), F.count(F.lit(1)).alias("_n"))
               .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
               .select("_pid", group, "_first", "_before"))
    if num_groups is not None and n + num_groups <= broadcast_rows:
        offsets = F.broadcast(offsets)
    ranked = ordered.join(offsets, ["_pid", group])
    return (ranked.withColumn(rank_col, F.col("_rid") - F.col("_first") + F.col("_before") + 1)
            .drop("_rid", "_pid", "_first", "_before"))
