"""Daily sentiment shares, maintained incrementally with Structured Streaming.

The reference computes its day table once over a fixed dump. Comments keep
arriving, so the same conditional aggregate also runs as a streaming query
over a folder of scored comments (``id, created_utc, pos, neg``):

    readStream (files)  ->  date = UTC day of created_utc
                        ->  group by date: count, sum(pos), sum(neg)   (state)
                        ->  complete output, each micro-batch written whole

State holds one row per day, so it stays small however many comments
arrive. Each micro-batch writes the full current table under its own id;
replaying a batch after a failure rewrites the same folder. Readers take the
latest complete batch (``read_shares``), so there is always a whole table to
read. The checkpoint lives in the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.sentiment import _shares, with_date
from ..session import delete_path, file_system


def daily_counts(stream: DataFrame) -> DataFrame:
    """Streaming (date, count, pos_count, neg_count)."""
    return (with_date(stream).where(F.col("date").isNotNull())
            .groupBy("date")
            .agg(F.count(F.lit(1)).alias("count"),
                 F.sum("pos").cast("long").alias("pos_count"),
                 F.sum("neg").cast("long").alias("neg_count")))


def finish(counts: DataFrame, keep_all: bool = False) -> DataFrame:
    """Shares from counts; drop days lacking a positive or a negative."""
    if not keep_all:
        counts = counts.where((F.col("pos_count") > 0) & (F.col("neg_count") > 0))
    return _shares(counts)


def _batches(spark: SparkSession, output_path: str) -> list[int]:
    """Ids of the completely written batches."""
    fs, path = file_system(spark, output_path)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch=")
                  and fs.exists(file_system(spark, f"{output_path}/{n}/_SUCCESS")[1]))


def read_shares(spark: SparkSession, output_path: str) -> DataFrame:
    """The table of the latest complete batch; no rows before the first."""
    batches = _batches(spark, output_path)
    if not batches:
        return finish(spark.createDataFrame([], "date date, count long, pos_count long, neg_count long"))
    return spark.read.parquet(f"{output_path}/batch={batches[-1]}")


def run_share_by_day(spark: SparkSession, source_dir: str, schema: StructType,
                     output_path: str, checkpoint: str, keep_all: bool = False,
                     available_now: bool = True):
    """Start the streaming query; with ``available_now`` it processes every
    file present and stops. Returns the StreamingQuery."""
    stream = spark.readStream.schema(schema).parquet(source_dir)

    def publish(batch: DataFrame, batch_id: int) -> None:
        finish(batch, keep_all).write.mode("overwrite").parquet(f"{output_path}/batch={batch_id}")
        # The table before this one stays for readers that have opened it.
        for old in _batches(spark, output_path):
            if old < batch_id - 1:
                delete_path(spark, f"{output_path}/batch={old}")

    writer = (daily_counts(stream).writeStream
              .outputMode("complete")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(publish))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="1 minute")
    return writer.start()
