"""Load catalog files that hold bad rows.

The reference's ``\\copy`` stops at the first row that breaks the table
definition. Here such rows go to a table of rejects with their reason, and the
rest loads. Reasons, the first that holds:

* ``bad row``: not the table's number of fields;
* ``missing key``: a key column is null;
* ``bad value``: a number that is none;
* ``too long``: a text above its VARCHAR length;
* ``duplicate key``: a further row of a key; the least row of a key by its other
  columns stays, so the choice does not depend on the order of the file;
* ``orphan``: a reference to a parent row that was not accepted (null is none).

Equal rows are counted before any key meets in one task, and a key's rows only
as a minimum and a count, so a key that fills the file is one row per task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files
from ..sources.schemas import MAX_LENGTH

KEYS = {"artist": ["artist_id"], "song": ["song_id"], "token": ["song_id", "token"]}
PARENT_KEYS = {"song": ("artist_id", "artist_id")}  # column, column of the parent


@dataclass
class Loaded:
    accepted: DataFrame  # the table, typed
    rejects: DataFrame   # (table_name, key, reason, copies)


def check(raw: DataFrame, table: str, parent: DataFrame | None = None) -> Loaded:
    """``raw`` holds the table's columns as text and ``_corrupt_record``;
    ``parent`` is the accepted table that the foreign key names."""
    fields, keys = files.CATALOG[table].fields, KEYS[table]
    names = [f.name for f in fields]

    def some(conditions):
        return reduce(lambda a, b: a | b, conditions, F.lit(False))

    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in fields}
    reason = (F.when(F.col("_corrupt_record").isNotNull(), "bad row")
              .when(some(F.col(k).isNull() for k in keys), "missing key")
              .when(some(F.col(n).isNotNull() & t.isNull() for n, t in typed.items()), "bad value")
              .when(some(F.length(c) > size for (t, c), size in MAX_LENGTH.items() if t == table), "too long"))
    text = F.concat_ws("/", *keys)
    failed = (raw.where(reason.isNotNull()).groupBy(text.alias("key"), reason.alias("reason"))
              .agg(F.count(F.lit(1)).alias("copies")))
    others = [n for n in names if n not in keys]
    equal = raw.where(reason.isNull()).select(*[t.alias(n) for n, t in typed.items()]) \
        .groupBy(*names).agg(F.count(F.lit(1)).alias("copies"))
    first = equal.groupBy(*keys).agg(F.min(F.struct(*others)).alias("kept"), F.sum("copies").alias("copies"))
    as_text = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    failed = failed.unionByName(first.where("copies > 1").select(
        as_text.alias("key"), F.lit("duplicate key").alias("reason"), (F.col("copies") - 1).alias("copies")))
    accepted = first.select(*[F.col(k) if k in keys else F.col(f"kept.{k}").alias(k) for k in names])
    if parent is not None:
        column, parent_key = PARENT_KEYS[table]
        known = parent.select(F.col(parent_key).alias("_parent"))
        joined = accepted.join(known, F.col(column) == F.col("_parent"), "left")
        orphan = F.col(column).isNotNull() & F.col("_parent").isNull()
        failed = failed.unionByName(joined.where(orphan).select(
            as_text.alias("key"), F.lit("orphan").alias("reason"), F.lit(1).cast("long").alias("copies")))
        accepted = joined.where(~orphan).select(*names)
    return Loaded(accepted, failed.select(F.lit(table).alias("table_name"), "key", "reason", "copies"))


def load(spark: SparkSession, path: str, table: str, out: str, parent: DataFrame | None = None) -> Loaded:
    """Load the CSV at ``path``; the rows read, the table and the rejects are
    stored under ``out``, so the file is parsed once."""
    files.read_raw_table(spark, path, table).write.mode("overwrite").parquet(f"{out}/{table}-raw")
    found = check(spark.read.parquet(f"{out}/{table}-raw"), table, parent)
    found.accepted.write.mode("overwrite").parquet(f"{out}/{table}")
    found.rejects.write.mode("overwrite").parquet(f"{out}/{table}-rejects")
    return Loaded(spark.read.parquet(f"{out}/{table}"), spark.read.parquet(f"{out}/{table}-rejects"))
