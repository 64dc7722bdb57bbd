"""Arrow batches of bounded size for the Python operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_BATCH = 1000
_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded(df: DataFrame) -> DataFrame:
    """The frame; its session then sends at most ``ROWS_PER_BATCH`` rows to
    Python at once. Whole texts travel, so Spark's default of 10,000 rows would
    take hundreds of MB per task. A lower setting stays."""
    conf = df.sparkSession.conf
    now = int(conf.get(_SETTING, "10000"))
    if now <= 0 or now > ROWS_PER_BATCH:
        conf.set(_SETTING, str(ROWS_PER_BATCH))
    return df


def packed(docs: DataFrame) -> Column:
    """All columns as one struct ``doc``, so that their names cannot clash with
    those of an operator."""
    return F.struct(*docs.columns).alias("doc")


def field_of(doc: pa.StructArray, name: str) -> pa.Array:
    """A column of the packed rows."""
    return doc.flatten()[doc.type.get_field_index(name)]


def with_field(doc: pa.StructArray, name: str, values: pa.Array) -> pa.StructArray:
    """The packed rows with one column replaced."""
    columns, at = doc.flatten(), doc.type.get_field_index(name)
    columns[at] = values
    return pa.StructArray.from_arrays(columns, fields=list(doc.type))
