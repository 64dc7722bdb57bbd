"""Bounded summaries of tasks, combined a few at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from sift.llm.components import written

FAN_IN = 16


def in_tree(rows: DataFrame, merge, schema: str, name: str, fan_in: int = FAN_IN) -> Row | None:
    """One row from one row per task (``slot``: the task's partition), combined
    ``fan_in`` at a time by ``merge`` (key, table) -> table, whose slot is the
    key; None if no task gave a row. Each round is written."""
    rows = written(rows, name)
    last = rows.agg(F.max("slot")).first()[0]
    if last is None:
        return None
    slots = last + 1
    while True:
        slots = -(-slots // fan_in)
        rows = rows.withColumn("place", F.pmod("slot", F.lit(slots))).groupBy("place").applyInArrow(merge, schema)
        if slots == 1:
            return rows.first()
        rows = written(rows, name)
