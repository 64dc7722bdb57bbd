"""Terms of at least ``min_df`` rows, behind a count-min prefilter (M1, A1).

Most n-grams occur once, and a plain grouped count shuffles every one of them
to drop it. Here a first pass adds a hash of every term to Spark's own
count-min sketches, one per part of the hash space, which are combined per
task; a task shuffles at most ``PARTS`` rows, whatever the number of its
terms. A sketch never counts too low, so a term with a cell below ``min_df``
is below ``min_df`` itself and stays in its task in the second pass, which
counts the others exactly. What the sketch lets through by chance is dropped
by the exact count, so the result is that of the plain count.

Bounds: the sketches have ``COUNTERS / min_df`` cells a term occurrence and
row, two rows, at most ``max_cells`` cells a row: 16 x ``max_cells`` bytes in
a task. The cells that reach ``min_df`` are broadcast as bits, at most
``max_cells`` / 4 bytes. Beyond the occurrences that ``max_cells`` is good for
(1.6 x 10^7 at the default and ``min_df`` 10) the sketch would fill up and
refute little; the plain count is returned then, and raising ``max_cells``
moves that point.

Terms are compared by value; null terms are dropped; a term counts once per
row of the input, so rows must hold each pair of document and term once.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = 64         # sketches; fewer than the keys at which Spark sorts instead of hashing
COUNTERS = 2.5     # cells x min_df of a row of the sketch, per occurrence
_ITEM = (1 << 31) - 1
_SEED = 17


def _plain(rows: DataFrame, min_df: float) -> DataFrame:
    return (rows.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
            .where(F.col("df") >= min_df))


def _hashed(rows: DataFrame) -> DataFrame:
    """Rows with the part of a term and its 31-bit item in that part's sketch."""
    code = F.xxhash64("term")
    return (rows.withColumn("_item", code.bitwiseAND(F.lit(_ITEM)))
            .withColumn("_part", F.shiftrightunsigned(code, 40).bitwiseAND(F.lit(PARTS - 1)).cast("int")))


def _read_sketch(sketch: bytes) -> tuple[list[int], np.ndarray]:
    """Hash factors and count table of version 1 of Spark's binary format:
    version, total, depth, width, factors, counts, all big-endian."""
    version, = np.frombuffer(sketch, ">i4", 1)
    if version != 1:
        raise ValueError(f"count-min sketch of version {version}")
    depth, width = (int(x) for x in np.frombuffer(sketch, ">i4", 2, 12))
    factors = np.frombuffer(sketch, ">i8", depth, 20)
    counts = np.frombuffer(sketch, ">i8", depth * width, 20 + 8 * depth)
    return factors.tolist(), counts.reshape(depth, width)


def _cells_above(min_df: float):
    """Per sketch: its factors, its width, and per row the bits of the cells
    that reach ``min_df``."""

    def run(batches):
        for batch in batches:
            read = [_read_sketch(s) for s in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f for f, _ in read], pa.list_(pa.int64())),
                 pa.array([c.shape[1] for _, c in read], pa.int64()),
                 pa.array([[np.packbits(row >= min_df, bitorder="little").tobytes() for row in c]
                           for _, c in read], pa.list_(pa.binary()))],
                names=["_part", "_factors", "_width", "_bits"])

    return run


def _is_set(factor: Column, bits: Column) -> Column:
    """The bit of ``_item`` in one row: the sketch's own hash of a long, whose
    product cannot overflow for items and factors below 2^31."""
    product = factor * F.col("_item")
    cell = (product + F.shiftright(product, 32)).bitwiseAND(F.lit(_ITEM)) % F.col("_width")
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(cell, 3) + 1).cast("int"), F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), cell.bitwiseAND(F.lit(7)).cast("int")) == 1


def candidates(rows: DataFrame, min_df: float, width: int) -> DataFrame:
    """The ``rows`` (term, ...) whose term the sketches, of ``width`` cells a
    row, count at least ``min_df`` times. Reads ``rows`` twice."""
    hashed = _hashed(rows)
    sketches = hashed.groupBy("_part").agg(
        # two rows: the least number that fails with a probability below 0.3
        F.count_min_sketch("_item", F.lit(2.0 / width), F.lit(0.7), F.lit(_SEED)).alias("sketch"))
    cells = sketches.mapInArrow(_cells_above(min_df),
                                "_part int, _factors array<long>, _width long, _bits array<binary>")
    # PARTS rows of width / 4 bytes.
    kept = hashed.join(F.broadcast(cells), "_part").where(
        _is_set(F.get("_factors", F.lit(0)), F.get("_bits", F.lit(0)))
        & _is_set(F.get("_factors", F.lit(1)), F.get("_bits", F.lit(1))))
    return kept.select(*rows.columns)


def frequent_terms(rows: DataFrame, min_df: float, occurrences: int, *,
                   max_cells: int = 1 << 22) -> DataFrame:
    """(term, df) of the terms in at least ``min_df`` of ``rows``, a frame
    with a column ``term`` that is cheap to read twice; ``occurrences`` is its
    number of rows or an upper bound (a wrong one costs time, not rows)."""
    terms = rows.select("term").where(F.col("term").isNotNull())
    wanted = int(COUNTERS * occurrences / min_df) if min_df > 1 else 0
    if not wanted or wanted > max_cells:
        return _plain(terms, min_df)
    width = max(64, 1 << max(0, -(-wanted // PARTS) - 1).bit_length())
    return _plain(candidates(terms, min_df, width), min_df)


# Executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
