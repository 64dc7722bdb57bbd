"""Exact removal of repeated word windows, behind a count-min prefilter.

A window is ``window`` consecutive words of one text. Every word goes that is
covered by a window whose words also start in a document with a smaller id;
windows are judged on the input.

First pass: every window is keyed by the smallest hash among its short word
grams. Equal windows have equal keys, and neighbouring windows mostly share
one, so a text has about one key per ``window`` / 2 words. Each task sketches
its keys (once per text) into the cells of a count-min table of two rows; the
partition sketches are merged by an aggregate. The merged counts are never too
low, so a window with a cell counted once is in one text only. The table has
four cells per estimated key and row, up to ``max_cells``; its cells counted
at least twice travel as bitmaps of at most ``max_cells`` / 4 bytes. Above that
bound the filter lets more windows through, and the result stays the same.

Second pass: windows with all cells counted twice are grouped exactly, by 96
bits of two hashes of their words, to find the smallest id. A window that a
text repeats is one row of that text, with all its places, so a group has at
most one row per text. Windows whose key is estimated in fewer than
``hot_texts`` texts (estimates are never too low) make groups below that size
and are judged within their group after one shuffle. Windows of hotter keys
are first reduced per task to their smallest id, and joined back, which Spark
can split; so no group of copies meets in one task.

Defined results: null and empty texts, and texts shorter than a window, lose
nothing; rows with a null id keep all words and remove none elsewhere; rows
with equal ids do not remove each other's words, and each row is judged by its
own text; other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sift.llm.batches import bounded
from sift.llm.shingles import (covered_words, hashed_runs, mix, sliding_min, whole_windows,
                               window_hashes, words_of)

_GRAM = 8  # words of the grams that key a window
_SECOND = np.uint64(0xD6E8FEB86659FD93)
_BITS = 32768  # of a bitmap row


def _keys(hashes: np.ndarray, window: int) -> np.ndarray:
    gram = min(_GRAM, window)
    return sliding_min(mix(window_hashes(hashes, gram)), window - gram + 1)


def _cells(keys: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each key in the first row, and in the second, which follows."""
    last = np.uint64(width - 1)
    return ((keys & last).astype(np.int64),
            (mix(keys ^ _SECOND) & last).astype(np.int64) + width)


def _sketcher(window: int, width: int):
    """Counts of the cells, once per text and key, summed per task."""

    def run(batches):
        pending = []
        for batch in batches:
            for _, counts, hashes in hashed_runs(batch.column(0).to_pylist()):
                whole = whole_windows(counts, window)
                if not whole.any():
                    continue
                text = np.repeat(np.arange(len(counts)), counts)[:len(whole)]
                keys = _keys(hashes, window)
                new = whole.copy()  # where the key differs from the one before it
                new[1:] &= (keys[1:] != keys[:-1]) | (text[1:] != text[:-1]) | ~whole[:-1]
                keys, text = keys[new], text[new]
                order = np.lexsort((keys, text))
                keys, text = keys[order], text[order]
                once = np.ones(len(keys), np.bool_)
                once[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
                pending.extend(_cells(keys[once], width))
            if sum(map(len, pending)) > 2_000_000:
                yield _summed(pending)
                pending = []
        yield _summed(pending)

    return run


def _summed(pending: list[np.ndarray]) -> pa.RecordBatch:
    cells, counts = np.unique(np.concatenate([*pending, np.empty(0, np.int64)]), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts, pa.int64())],
                                      names=["cell", "n"])


class _Sketch:
    """Bitmaps of the cells counted at least twice, and at least ``hot``."""

    def __init__(self, window: int, width: int, repeated: np.ndarray, hot: np.ndarray | None):
        self.window, self.width, self.repeated, self.hot = window, width, repeated, hot

    @staticmethod
    def _set(bitmap: np.ndarray, cells: np.ndarray) -> np.ndarray:
        return (bitmap[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 == 1

    def flags(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every window start: estimated repeated, and estimated hot."""
        first, second = _cells(_keys(hashes, self.window), self.width)
        repeated = self._set(self.repeated, first) & self._set(self.repeated, second)
        if self.hot is None:
            return repeated, np.zeros(len(repeated), np.bool_)
        return repeated, self._set(self.hot, first) & self._set(self.hot, second)


def _bitmap(cells: DataFrame, at_least: int, width: int) -> np.ndarray | None:
    rows = (cells.where(F.col("n") >= at_least)
            .groupBy(F.bitmap_bucket_number(F.col("cell") + 1).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("cell") + 1)).alias("bits"))
            .toArrow())
    if not rows.num_rows:
        return None
    bitmap = np.zeros(max(1, 2 * width // _BITS) * (_BITS // 8), np.uint8)
    size = _BITS // 8
    for bucket, bits in zip(rows["bucket"].to_pylist(), rows["bits"].to_pylist()):
        bitmap[(bucket - 1) * size:bucket * size] = np.frombuffer(bits, np.uint8)
    return bitmap


def _sketch(texts: DataFrame, window: int, hot_texts: int, max_cells: int) -> _Sketch | None:
    """None if no window is estimated repeated."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    keys = max(1, size // 6 // (window // 2))  # about 6 bytes a word, 2 keys a window
    width = min(max_cells, 1 << max(15, (4 * keys - 1).bit_length()))
    cells = (texts.select(F.col("text").cast("binary")).mapInArrow(_sketcher(window, width),
                                                                   "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).where("n > 1").persist())
    try:
        repeated = _bitmap(cells, 2, width)
        hot = None if repeated is None else _bitmap(cells, hot_texts, width)
    finally:
        cells.unpersist()
    return None if repeated is None else _Sketch(window, width, repeated, hot)


def _distinct(one: np.ndarray, two: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the windows by text and hashes, equal ones by place, and
    where in it each distinct window of a text begins."""
    order = np.lexsort((two, one, text))
    new = np.zeros(len(order), np.bool_)
    new[0] = True
    for column in (one[order], two[order], text[order]):
        new[1:] |= column[1:] != column[:-1]
    return order, np.flatnonzero(new)


def _later(starts: np.ndarray, heads: np.ndarray) -> list[bytes | None]:
    """Of every distinct window, its starts but the first; null without any."""
    ends = np.append(heads[1:], len(starts))
    later = starts.astype(np.int32)
    return [later[a + 1:b].tobytes() if b - a > 1 else None for a, b in zip(heads.tolist(), ends.tolist())]


def _emitter(sketch: _Sketch, hot: bool):
    """Rows of the flagged windows that are hot or not, once per text: two
    hashes, id, first place and tag, later places."""

    def run(batches):
        window = sketch.window
        for batch in batches:
            ids, tags = batch.column(0), batch.column(2).to_numpy(zero_copy_only=False)
            for first, counts, hashes in hashed_runs(batch.column(1).to_pylist()):
                repeated, is_hot = sketch.flags(hashes)
                take = np.flatnonzero(repeated & (is_hot == hot) & whole_windows(counts, window))
                if not len(take):
                    continue
                one = window_hashes(hashes, window)[take]
                two = window_hashes(mix(hashes ^ _SECOND), window)[take] >> np.uint64(32)
                ends = np.cumsum(counts)
                text = np.searchsorted(ends, take, "right")
                start = take - (ends - counts)[text]
                order, heads = _distinct(one, two, text)
                top, first_of = order[heads], first + text[order[heads]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one[top].view(np.int64)), pa.array(two[top].astype(np.uint32).view(np.int32)),
                     ids.take(pa.array(first_of)), pa.array((start[top] << 32) | tags[first_of]),
                     pa.array(_later(start[order], heads), pa.binary())],
                    names=["h1", "h2", "doc_id", "place", "more"])

    return run


def _covered(texts: DataFrame, sketch: _Sketch, id_type: str) -> DataFrame:
    """(doc_id, place, more) of the windows that also start under a smaller id."""
    schema = f"h1 long, h2 int, doc_id {id_type}, place long, more binary"
    known = texts.where(F.col("doc_id").isNotNull()).select(
        "doc_id", F.col("text").cast("binary").alias("text"), "tag")
    same = Window.partitionBy("h1", "h2")
    cold = (known.mapInArrow(_emitter(sketch, False), schema)
            .withColumn("least", F.min("doc_id").over(same)))
    covered = cold.where("doc_id > least").select("doc_id", "place", "more")
    if sketch.hot is None:
        return covered
    hot = known.mapInArrow(_emitter(sketch, True), schema)
    least = (hot.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
             .where("least < most").select("h1", "h2", "least"))
    return covered.unionByName(
        hot.join(least.hint("merge"), ["h1", "h2"]).where("doc_id > least")
        .select("doc_id", "place", "more"))


def _remover(window: int):
    def run(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, starts, more in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                words = words_of(text)
                n_words.append(len(words))
                gone = 0
                if starts:
                    places = [np.array(starts, np.int32), *(np.frombuffer(m, np.int32) for m in more)]
                    mask = covered_words(np.concatenate(places).astype(np.int64), window, len(words))
                    gone = int(mask.sum())
                    words = [w for w, m in zip(words, mask.tolist()) if not m]
                n_removed.append(gone)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"])

    return run


def dedup_substrings(docs: DataFrame, *, window: int = 50, hot_texts: int = 1000,
                     max_cells: int = 1 << 29, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed`` and
    ``kept_text``, the kept words joined by one space."""
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = bounded(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    tag: Column = F.hash("text").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    sketch = _sketch(texts.where(F.col("doc_id").isNotNull()), window, hot_texts, max_cells)
    if sketch is None:
        joined = texts.select("doc_id", "text", F.array().cast("array<int>").alias("starts"),
                              F.array().cast("array<binary>").alias("more"))
    else:
        covered = _covered(texts.withColumn("tag", tag), sketch, id_type)
        by_text = covered.groupBy("doc_id", F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).alias("tag")).agg(
            F.collect_list(F.shiftright("place", 32).cast("int")).alias("starts"),
            F.collect_list("more").alias("more"))
        joined = (texts.withColumn("tag", tag).join(by_text, ["doc_id", "tag"], "left")
                  .select("doc_id", "text", "starts", "more"))
    return joined.select("doc_id", F.col("text").cast("binary").alias("text"), "starts", "more").mapInArrow(
        _remover(window), f"doc_id {id_type}, n_words long, n_removed long, kept_text string")
