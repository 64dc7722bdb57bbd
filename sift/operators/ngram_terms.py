"""The 1-, 2- and 3-grams in at least ``min_df`` texts, by word numbers (M1, M2).

An n-gram cannot be in more texts than the (n-1)-grams in it. So words are
counted first; then pairs of words that qualify, as one number each; then
pairs that overlap in a word and both qualify, as the first pair and the last
word. No n-gram is spelled out before it is known to qualify, and what is
shuffled are numbers with counts, summed per batch of texts. A text counts a
term once; null arrays have no terms.

``count`` gives the table (term_id from 0, term, df, level, key), commonest
first, ties by term. ``Trie`` holds it as sorted numbers, 12 bytes a term and
the words themselves, on the driver and in the Python workers; ``encode`` finds
the terms of a text in it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_scratch_path
from .ranking import rank_within

ROWS_PER_BATCH = 200  # whole texts travel, and some twenty numbers a word are held
_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
_NONE = np.empty(0, np.int64)


def bounded(df: DataFrame) -> DataFrame:
    """The frame; its session then sends few rows to Python at once."""
    conf = df.sparkSession.conf
    now = int(conf.get(_SETTING, "10000"))
    if now <= 0 or now > ROWS_PER_BATCH:
        conf.set(_SETTING, str(ROWS_PER_BATCH))
    return df


def stored(df: DataFrame, name: str) -> DataFrame:
    path = new_scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _found(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The places of the wanted numbers in sorted keys, -1 for none."""
    if not len(keys) or not len(wanted):
        return np.full(len(wanted), -1)
    distinct, back = np.unique(wanted, return_inverse=True)
    at = np.searchsorted(keys, distinct)
    at[at == len(keys)] = 0
    at[keys[at] != distinct] = -1
    return at[back]


def _once(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs without repetition, by row and key."""
    if not len(keys):
        return rows, keys
    distinct, back = np.unique(keys, return_inverse=True)
    pairs = np.unique(rows * len(distinct) + back)
    return pairs // len(distinct), distinct[pairs % len(distinct)]


@dataclass
class Trie:
    words: pa.Array                # in order
    pairs: np.ndarray = None       # first word x number of words + second word, in order
    triples: np.ndarray = None     # place of the first pair x number of words + last word, in order
    ids: tuple = ()                # term ids of the words, pairs and triples

    def levels(self, column: pa.Array, most: int = 3) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each length up to ``most``: the row and the place (of the last
        length: the key) of every n-gram whose shorter ones are known; of those
        that are known themselves, if the trie has them."""
        size = len(self.words)
        counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        rows = np.repeat(np.arange(len(counts)), counts)
        codes = pc.fill_null(pc.index_in(column.flatten(), value_set=self.words), -1).to_numpy(zero_copy_only=False)
        codes = codes.astype(np.int64)
        known = codes >= 0
        yield rows[known], codes[known]
        if most < 2 or not len(codes):
            return
        first = np.flatnonzero(known[:-1] & known[1:] & (rows[:-1] == rows[1:]))
        keys = codes[first] * size + codes[first + 1]
        if self.pairs is None:
            yield rows[first], keys
            return
        places = np.full(len(codes), -1)
        places[first] = _found(self.pairs, keys)
        some = places >= 0
        yield rows[some], places[some]
        if most < 3:
            return
        first = np.flatnonzero(some[:-1] & some[1:] & (rows[:-1] == rows[1:]))
        keys = places[first] * size + codes[np.minimum(first + 2, len(codes) - 1)]
        if self.triples is None:
            yield rows[first], keys
            return
        places = _found(self.triples, keys)
        yield rows[first[places >= 0]], places[places >= 0]

    def term_ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(row, term id) of the known terms of each row, once, in order."""
        found = [(rows, ids[places]) for ids, (rows, places) in zip(self.ids, self.levels(column))]
        return _once(np.concatenate([r for r, _ in found]), np.concatenate([t for _, t in found]).astype(np.int64))

    def spelled(self, level: int, keys: np.ndarray) -> pa.Array:
        size = len(self.words)
        if level == 1:
            return self.words.take(pa.array(keys))
        if level == 2:
            parts = [keys // size, keys % size]
        else:
            pairs = self.pairs[keys // size]
            parts = [pairs // size, pairs % size, keys % size]
        return pc.binary_join_element_wise(*[self.words.take(pa.array(p)) for p in parts], "_")

    def sent(self, spark):
        """A broadcast of the fields; their types are known to every worker."""
        return spark.sparkContext.broadcast((self.words, self.pairs, self.triples, self.ids))

    @classmethod
    def of(cls, terms: DataFrame) -> Trie:
        """From the table of ``count``, or one read back."""
        words = terms.where("level = 1").select("key", "term", "term_id").toArrow().sort_by("key")
        rest = []
        for level in (2, 3):
            table = terms.where(F.col("level") == level).select("key", "term_id").toArrow()
            keys = table["key"].to_numpy()
            order = np.argsort(keys, kind="stable")
            rest.append((keys[order], table["term_id"].to_numpy()[order].astype(np.int32)))
        return cls(pa.array(words["term"].to_pylist(), pa.string()), rest[0][0], rest[1][0],
                   (words["term_id"].to_numpy().astype(np.int32), rest[0][1], rest[1][1]))


def _word_counts(batches):
    for batch in batches:
        column = batch.column(0)
        counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        coded = column.flatten().dictionary_encode()
        known = np.asarray(coded.indices.is_valid())
        rows = np.repeat(np.arange(len(counts)), counts)[known]
        codes = coded.indices.drop_null().to_numpy().astype(np.int64)
        _, once = _once(rows, codes)
        yield pa.RecordBatch.from_arrays(
            [coded.dictionary.cast(pa.string()), pa.array(np.bincount(once, minlength=len(coded.dictionary)), pa.int64())],
            names=["term", "df"])


def _key_counts(sent, level: int):
    def run(batches):
        for batch in batches:
            rows, keys = _NONE, _NONE
            for at, (rows, keys) in enumerate(Trie(*sent.value).levels(batch.column(0), level), 1):
                if at < level:
                    rows, keys = _NONE, _NONE
            keys, df = np.unique(_once(rows, keys)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(df, pa.int64())], names=["key", "df"])

    return run


def _speller(sent):
    def run(batches):
        for batch in batches:
            levels, keys = (batch.column(k).to_numpy() for k in (0, 1))
            for level in np.unique(levels).tolist():
                at = np.flatnonzero(levels == level)
                part = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([Trie(*sent.value).spelled(level, keys[at]), *part.columns],
                                                 names=["term", *part.schema.names])

    return run


def count(words: DataFrame, min_df: float, most: int | None = None) -> DataFrame:
    """M1: the terms of a stored frame with a column ``words``; an error if
    more than ``most`` qualify."""
    spark, texts = words.sparkSession, bounded(words).select("words")

    def kept(rows: DataFrame, key: str) -> DataFrame:
        return stored(rows.groupBy(key).agg(F.sum("df").alias("df")).where(F.col("df") >= min_df), "terms")

    def checked(n: int) -> None:
        if most is not None and n > most:
            raise ValueError(f"more than {most} terms are in at least {min_df} comments; raise vocab_size or min_df")

    first = kept(texts.mapInArrow(_word_counts, "term string, df long"), "term")
    found = first.count()
    checked(found)
    known = first.toArrow().sort_by("term").combine_chunks()
    trie = Trie(pa.array(known["term"].to_pylist(), pa.string()))
    levels = [spark.createDataFrame(pa.table({
        "level": pa.array(np.ones(found), pa.int32()), "key": pa.array(np.arange(found)), "df": known["df"]}))]
    for level, name in ((2, "pairs"), (3, "triples")):
        sent = trie.sent(spark)
        rows = kept(texts.mapInArrow(_key_counts(sent, level), "key long, df long"), "key")
        found += rows.count()
        checked(found)
        levels.append(rows.select(F.lit(level).alias("level"), "key", "df"))
        if level == 2:
            trie = Trie(trie.words, np.sort(rows.select("key").toArrow()["key"].to_numpy()))
    rows = levels[0].unionByName(levels[1]).unionByName(levels[2])
    sent = trie.sent(spark)
    spelled = rows.mapInArrow(_speller(sent), "term string, level int, key long, df long")
    ranked = rank_within(spelled.withColumn("all", F.lit(0)), "all", [F.desc("df"), F.asc("term")],
                         rank_col="term_id", num_groups=1)
    return ranked.select((F.col("term_id") - 1).alias("term_id"), "term", "df", "level", "key")


def _encoder(sent):
    def run(batches):
        for batch in batches:
            rows, ids = Trie(*sent.value).term_ids(batch.column(1))
            ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=batch.num_rows))])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc", "term_ids"])

    return run


def encode(texts: DataFrame, trie: Trie) -> DataFrame:
    """M2: ``texts`` with ``term_ids``, in order, in place of ``words``."""
    others = [c for c in texts.columns if c != "words"]
    rows = bounded(texts).select(F.struct(*others).alias("doc"), "words")
    doc = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(_encoder(trie.sent(texts.sparkSession)), f"doc {doc}, term_ids array<int>").select("doc.*", "term_ids")


# Executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
