"""Counts of words and n-grams, summed per Arrow batch before they are grouped.

A grouped count of exploded words hashes and copies every occurrence in the
JVM. Here a task numbers the words of some texts by their values, counts equal
numbers in numpy and hands on one row per distinct term (and text); the grouped
sum that follows is exact, whatever the batches hold.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = 500_000  # words counted at a time, or one text


def _runs(words: pa.ListArray, limit: int):
    """(first row, row count) of slices of about ``limit`` words."""
    total = np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(words):
        done = total[first - 1] if first else 0
        rows = max(1, int(np.searchsorted(total, done + limit, "right")) - first)
        yield first, rows
        first += rows


def _per_text(batches):
    for batch in batches:
        for first, rows in _runs(batch.column(1), WORDS):
            ids, words = batch.column(0).slice(first, rows), batch.column(1).slice(first, rows)
            coded = words.flatten().dictionary_encode()
            if not len(coded):
                continue
            size = len(coded.dictionary)
            text = pc.list_parent_indices(words).to_numpy().astype(np.int64)
            keys, counts = np.unique(text * size + coded.indices.to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(keys // size)), coded.dictionary.take(pa.array(keys % size)),
                 pa.array(counts, pa.int64())], names=["id", "term", "n"])


def _grams(n: int):
    def run(batches):
        for batch in batches:
            for first, rows in _runs(batch.column(0), WORDS):
                lists = batch.column(0).slice(first, rows)
                words, text = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
                size = len(words) - n + 1
                if size < 1:
                    continue
                grams = words if n == 1 else pc.binary_join_element_wise(
                    *[words.slice(k, size) for k in range(n)], "_")
                counted = grams.filter(pa.array(text[n - 1:] == text[:size])).value_counts()
                yield pa.RecordBatch.from_arrays([counted.field("values"), counted.field("counts")],
                                                 names=["term", "n"])

    return run


def per_text(texts: DataFrame) -> DataFrame:
    """(id, term, count) from (id, words), words of rows with the same id together."""
    id_type = texts.schema["id"].dataType.simpleString()
    return (texts.select("id", "words").mapInArrow(_per_text, f"id {id_type}, term string, n long")
            .groupBy("id", "term").agg(F.sum("n").alias("count")))


def ngram_counts(texts: DataFrame, n: int) -> DataFrame:
    """(term, n) of the n-grams of ``words``, joined by ``_``."""
    return (texts.select("words").mapInArrow(_grams(n), "term string, n long")
            .groupBy("term").agg(F.sum("n").alias("n")))


# Executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
