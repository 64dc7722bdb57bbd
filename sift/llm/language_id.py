"""Language identification, words first, with backoff to character n-grams.

The model holds log frequencies per language of the commonest words and of the
commonest character n-grams of each order. A word of a text that the model
knows is scored by its word frequencies; any other word is scored by the
n-grams of the longest order of which the model knows at least one in the
word, and so on down to single characters. The language with the highest sum
is predicted; the score is its posterior, from the mean log frequency of a
word times the root of the number of words (words of a text are not
independent, so the plain sum would be overconfident).

Learning: every language counts for itself, so a small one is learned beside
large ones. Counts come from at most about ``max_docs`` distinct texts of each
language (texts are taken by their hash, at the rate max_docs / distinct texts
of the language; all if there are fewer; copies count once). Counting is a
distributed aggregate. The model holds the ``max_words`` / languages commonest
words of each language, and as many n-grams of each order from ``max_grams``,
so its size is bounded and it can travel with the tasks. Only beyond
``max_langs`` labels are the rarest labels not learned.

Defined results: null texts and texts without a letter give ``und`` and score
0, as does every text if nothing was learned; rows with a null label are not
learned from, and equal texts of a language are learned from once; repeated
rows and ids are predicted row by row; ties go to the
language first in code-point order; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sift.llm.batches import bounded

UNDETERMINED = "und"
ORDERS = (4, 3, 2, 1)  # n-gram orders, longest first
MEMO_LIMIT = 300_000

_LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(text: str | None) -> list[str]:
    """Lower-case runs of letters; none if the text has no letter."""
    words = _LETTERS.findall(unicodedata.normalize("NFC", text).lower()) if text else []
    if words and not any(map(str.isalpha, words)):  # e.g. superscripts and vulgar fractions
        words = [w for w in words if any(map(str.isalpha, w))]
    return words


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of a word between boundary marks."""
    marked = f" {word} " if n > 1 else word
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


@dataclass
class LanguageModel:
    """Log frequencies over ``langs``: by n-gram order (0: words) the row of
    each part in the order's matrix."""

    langs: list[str]
    rows: dict[int, dict[str, int]]
    logs: dict[int, np.ndarray]

    def word_vector(self, word: str) -> np.ndarray | None:
        for n in (0, *ORDERS):
            rows = self.rows.get(n, {})
            parts = [word] if n == 0 else grams_of(word, n)
            found = [k for p in parts if (k := rows.get(p)) is not None]
            if found:
                return self.logs[n][found].mean(axis=0)
        return None

    def predict(self, words: list[str], memo: dict) -> tuple[str, float]:
        """Language and score of a text's words; memo keeps word vectors."""
        if not words or not self.langs:
            return UNDETERMINED, 0.0
        rows = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
        rows = rows[rows >= 0]
        if not len(rows):  # letters of no learned script: the languages tie
            return self.langs[0], 1.0 / len(self.langs)
        total = memo.matrix[rows].sum(axis=0) / np.sqrt(len(rows))
        odds = np.exp(total - total.max())
        best = int(np.argmax(total))
        return self.langs[best], float(odds[best] / odds.sum())


class _Memo(dict):
    """Word to its row in ``matrix``; -1 for words without any known part."""

    def __init__(self, model: LanguageModel):
        super().__init__()
        self.model, self.used = model, 0
        self.matrix = np.zeros((1024, max(1, len(model.langs))))

    def __missing__(self, word: str) -> int:
        vector = self.model.word_vector(word)
        row = -1
        if vector is not None:
            if self.used == len(self.matrix):
                self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
            row, self.used = self.used, self.used + 1
            self.matrix[row] = vector
        self[word] = row
        return row

    def trim(self) -> None:
        if len(self) >= MEMO_LIMIT:
            self.clear()
            self.used = 0


def _count_parts(batches):
    """Per task: how often each word and n-gram occurs in each language. The
    n-grams are counted once per distinct word, times its count."""
    words: dict[str, Counter] = {}

    def flush():
        rows = []
        for lang, counter in words.items():
            grams: Counter = Counter()
            for word, c in counter.items():
                for n in ORDERS:
                    for g in grams_of(word, n):
                        grams[n, g] += c
            rows += [(0, word, lang, c) for word, c in counter.items()]
            rows += [(n, g, lang, c) for (n, g), c in grams.items()]
        cols = list(zip(*rows)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.string()),
             pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64())],
            names=["n", "part", "lang", "count"])

    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words.setdefault(lang, Counter()).update(letter_words(text))
            if sum(map(len, words.values())) > 100_000:
                yield flush()
                words = {}
    yield flush()


def _sampled(rows: DataFrame, max_docs: int, max_langs: int) -> tuple[DataFrame, list[str]]:
    """Distinct (text, lang) of every language's sample, and the languages."""
    sizes = (rows.groupBy("lang").agg(F.approx_count_distinct("text").alias("texts"))
             .orderBy(F.desc("texts"), "lang").limit(max_langs).collect())
    # The estimate of the number of texts is good to some percent.
    rates = {r.lang: int(1e6 * max_docs / max(1, r.texts)) if r.texts > max_docs else 1_000_000 for r in sizes}
    if not rates:
        return rows.limit(0), []
    rate = F.create_map(*[F.lit(x) for item in rates.items() for x in item])
    taken = rows.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < F.try_element_at(rate, "lang"))
    return taken.distinct(), sorted(rates)


def learn(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang",
          max_docs: int = 5_000, max_words: int = 30_000, max_grams: int = 20_000,
          max_langs: int = 200, smoothing: float = 0.5) -> LanguageModel:
    """Learn from rows with a non-null label; see the module for the bounds."""
    rows = (bounded(labelled).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
            .where("lang is not null and text is not null"))
    sample, labels = _sampled(rows, max_docs, max_langs)
    counts = (sample.mapInArrow(_count_parts, "n int, part string, lang string, count long")
              .groupBy("n", "part", "lang").agg(F.sum("count").alias("count")).persist())
    try:
        totals = {(r.n, r.lang): r.total for r in counts.groupBy("n", "lang")
                  .agg(F.sum("count").alias("total")).collect()}
        langs = [x for x in labels if (0, x) in totals]
        share = F.when(F.col("n") == 0, -(-max_words // max(1, len(langs)))).otherwise(
            -(-max_grams // max(1, len(langs))))
        place = F.row_number().over(Window.partitionBy("n", "lang").orderBy(F.desc("count"), "part"))
        chosen = counts.withColumn("place", place).where(F.col("place") <= share).select("n", "part").distinct()
        parts = counts.join(chosen, ["n", "part"], "left_semi").groupBy("n", "part").agg(
            *[F.sum(F.when(F.col("lang") == x, F.col("count")).otherwise(0)).alias(f"l{k}")
              for k, x in enumerate(langs)], F.count("*").alias("held"))
        known = parts.orderBy("n", "part").toArrow()  # at most max_words + 4 x max_grams, rounded up
        order = known["n"].to_numpy()
        names = known["part"].to_pylist()
        seen = np.array([known[f"l{k}"].to_numpy() for k in range(len(langs))], float).T
        places, logs = {}, {}
        for n in (0, *ORDERS):
            at = np.flatnonzero(order == n)
            size = np.array([totals.get((n, x), 0) for x in langs]) + smoothing * (len(at) + 1)
            places[n] = {names[i]: k for k, i in enumerate(at.tolist())}
            logs[n] = np.log((seen[at] + smoothing) / size) if langs else np.zeros((0, 0))
    finally:
        counts.unpersist()
    return LanguageModel(langs, places, logs)


def predict(docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` per row of ``docs``."""

    def run(batches):
        memo = _Memo(model)
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(1).to_pylist():
                memo.trim()
                lang, score = model.predict(letter_words(text), memo)
                langs.append(lang)
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return (bounded(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double"))


def held_out(id_col: str, buckets: int, bucket: int) -> Column:
    """Rows kept for testing: crc32 of the id as text, modulo ``buckets``; a
    null id is not held out."""
    remainder = F.crc32(F.col(id_col).cast("string")) % buckets
    return F.coalesce(remainder == bucket, F.lit(False))
