"""Paired logistic-regression sentiment classifiers.

The reference: clean labelled comments into n-grams, binary CountVectorizer
(minDF 10), two logistic regressions (positive: label 1, negative: label -1)
tuned by 5-fold cross-validation over regParam [1.0], maxIter 10; then score
comments with both models on one frame and threshold P(class 1) at 0.2 and
0.25.

Differences: splits and folds are seeded hashes of the row key; each model writes its own
probability / prediction columns, so both score one frame without dropping
columns in between; the vectorizer is saved with the models (the reference
refits it on every run, which can shift feature indices under a loaded
model); the held-out half is actually evaluated.

Scale: terms are counted by word numbers (``ngram_terms``); only those that qualify
become the vectorizer's vocabulary. A text is its term ids, kept in the shared
folder. All folds and the final fit of a side are trained together on blocks of
terms (``term_blocks``), with spark.ml's objective and L-BFGS, so that no vector of the
vocabulary's length is held in a fit. The driver holds a number of 12 bytes a
term for the vocabulary, 8 a side for the coefficients, and what ``term_blocks``
states per labelled text; training stops with an error if more than ``vocab_size``
terms qualify, so no term is dropped unseen. ``vocabulary``, ``vectorizer.model`` and
``bestModel`` make spark.ml's own objects of them, on demand.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.flags import (NEGATIVE_THRESHOLD, POSITIVE_THRESHOLD, above,
                               negative_flag, positive_flag)
from ..functions.text import clean_words, explode_terms, ngram_features
from . import ngram_terms, term_blocks
from .ngram_terms import Trie, bounded, stored

# --- fixed values (must equal the reference's for identical results) -------
MIN_DF = 10.0
MAX_ITER = 10
REG_PARAMS = [1.0]
NUM_FOLDS = 5
# ---------------------------------------------------------------------------

VOCAB_SIZE = 1 << 24
PARALLEL_FITS = 12
FIT_VALUES = 1 << 21  # coefficients of all concurrent fits: some 400 MB of the driver

SIDES = {"pos": "positive", "neg": "negative"}


class NgramVectorizer:
    """M1, M2: the table of ``ngram_terms.count``, stored."""

    def __init__(self, terms: DataFrame, min_df: float, size: int | None = None, source: str | None = None):
        self.terms, self.min_df, self.source = terms, min_df, source
        self.size = terms.count() if size is None else size

    @cached_property
    def trie(self) -> Trie:
        return Trie.of(self.terms)

    @property
    def vocabulary(self) -> list[str]:
        return self.terms.select("term_id", "term").toArrow().sort_by("term_id")["term"].to_pylist()

    def getMinDF(self) -> float:  # noqa: N802
        return self.min_df

    @cached_property
    def model(self) -> CountVectorizerModel:
        return CountVectorizerModel.from_vocabulary(self.vocabulary, inputCol="features", outputCol="counts",
                                                    binary=True)._set(minDF=self.min_df)

    def transform(self, df: DataFrame) -> DataFrame:
        """``words`` become ``term_ids``; beside ``features`` come spark.ml's vectors."""
        return ngram_terms.encode(df, self.trie) if "words" in df.columns else self.model.transform(df)

    def save(self, path: str) -> None:
        if path != self.source:
            self.terms.write.mode("overwrite").parquet(f"{path}/terms")
            _write_facts(self.terms.sparkSession, f"{path}/metadata", min_df=self.min_df, size=self.size)

    @classmethod
    def load(cls, path: str) -> "NgramVectorizer":
        spark = SparkSession.builder.getOrCreate()
        facts = spark.read.parquet(f"{path}/metadata").first()
        return cls(spark.read.parquet(f"{path}/terms"), facts["min_df"], facts["size"], path)


def _write_facts(spark: SparkSession, path: str, **facts) -> None:
    spark.createDataFrame(pa.table({k: [v] for k, v in facts.items()})).coalesce(1).write.mode("overwrite").parquet(path)


@dataclass
class SideModel:
    """A classifier: its coefficients (term_id, weight) in a stored table."""

    side: str
    table: DataFrame
    numFeatures: int  # noqa: N815
    intercept: float
    regParam: float  # noqa: N815
    maxIter: int  # noqa: N815
    avgMetrics: list[float]  # noqa: N815
    source: str | None = None

    @cached_property
    def weights(self) -> np.ndarray:
        rows, out = self.table.select("term_id", "weight").toArrow(), np.zeros(self.numFeatures)
        out[rows["term_id"].to_numpy()] = rows["weight"].to_numpy()
        return out

    @cached_property
    def bestModel(self) -> LogisticRegressionModel:  # noqa: N802
        from pyspark.ml.common import _py2java
        sc = self.table.sparkSession.sparkContext
        lr = _estimator(self.side, self.maxIter)
        java = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
            lr.uid, _py2java(sc, Vectors.dense(self.weights)), self.intercept)
        model = lr._copyValues(LogisticRegressionModel(java), {lr.regParam: self.regParam})
        return model

    def transform(self, df: DataFrame) -> DataFrame:
        """spark.ml's columns, from its vectors."""
        return self.bestModel.transform(df)

    def save(self, path: str) -> None:
        if path != self.source:
            self.table.write.mode("overwrite").parquet(f"{path}/weights")
            _write_facts(self.table.sparkSession, f"{path}/metadata", side=self.side, features=self.numFeatures,
                         intercept=self.intercept, reg=self.regParam, max_iter=self.maxIter, metrics=self.avgMetrics)

    @classmethod
    def load(cls, path: str) -> "SideModel":
        spark = SparkSession.builder.getOrCreate()
        m = spark.read.parquet(f"{path}/metadata").first()
        return cls(m["side"], spark.read.parquet(f"{path}/weights"), m["features"], m["intercept"], m["reg"],
                   m["max_iter"], list(m["metrics"]), path)


@dataclass
class SentimentModels:
    vectorizer: NgramVectorizer
    pos: SideModel
    neg: SideModel

    def save(self, path: str) -> None:
        self.vectorizer.save(f"{path}/vectorizer")
        self.pos.save(f"{path}/pos.model")
        self.neg.save(f"{path}/neg.model")

    @classmethod
    def load(cls, path: str) -> "SentimentModels":
        return cls(NgramVectorizer.load(f"{path}/vectorizer"),
                   SideModel.load(f"{path}/pos.model"),
                   SideModel.load(f"{path}/neg.model"))


def labeled_words(labeled_comments: DataFrame) -> DataFrame:
    """(Input_id, labeldjt, positive, negative, words) for usable labels."""
    flagged = labeled_comments.select(
        "Input_id", "labeldjt", "body",
        positive_flag(F.col("labeldjt")).alias("positive"),
        negative_flag(F.col("labeldjt")).alias("negative"))
    usable = flagged.where(F.col("positive").isNotNull())
    return usable.withColumn("words", clean_words(F.col("body"))).drop("body")


def featured(words: DataFrame) -> DataFrame:
    """``words`` with the n-gram features in their place."""
    return words.withColumn("features", ngram_features(F.col("words"))).drop("words")


def labeled_features(labeled_comments: DataFrame) -> DataFrame:
    """(Input_id, labeldjt, positive, negative, features) for usable labels."""
    return featured(labeled_words(labeled_comments))


def fit_vectorizer(features: DataFrame, min_df: float = MIN_DF,
                   vocab_size: int = VOCAB_SIZE) -> CountVectorizerModel | NgramVectorizer:
    """M1: binary bag of n-grams, terms in at least ``min_df`` documents (below
    1: of the documents' number), commonest first; an error if more than
    ``vocab_size`` terms qualify. Of a stored frame with ``words``, their n-grams
    are the terms; of one with ``features``, these.

    ``CountVectorizer`` counts every n-gram as an object on the executors' heaps.
    Here a grouped count finds the terms that qualify, and the vectorizer is
    fitted to a text that holds these alone, each as many times as the number
    of frequencies up to its own (at most the root of twice the occurrences),
    which gives the order."""
    least = min_df if min_df >= 1 else min_df * features.count()
    if "words" in features.columns:
        vectorizer = NgramVectorizer(stored(ngram_terms.count(features, least, vocab_size), "vocabulary"), min_df)
        if not vectorizer.size:
            raise ValueError(f"no term is in at least {min_df} comments")
        return vectorizer
    counted = (explode_terms(features.select(F.array_distinct("features").alias("terms")), F.col("terms"), "term")
               .groupBy("term").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= least)
               .persist(StorageLevel.DISK_ONLY))
    try:
        if counted.count() > vocab_size:
            raise ValueError(f"more than {vocab_size} terms are in at least {min_df} comments; "
                             "raise vocab_size or min_df")
        levels = counted.select("df").distinct().withColumn("times", F.dense_rank().over(Window.orderBy("df")))
        terms = counted.join(F.broadcast(levels), "df").select(F.array_repeat("term", F.col("times")).alias("features"))
        cv = CountVectorizer(inputCol="features", outputCol="counts", minDF=1.0, binary=True, vocabSize=vocab_size)
        return cv.fit(terms)._set(minDF=min_df)
    finally:
        counted.unpersist()


def _estimator(side: str, max_iter: int) -> LogisticRegression:
    return LogisticRegression(labelCol=SIDES[side], featuresCol="counts", maxIter=max_iter,
                              probabilityCol=f"{side}_probability",
                              rawPredictionCol=f"{side}_raw",
                              predictionCol=f"{side}_prediction")


def evaluator(side: str) -> BinaryClassificationEvaluator:
    """M6: area under ROC on the side's label and raw prediction."""
    return BinaryClassificationEvaluator(labelCol=SIDES[side], rawPredictionCol=f"{side}_raw")


def _bucket(key: str, seed: int, buckets: int):
    """A stable bucket of the row key, from 32 bits of an md5: the same on any
    partition layout and on every rerun (``randomSplit`` and CV's own folds
    depend on layout)."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.pmod(number, F.lit(buckets)).cast("int")


def train_side(vectors: DataFrame, side: str, terms: int, reg_params=REG_PARAMS, max_iter: int = MAX_ITER,
               folds: int = NUM_FOLDS, seed: int = 7, key: str = "Input_id") -> SideModel:
    """M3-M5, M7: cross-validated logistic regression for one side on texts of
    ``term_ids`` below ``terms``; folds come from a hash of the row key. Every fit
    of fold x grid runs in the same passes, and with a grid of one entry the
    final fit joins them."""
    blocks = term_blocks.deal(vectors.select(F.col(SIDES[side]).alias("label"), _bucket(key, seed, folds).alias("fold"),
                                             "term_ids"), terms)
    blocks.folds = blocks.table["fold"].to_numpy().astype(np.int16)
    label, grid, judge = blocks.table["label"].to_numpy().astype(np.float64), list(reg_params), evaluator(side)
    try:
        wanted = [(k, reg) for reg in grid for k in range(folds)] + [(None, grid[0])] * (len(grid) == 1)
        fits = term_blocks.regressions(blocks, label, wanted, max_iter)
        metrics = [judge.evaluate(vectors.sparkSession.createDataFrame(pa.table(
            {SIDES[side]: label[blocks.folds == k], f"{side}_raw": fit.margins[blocks.folds == k]})))
            for (k, _), fit in zip(wanted, fits) if k is not None]
        averages = [sum(metrics[i:i + folds]) / folds for i in range(0, len(metrics), folds)]
        best = max(range(len(grid)), key=averages.__getitem__)
        fit = fits[-1] if len(grid) == 1 else term_blocks.regressions(blocks, label, [(None, grid[best])], max_iter)[0]
        rows = stored(blocks.sums([fit.dual], [None]), "weights")
    finally:
        blocks.release()
    shift = rows.agg(F.sum(F.col("mean") * F.col("w0"))).first()[0]
    return SideModel(side, rows.select("term_id", F.col("w0").alias("weight")), terms, fit.intercept - shift,
                     float(grid[best]), max_iter, averages)


def concurrent_fits(terms: int) -> int:
    """How many fits of spark.ml's own estimator on so many terms may run at once."""
    return max(1, min(PARALLEL_FITS, FIT_VALUES // max(1, terms)))


def split(vectors: DataFrame, seed: int, key: str = "Input_id") -> tuple[DataFrame, DataFrame]:
    """50/50 split by a seeded hash of the row key."""
    half = _bucket(key, seed, 2)
    return vectors.where(half == 0), vectors.where(half == 1)


def train(labeled_comments: DataFrame, seed: int = 42, **kw) -> tuple[SentimentModels, dict]:
    """Fit vectorizer and both classifiers; each side on its own random half,
    as the reference does. Returns the models and the held-out halves."""
    # By key: staged comments come in few large splits.
    words = labeled_words(labeled_comments).repartition("Input_id").persist(StorageLevel.DISK_ONLY)
    vectorizer = fit_vectorizer(words)
    vectors = stored(vectorizer.transform(words), "vectors")
    words.unpersist()
    halves = {side: split(vectors, seed + i) for i, side in enumerate(SIDES)}
    models = {side: train_side(halves[side][0], side, vectorizer.size, **kw) for side in SIDES}
    held_out = {side: halves[side][1] for side in SIDES}
    return SentimentModels(vectorizer, models["pos"], models["neg"]), held_out


def with_margins(rows: DataFrame, models: SentimentModels) -> DataFrame:
    """M8: ``rows`` of ``words`` or ``term_ids`` with ``pos_raw`` and ``neg_raw`` in
    their place."""
    spark, sides = rows.sparkSession, [getattr(models, s) for s in SIDES]
    texts = "words" if "words" in rows.columns else "term_ids"
    doc = rows.select(F.struct(*[c for c in rows.columns if c != texts]).alias("doc"), texts)
    sent = spark.sparkContext.broadcast([m.weights for m in sides])
    intercepts = [m.intercept for m in sides]
    trie = models.vectorizer.trie.sent(spark) if texts == "words" else None

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            if trie is None:
                at, terms = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()
            else:  # in one pass, so that a task needs one worker less
                at, terms = Trie(*trie.value).term_ids(lists)
            raw = [np.bincount(at, w[terms], len(lists)) + b for w, b in zip(sent.value, intercepts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, raw)], names=["doc", "pos_raw", "neg_raw"])

    schema = f"doc {doc.schema['doc'].dataType.simpleString()}, pos_raw double, neg_raw double"
    return bounded(doc).mapInArrow(run, schema).select("doc.*", "pos_raw", "neg_raw")


def class_one(raw: Column) -> Column:
    """P(class 1) as spark.ml computes it."""
    return 1 - 1 / (1 + F.exp(raw))


def evaluate(models: SentimentModels, halves: dict) -> dict[str, float]:
    """M6 on the held-out halves the reference creates but never uses."""
    out = {}
    for side in SIDES:
        rows = with_margins(halves[side].select(SIDES[side], "term_ids"), models)
        out[side] = evaluator(side).evaluate(rows.withColumn(SIDES[side], F.col(SIDES[side]).cast("double")))
    return out


def score(comments_with_title: DataFrame, models: SentimentModels,
          pos_threshold: float = POSITIVE_THRESHOLD,
          neg_threshold: float = NEGATIVE_THRESHOLD) -> DataFrame:
    """(id, flair, created_utc, title, sid, cscore, sscore,
    pos, neg) per comment.

    The term ids of a text are found once for both models, and no n-gram is
    spelled out; a text without a known term has the intercepts alone.
    """
    rows = comments_with_title.select("id", "flair", "created_utc", "title", "sid", "cscore", "sscore",
                                      clean_words(F.col("body")).alias("words"))
    both = with_margins(rows, models)
    return both.select(
        "id", "flair", "created_utc", "title", "sid", "cscore", "sscore",
        above(class_one(F.col("pos_raw")), pos_threshold).alias("pos"),
        above(class_one(F.col("neg_raw")), neg_threshold).alias("neg"))
