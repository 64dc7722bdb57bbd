"""Classifiers whose dictionary and weights are tables, not driver arrays (M1-M3, M6-M8).

``ml`` keeps the vocabulary and the coefficients on the driver, up to
``vocab_size`` terms. Here both are tables keyed by term:

* ``dictionary``: terms in at least ``min_df`` comments with an id by rank
  (commonest first, ties by term), numbered without a global window. From
  words, their n-grams are counted by word numbers (``ngram_terms``); from (id, term)
  rows, rarer terms stay behind a count-min prefilter (``frequent``);
* ``encode``: a comment's term ids, once each; from (id, term) rows as (id, term
  id) rows, by a join in which hot terms do not meet in one task;
* ``fit``: logistic regressions of both sides at once by full-batch gradient
  steps of fixed size, on blocks of terms (``term_blocks``). Weights start at 0, so
  they are sums by term of a number per comment, and a step needs the
  comments' margins only: one pass, in which a block sums the residuals by
  term and these sums by comment. The driver holds some ten numbers a comment
  while it fits;
* ``score``: probabilities and the two flags (F21, F22); the weights are
  broadcast, 16 bytes a term;
* ``area_under_roc``: the exact area, by mid-ranks, where spark.ml's evaluator
  bins its curve.

spark.ml stays the default of the comment job; this is the way beyond
``vocab_size`` terms.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.flags import NEGATIVE_THRESHOLD, POSITIVE_THRESHOLD
from ..functions.text import explode_terms
from . import ngram_terms, term_blocks
from .frequent import frequent_terms
from .ngram_terms import Trie, bounded, stored
from .ranking import rank_within
from .skew import split_hot_join

STEPS, RATE, REG = 5, 0.01, 0.1


def postings(features: DataFrame, id_col: str = "Input_id") -> DataFrame:
    """(id, term) from (id, features), each pair once; words stay as they are:
    (id, words), whose n-grams are the terms."""
    if "words" in features.columns:
        return features.select(F.col(id_col).alias("id"), "words")
    return explode_terms(features.select(F.col(id_col).alias("id"), F.array_distinct("features").alias("terms")),
                         F.col("terms"), "term", "id")


def dictionary(pairs: DataFrame, min_df: float) -> DataFrame:
    """M1: (term_id from 0, term, df) of the terms in at least ``min_df``
    comments; of words also level and key (``ngram_terms``)."""
    if "words" in pairs.columns:
        return ngram_terms.count(pairs, min_df)
    counted = frequent_terms(pairs, min_df, pairs.count()).withColumn("all", F.lit(0))
    ranked = rank_within(counted, "all", [F.desc("df"), F.asc("term")], rank_col="term_id", num_groups=1)
    return ranked.select((F.col("term_id") - 1).alias("term_id"), "term", "df")


def encode(pairs: DataFrame, terms: DataFrame) -> DataFrame:
    """M2: of words (id, term_ids); else (id, term_id) of the pairs whose term
    is in the dictionary, clustered by id."""
    if "words" in pairs.columns:
        return ngram_terms.encode(pairs, Trie.of(terms))
    known = split_hot_join(pairs, terms, "term", "df").select("id", "term_id")
    return known.repartition("id").sortWithinPartitions("id")


@dataclass
class TermModel:
    weights: DataFrame  # (term_id, pos, neg)
    pos: float          # intercepts
    neg: float


def _by_id(encoded: DataFrame) -> DataFrame:
    """All terms of an id in one row: (id, term_ids)."""
    if "term_ids" in encoded.columns:
        return encoded.groupBy("id").agg(F.flatten(F.collect_list("term_ids")).alias("term_ids"))
    return encoded.groupBy("id").agg(F.collect_list(F.col("term_id").cast("int")).alias("term_ids"))


def _margins(ids: DataFrame, encoded: DataFrame, model: TermModel) -> DataFrame:
    """``ids`` with p_pos and p_neg; comments without a known term have the
    intercepts alone."""
    table = model.weights.select("term_id", "pos", "neg").toArrow()
    terms = table["term_id"].to_numpy()
    weights = np.zeros((2, int(terms.max()) + 1 if len(terms) else 0))
    weights[0, terms], weights[1, terms] = table["pos"].to_numpy(), table["neg"].to_numpy()
    sent = ids.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            at = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            found = lists.flatten().to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(np.bincount(at, w[found], len(lists))) for w in sent.value]],
                names=["id", "m_pos", "m_neg"])

    rows = encoded.select("id", "term_ids") if "term_ids" in encoded.columns else _by_id(encoded)
    kind = rows.schema["id"].dataType.simpleString()
    sums = (bounded(rows).mapInArrow(run, f"id {kind}, m_pos double, m_neg double")
            .groupBy("id").agg(F.sum("m_pos").alias("m_pos"), F.sum("m_neg").alias("m_neg")))
    joined = ids.join(sums, "id", "left")
    for side in ("pos", "neg"):
        margin = F.coalesce(f"m_{side}", F.lit(0.0)) + F.lit(getattr(model, side))
        joined = joined.withColumn(f"p_{side}", 1 / (1 + F.exp(-margin)))
    return joined.drop("m_pos", "m_neg")


def fit(encoded: DataFrame, labels: DataFrame, terms: DataFrame, steps: int = STEPS, rate: float = RATE,
        reg: float = REG) -> TermModel:
    """M3, M7: both sides from ``encoded`` (``encode``) and ``labels`` (id,
    positive, negative). Weights start at 0; the penalty spares intercepts. An
    id that comes more than once has the terms of all its rows."""
    texts = (labels.groupBy("id").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in ("positive", "negative")])
             .join(_by_id(encoded), "id", "left").drop("id"))
    size = terms.agg(F.max("term_id")).first()[0]
    blocks = term_blocks.deal(texts, 0 if size is None else size + 1)
    times, *true = (blocks.table[c].to_numpy().astype(np.float64) for c in ("n", "positive", "negative"))
    true, n, both = np.stack(true), times.sum(), [None, None]
    margins, dual, intercepts, kept = np.zeros(true.shape), np.zeros(true.shape), np.zeros(2), 1 - rate * reg
    try:
        for _ in range(steps if n else 0):
            residual = times / (1 + np.exp(-(margins + intercepts[:, None]))) - true
            margins = kept * margins - rate / n * blocks.margins(list(residual), both)
            dual = kept * dual - rate / n * residual
            intercepts = intercepts - rate * residual.sum(axis=1) / n
        weights = stored(blocks.sums(list(dual), both).select("term_id", F.col("w0").alias("pos"), F.col("w1").alias("neg")),
                         "weights")
        missing = terms.select("term_id").join(weights, "term_id", "left_anti")
        if blocks.blocks and not missing.isEmpty():  # terms of no text, and those of blocks without a pair
            weights = stored(weights.unionByName(missing.select("term_id", F.lit(0.0).alias("pos"), F.lit(0.0).alias("neg"))),
                             "weights")
    finally:
        blocks.release()
    return TermModel(weights, *intercepts.tolist())


def score(ids: DataFrame, encoded: DataFrame, model: TermModel, pos_threshold: float = POSITIVE_THRESHOLD,
          neg_threshold: float = NEGATIVE_THRESHOLD) -> DataFrame:
    """``ids`` with p_pos, p_neg and the flags pos, neg."""
    scored = _margins(ids, encoded, model)
    return (scored.withColumn("pos", (F.col("p_pos") > pos_threshold).cast("int"))
            .withColumn("neg", (F.col("p_neg") > neg_threshold).cast("int")))


def area_under_roc(scored: DataFrame, group: str, score_col: str, label_col: str) -> DataFrame:
    """M6: (group, auc) by mid-ranks: the share of pairs of a 1 and a 0 that
    are in order, ties counting half. Null where a group has one class only.
    Scores and labels must not be null; of equal scores, only counts matter."""
    rows = scored.select(F.col(group).alias(group), F.col(score_col).cast("double").alias("_score"),
                         F.col(label_col).cast("long").alias("_label"))
    ranked = rank_within(rows, group, [F.asc("_score")], rank_col="_rank")
    tied = ranked.groupBy(group, "_score").agg(
        ((F.min("_rank") + F.max("_rank")) / 2).alias("_mid"), F.sum("_label").alias("_ones"),
        F.count(F.lit(1)).alias("_n"))
    total = tied.groupBy(group).agg(F.sum(F.col("_mid") * F.col("_ones")).alias("_ranks"),
                                    F.sum("_ones").cast("double").alias("_one"), F.sum("_n").alias("_all"))
    pairs = F.col("_one") * (F.col("_all") - F.col("_one"))
    return total.select(group, F.try_divide(
        F.col("_ranks") - F.col("_one") * (F.col("_one") + 1) / 2, pairs).alias("auc"))
