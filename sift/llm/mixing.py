"""Mixing documents to target weights of soft domains.

A classifier trained on a labelled table gives every document a posterior over
domains. The rates (expected number of copies) of the documents are fitted so
that the expected tokens of each domain, the sum over the documents of rate x
tokens x posterior, meet the targets:

    minimise over r >= 0   sum_j ((T_j(r) - target_j) / T)^2 / max(share_j, 0.01)
                           + ridge x sum_d tokens_d / T x (r_d - 1)^2

Documents whose posteriors agree to about a
third (an eighth of a power of ten, from 1e-6 on) share a cell and so a rate;
the totals of a cell are sums of unrounded posteriors. At the minimum the rate
of a cell follows from its mean posterior and from one residual per domain, so
these few residuals are what Newton steps look for: a step is one aggregate
over the cells, and the driver keeps the residuals and their curvature.
The fit tells the share that every domain reaches; ``mix`` warns of targets
missed by more than a hundredth of them (a domain may be too small for its
target within the pull towards rate 1). A document is emitted floor(rate + u)
times, u uniform from a hash of its id and text.

The classifier is a softmax regression on the presence of the ``max_words``
most telling words of the labelled texts and on what their passages look like.
It is trained on at most ``max_docs`` labelled rows.

Defined results: null and empty texts have no tokens and do not move the fit,
but get the rate of their posterior; rows without a label are not learned from;
without any labelled row all rates are 1; domains without documents cannot
meet their target and leave it to the others; repeated rows and ids are rated
row by row, and rows with equal id and text alike; other columns are kept.
"""

from __future__ import annotations

import logging
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sift.llm.batches import bounded, field_of, packed
from sift.llm.components import written
from sift.llm.decontaminate import normal_words
from sift.llm.learning import adam, labelled_texts
from sift.llm.passages import FEATURES, passage_features
from sift.operators.skew import split_hot_join

_LOG = logging.getLogger(__name__)
LEVELS = 8  # cells per power of ten of a posterior
LEAST = 1e-6  # posteriors below share a level


@dataclass
class DomainModel:
    """Softmax regression; without domains nothing was learned."""

    domains: list[str]
    words: dict[bytes, int]
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def posteriors(self, shapes: np.ndarray, present: list[list[int]]) -> np.ndarray:
        logits = np.clip((shapes - self.mean) / self.scale, -8, 8) @ self.weights[:FEATURES]
        logits += self.weights[-1]
        for k, columns in enumerate(present):
            if columns:
                logits[k] += self.weights[[FEATURES + c for c in columns]].sum(axis=0)
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def _shape(text: bytes | None) -> np.ndarray:
    return passage_features(text).mean(axis=0)


def _words_by_label(batches):
    """Per task: in how many texts of each label each word is."""
    counts: Counter = Counter()
    for batch in batches:
        texts = batch.column(0).cast(pa.binary()).to_pylist()
        for text, label in zip(texts, batch.column(1).to_pylist()):
            counts.update((label, w) for w in set(normal_words(text)))
            if len(counts) > 300_000:
                yield _counted(counts)
                counts = Counter()
    yield _counted(counts)


def _counted(counts: Counter) -> pa.RecordBatch:
    labels, words = zip(*counts) if counts else ((), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(words, pa.binary()), pa.array(labels, pa.string()), pa.array(list(counts.values()), pa.int64())],
        names=["word", "label", "n"])


def _telling(rows: DataFrame, totals: dict[str, int], max_words: int) -> list[bytes]:
    """The words whose presence tells most about the label (mutual
    information), counted over all texts of ``rows``."""
    n = float(sum(totals.values()))
    counts = (rows.select("text", "label").mapInArrow(_words_by_label, "word binary, label string, n long")
              .groupBy("word").agg(*[F.sum(F.when(F.col("label") == label, F.col("n")).otherwise(0))
                                     .cast("double").alias(f"n{k}") for k, label in enumerate(totals)]))
    here = sum((F.col(f"n{k}") for k in range(len(totals))), F.lit(0.0))

    def part(both: Column, a: Column, b: float) -> Column:
        return F.when(both > 0, both / n * F.ln(both * n / (a * b))).otherwise(0.0)

    told = F.lit(0.0)
    for k, total in enumerate(totals.values()):
        told = told + part(F.col(f"n{k}"), here, float(total))
        told = told + part(F.lit(float(total)) - F.col(f"n{k}"), F.lit(n) - here, float(total))
    best = (counts.where(here >= 3).withColumn("told", F.round(told, 12))
            .orderBy(F.desc("told"), "word").limit(max_words).select("word").toArrow())
    return best["word"].to_pylist()


def learn(docs: DataFrame, labelled: DataFrame, *, max_docs: int = 6000, max_words: int = 400,
          steps: int = 200, rate: float = 0.03, decay: float = 1e-4, id_col: str = "doc_id",
          text_col: str = "text", domain_col: str = "domain") -> DomainModel:
    """Train from the texts of ``docs`` whose id has a domain in ``labelled``."""
    rows = labelled_texts(bounded(docs), labelled.select(id_col, F.col(domain_col).cast("string").alias("label")),
                          max_docs, id_col=id_col, text_col=text_col)
    totals = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n"))
              .orderBy("label").collect()}
    if not totals:
        return DomainModel([], {}, np.zeros((0, 0)), np.zeros(FEATURES), np.ones(FEATURES))
    words = {w: k for k, w in enumerate(_telling(rows, totals, max_words))}

    def describe(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([_shape(t).tobytes() for t in texts], pa.binary()),
                 pa.array([sorted({words[w] for w in normal_words(t) if w in words}) for t in texts],
                          pa.list_(pa.int32()))], names=["label", "shape", "words"])

    got = rows.mapInArrow(describe, "label string, shape binary, words array<int>").toArrow()
    sample = sorted(zip(got["label"].to_pylist(), got["shape"].to_pylist(), got["words"].to_pylist()))
    domains = list(totals)
    y = np.array([domains.index(label) for label, _, _ in sample])
    shapes = np.stack([np.frombuffer(s, np.float32) for _, s, _ in sample]).astype(np.float64)
    mean, scale = shapes.mean(axis=0), shapes.std(axis=0) + 1e-3
    x = np.zeros((len(y), FEATURES + len(words) + 1), np.float32)
    x[:, :FEATURES] = np.clip((shapes - mean) / scale, -8, 8)
    x[:, -1] = 1
    for k, (_, _, columns) in enumerate(sample):
        x[k, [FEATURES + c for c in columns]] = 1
    target = np.eye(len(domains), dtype=np.float32)[y]

    def gradients(w: dict) -> dict:
        logits = x @ w["w"].astype(np.float32)
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        return {"w": x.T @ (p - target) / len(y) + decay * w["w"]}

    fitted = adam({"w": np.zeros((x.shape[1], len(domains)))}, gradients, steps, rate)
    return DomainModel(domains, words, fitted["w"], mean, scale)


def posteriors(docs: DataFrame, model: DomainModel, *, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` in a struct ``doc``, with ``tokens`` (words) and
    ``posterior``, an array in the order of the domains."""

    def run(batches):
        for batch in batches:
            texts = field_of(batch.column("doc"), text_col).cast(pa.binary()).to_pylist()
            tokens = [len(t.split()) if t else 0 for t in texts]
            if model.domains and texts:
                present = [list({model.words[w] for w in set(normal_words(t)) if w in model.words})
                           for t in texts]
                parts = model.posteriors(np.stack([_shape(t) for t in texts]).astype(np.float64), present).tolist()
            else:
                parts = [[] for _ in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(tokens, pa.int64()), pa.array(parts, pa.list_(pa.float64()))],
                names=["doc", "tokens", "posterior"])

    rows = bounded(docs).select(packed(docs))
    shaped = rows.select("doc", F.lit(0).cast("long").alias("tokens"),
                           F.array().cast("array<double>").alias("posterior"))
    return rows.mapInArrow(run, shaped.schema)


def cells_of(known: DataFrame, domains: int) -> DataFrame:
    """Per ``cell`` of ``known`` (``cell``, ``posterior``, ``tokens``): its
    rows ``n``, ``tokens``, tokens by domain ``mass`` and ``mean`` posterior,
    weighted by tokens where it has any."""
    at = [F.element_at("posterior", k + 1) for k in range(domains)]
    sums = known.groupBy("cell").agg(
        F.count("*").alias("n"), F.sum("tokens").cast("double").alias("tokens"),
        F.array(*[F.sum(F.col("tokens") * p) for p in at]).alias("mass"), F.array(*[F.avg(p) for p in at]).alias("flat"))
    return sums.select("cell", "n", "tokens", "mass", F.when(
        F.col("tokens") > 0, F.transform("mass", lambda m: m / F.col("tokens"))).otherwise(F.col("flat")).alias("mean"))


def cell_of() -> Column:
    """Levels of the posteriors."""
    return F.transform("posterior", lambda p: F.round(
        F.log10(F.greatest(p, F.lit(LEAST))) * LEVELS).cast("int"))


@dataclass
class Fit:
    """``rates`` has (cell, n, rate); ``reached`` is the share of the tokens of
    each domain at these rates, against ``targets``."""

    rates: DataFrame
    targets: list[float]
    reached: list[float]
    steps: int
    settled: bool

    def unmet(self, within: float = 0.01) -> list[int]:
        """Domains whose share is off by more than this part of the target."""
        return [k for k, (x, t) in enumerate(zip(self.reached, self.targets)) if abs(x - t) > within * t]


def _dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)


def _numbers(values: list[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in values])


def fit_rates(cells: DataFrame, targets: list[float], *, max_steps: int = 100, ridge: float = 1e-3,
              tolerance: float = 1e-5) -> Fit:
    """Rates of the cells (see ``cells_of``); ``targets`` are shares of the
    tokens, in the order of the domains, ``ridge`` is above 0. Stops when the
    residuals at the rates differ from those the rates are made of by less than
    ``tolerance`` times ``ridge``, or after ``max_steps`` aggregates over the
    cells (``settled`` is false then).

    At the minimum a rate is 1 less its mean posterior times residual over
    ``ridge``, or zero, so the residuals alone are sought. They minimise a
    convex, piecewise quadratic function; a step is Newton's, halved while it
    does not lower it."""
    k = len(targets)
    shares = cells.agg(F.sum("tokens"), *[F.sum(F.col("mass")[j]) for j in range(k)]).first()
    all_tokens, *now = [float(x or 0) for x in shares]
    if not all_tokens or not targets:
        return Fit(cells.select("cell", "n", F.lit(1.0).alias("rate")), list(targets), [0.0] * k, 0, True)
    if ridge <= 0:
        raise ValueError("ridge must be above 0")
    aim, scale = np.array(targets, float), np.maximum(np.array(now) / all_tokens, 0.01)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def rate(residual: np.ndarray) -> Column:
        return F.greatest(F.lit(0.0), 1.0 - _dot(F.col("mean"), _numbers(residual / ridge)))

    def measured(residual: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """The function, its gradient and curvature, and the shares at the rates."""
        here = cells.select("tokens", "mass", "mean", rate(residual).alias("rate"))
        got = here.agg(F.sum(F.col("tokens") * F.col("rate") * F.col("rate")),
                       *[F.sum(F.col("rate") * F.col("mass")[j]) for j in range(k)],
                       *[F.sum(F.when(F.col("rate") > 0, F.col("mass")[i] * F.col("mean")[j])) for i, j in pairs]).first()
        pull, *sums = [float(x or 0) / all_tokens for x in got]
        reached, bend = np.array(sums[:k]), np.diag(scale)
        for (i, j), x in zip(pairs, sums[k:]):
            bend[i, j] += x / ridge
            bend[j, i] = bend[i, j]
        value = (scale * residual**2).sum() / 2 + aim @ residual + ridge * pull / 2
        return value, scale * residual + aim - reached, bend, reached

    def off(gradient: np.ndarray) -> float:
        return float(np.abs(gradient / scale).max())

    residual, steps = np.zeros(k), 1
    value, gradient, bend, reached = measured(residual)
    part, move = 1.0, None
    while off(gradient) >= tolerance * min(1.0, ridge) and steps < max_steps:
        if move is None:
            part, move = 1.0, -np.linalg.solve(bend, gradient)
        steps += 1
        there = measured(residual + part * move)
        if there[0] <= value + 1e-4 * part * (gradient @ move) or off(there[1]) <= off(gradient) / 2:
            residual, move = residual + part * move, None
            value, gradient, bend, reached = there
        else:
            part /= 2
    return Fit(cells.select("cell", "n", rate(residual).alias("rate")), list(targets), reached.tolist(), steps,
               off(gradient) < tolerance * min(1.0, ridge))


def mix(docs: DataFrame, model: DomainModel, targets: dict[str, float], *, id_col: str = "doc_id",
        text_col: str = "text", max_broadcast: int = 100_000, **options) -> DataFrame:
    """All columns of ``docs`` in a struct ``doc``, with ``tokens``,
    ``posterior``, ``rate`` and ``copies``, for every row. Rates of more than
    ``max_broadcast`` cells are joined by a shuffle, hot cells apart."""
    # Written once: the fit and the result read the same posteriors.
    known = written(posteriors(docs, model, text_col=text_col).withColumn("cell", cell_of()), "posteriors")
    if model.domains:
        cells = written(cells_of(known, len(model.domains)), "cells")
        fit = fit_rates(cells, [targets.get(d, 0.0) for d in model.domains], **options)
        for k in fit.unmet():
            _LOG.warning("target of %s missed: %.6f of the tokens, wanted %.6f (%d steps, settled: %s)",
                         model.domains[k], fit.reached[k], fit.targets[k], fit.steps, fit.settled)
        rates = written(fit.rates, "rates")
        rated = (known.join(F.broadcast(rates), "cell") if rates.count() <= max_broadcast
                 else split_hot_join(known, rates, "cell", "n")).drop("cell", "n")
    else:
        rated = known.drop("cell").withColumn("rate", F.lit(1.0))
    uniform = F.pmod(F.xxhash64(F.col("doc")[id_col], F.col("doc")[text_col]), F.lit(1 << 30)) / float(1 << 30)
    return (rated.withColumn("rate", F.round("rate", 6))
            .withColumn("copies", F.floor(F.col("rate") + uniform).cast("long")))


def mixed_documents(docs: DataFrame, model: DomainModel, targets: dict[str, float], **options) -> DataFrame:
    """The rows of ``docs`` with at least one copy, and their ``rate`` and
    ``copies`` (input columns of these names are replaced)."""
    rows = mix(docs, model, targets, **options).where("copies >= 1")
    return rows.select(*[F.col("doc")[c].alias(c) for c in docs.columns if c not in ("rate", "copies")],
                       "rate", "copies")


def label_domains(labels: DataFrame) -> DataFrame:
    """Domains of the ``labels`` table: low quality, else toxic, else clean;
    none without a quality label."""
    return labels.select("doc_id", F.when(F.col("quality") != 1, "low_quality")
                         .when(F.col("quality").isNull(), None)
                         .when(F.col("toxic") == 1, "toxic").otherwise("clean").alias("domain"))


#: Production targets: shares of the tokens by domain.
TARGETS = {"clean": 0.97, "toxic": 0.02, "low_quality": 0.01}
