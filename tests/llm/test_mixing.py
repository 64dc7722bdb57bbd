import numpy as np
import pytest
from pyspark.sql import functions as F

from sift.llm.components import written
from sift.llm.mixing import cells_of, fit_rates, label_domains, learn, mix, mixed_documents

DOCS = "doc_id long, text string, rate string"  # rate: a clashing extra column
LABELS = "doc_id long, quality int, toxic int"


def _solve(p, tokens, targets, ridge, iterations):
    """The same problem, per document, in plain numpy."""
    total = tokens.sum()
    scale = np.maximum(p.T @ tokens / total, 0.01)
    r = np.ones(len(tokens))
    for _ in range(iterations):
        residual = (p.T @ (r * tokens) / total - targets) / scale
        r = np.maximum(0, r - 1 / (1 + ridge) * (p @ residual + ridge * (r - 1)))
    return r


def _cells(spark, p, tokens):
    rows = [([k], a.tolist(), int(t)) for k, (a, t) in enumerate(zip(p, tokens))]
    df = spark.createDataFrame(rows, "cell array<int>, posterior array<double>, tokens long")
    return written(cells_of(df.repartition(4), p.shape[1]), "cells")


@pytest.mark.parametrize("targets, ridge, tolerance", [([0.6, 0.35, 0.05], 0.05, 1e-7), ([0.9, 0.05, 0.05], 0.01, 1e-9)])
def test_rates_match_a_plain_solver(spark, targets, ridge, tolerance):
    rnd = np.random.default_rng(3)
    p, tokens = rnd.dirichlet([0.3, 0.3, 0.3], 400), rnd.integers(0, 500, 400)
    fit = fit_rates(_cells(spark, p, tokens), targets, ridge=ridge, tolerance=tolerance)
    got = {r.cell[0]: r.rate for r in fit.rates.collect()}
    want = _solve(p, tokens.astype(float), np.array(targets), ridge, 20_000)
    assert fit.settled and max(abs(got[k] - want[k]) for k in range(400)) < 1e-4
    assert np.abs(p.T @ (want * tokens) / tokens.sum() - fit.reached).max() < 1e-5


def test_a_tiny_domain_reaches_its_target_or_is_reported(spark):
    rnd = np.random.default_rng(6)
    p = rnd.dirichlet([0.02, 0.02, 1e-9], 3000)
    p[:, 2] = rnd.uniform(0, 1e-5, 3000)
    p[0] = [0, 0, 1]
    p /= p.sum(axis=1, keepdims=True)
    tokens = np.full(3000, 300)
    tokens[0] = 90  # about a hundredth of a percent
    targets = [0.6, 0.39, 0.01]
    cells = _cells(spark, p, tokens)
    fit = fit_rates(cells, targets, ridge=1e-6)
    assert fit.settled and fit.unmet() == [] and abs(fit.reached[2] / 0.01 - 1) < 0.01
    fit = fit_rates(cells, targets)  # the pull towards rate 1 stops it a little earlier
    assert fit.settled and fit.unmet() == [2] and fit.reached[2] > 0.0088


def test_targets_are_met(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(8)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = learn(docs, label_domains(labels))
    targets = {"clean": 0.9, "toxic": 0.07, "low_quality": 0.03}
    rows = mix(docs, model, targets).persist()
    total = rows.agg(F.sum("tokens")).first()[0]
    for k, d in enumerate(model.domains):
        share = rows.agg(F.sum(F.col("rate") * F.col("tokens") * F.col("posterior")[k])).first()[0] / total
        assert abs(share - targets[d]) < 0.01
    drawn = rows.agg(F.sum(F.col("copies") * F.col("tokens"))).first()[0]
    assert abs(drawn / total - 1) < 0.1
    assert rows.where("abs(copies - rate) >= 1 or copies < 0").count() == 0


def test_cases(spark):
    rows = [(1, "good words here", "x"), (2, "idiot idiot here", "x"), (3, None, "x"), (4, "", "x"),
            (None, "good words", None), (1, "good words here", "x"), (5, "good " * 100_000, "x")]
    df = spark.createDataFrame(rows, DOCS)
    domains = label_domains(spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, None, 1), (9, 0, 0)], LABELS))
    got = mix(df, learn(df, domains), {"clean": 0.5, "toxic": 0.5}, max_steps=9).collect()
    assert len(got) == len(rows) and all(r.rate >= 0 and r.copies >= 0 for r in got)
    assert [r.tokens for r in got if r.doc.doc_id in (3, 4)] == [0, 0]
    ones = [(r.rate, r.copies) for r in got if r.doc.doc_id == 1]
    assert ones[0] == ones[1]
    out = mixed_documents(df, learn(df, domains), {"clean": 1.0}, max_steps=9)
    assert out.columns == ["doc_id", "text", "rate", "copies"] and out.where("copies < 1").count() == 0


@pytest.mark.parametrize("n", [0, 1])
def test_nothing_to_learn_and_empty_table(spark, n):
    df = spark.createDataFrame([(1, "text here", "x")], DOCS).limit(n)
    model = learn(df, label_domains(spark.createDataFrame([], LABELS)))
    assert [(r.rate, r.copies) for r in mix(df, model, {"clean": 1.0}).collect()] == [(1.0, 1)] * n
