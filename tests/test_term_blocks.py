"""Terms by word numbers, and regressions on blocks of terms, against plain versions."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sift.operators import ml, ngram_terms, term_blocks, term_fit
from sift.plans import queries as Q

from .conftest import SF_SMALL


def _grams(words):
    return {"_".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def _texts(seed=4, n=150):
    rnd = random.Random(seed)
    texts = [[rnd.choice(["a", "b", "b'c", "b-", "ab", "é", f"w{rnd.randint(0, 40)}"]) for _ in range(rnd.choice([0, 1, 2, 9, 30]))]
             for _ in range(n)]
    return texts + [None, [], ["a"], texts[3], texts[3]]


@pytest.mark.parametrize("least", [1, 3, 10, 1000])
def test_terms_are_those_of_the_plain_count(spark, least):
    texts = _texts()
    words = ngram_terms.stored(spark.createDataFrame(list(enumerate(texts)), "id long, words array<string>").repartition(4), "w")
    df = Counter(t for words_ in texts for t in _grams(words_ or []))
    want = sorted(((t, n) for t, n in df.items() if n >= least), key=lambda x: (-x[1], x[0].encode()))
    terms = ngram_terms.stored(ngram_terms.count(words, least), "t")
    assert [(r.term, r.df) for r in terms.orderBy("term_id").collect()] == want
    assert sorted(r.term_id for r in terms.collect()) == list(range(len(want)))
    number = {t: k for k, (t, _) in enumerate(want)}
    got = {r.id: r.term_ids for r in ngram_terms.encode(words, ngram_terms.Trie.of(terms)).collect()}
    assert got == {k: sorted(number[t] for t in _grams(w or []) if t in number) for k, w in enumerate(texts)}
    if want:
        with pytest.raises(ValueError, match="more than"):
            ngram_terms.count(words, least, len(want) - 1)


def _vectors(spark, n=120, terms=90, seed=3):
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        ids = sorted(rnd.sample(range(terms), rnd.randint(0, 12)) + [terms])  # the last one is in every text
        rows.append((str(k % (n - 5)), int(3 in ids or rnd.random() < 0.3), 0, ids))
    return spark.createDataFrame(rows, "Input_id string, positive int, negative int, term_ids array<int>").repartition(5), terms + 2


def test_a_side_is_trained_as_spark_ml_trains_it(spark, monkeypatch):
    vectors, terms = _vectors(spark)
    rows = spark.createDataFrame(
        [(float(r.positive), r.fold, Vectors.sparse(terms, r.term_ids, [1.0] * len(r.term_ids))) for r in
         vectors.withColumn("fold", ml._bucket("Input_id", 7, 5)).collect()], ["positive", "fold", "features"])
    plain = LogisticRegression(labelCol="positive", maxIter=10, regParam=0.1, rawPredictionCol="pos_raw")
    judge = ml.evaluator("pos")
    areas = [judge.evaluate(plain.fit(rows.where(F.col("fold") != k)).transform(rows.where(F.col("fold") == k))) for k in range(5)]
    whole = plain.fit(rows)
    for fit_mb in (32, 0):  # all fits in a pass, or one
        monkeypatch.setattr(term_blocks, "FIT_MB", fit_mb)
        model = ml.train_side(vectors, "pos", terms, reg_params=[0.1])
        assert np.allclose(model.weights, whole.coefficients.toArray(), atol=1e-9)
        assert abs(model.intercept - whole.intercept) < 1e-9
        assert abs(model.avgMetrics[0] - sum(areas) / 5) < 1e-9
    two = ml.train_side(vectors, "pos", terms, reg_params=[0.1, 5.0])
    assert len(two.avgMetrics) == 2 and two.regParam in (0.1, 5.0)
    assert abs(two.avgMetrics[0] - sum(areas) / 5) < 1e-9


def test_one_label_alone_gives_an_infinite_intercept(spark):
    vectors, terms = _vectors(spark)
    model = ml.train_side(vectors, "neg", terms)
    assert model.intercept == -np.inf and not model.weights.any()


def test_training_and_scoring_hold_no_vector_of_the_vocabulary(spark, monkeypatch):
    """Spark.ml's fits took 25 such vectors on the driver, and
    its vectorizer every n-gram of a text as a string."""
    def forbidden(*args, **kw):
        raise AssertionError("spark.ml's own fit")

    for kind in (LogisticRegression, CountVectorizer):
        monkeypatch.setattr(kind, "fit", forbidden)
    monkeypatch.setattr(ml.NgramVectorizer, "model", property(forbidden))
    monkeypatch.setattr(ml.SideModel, "bestModel", property(forbidden))
    models, halves = ml.train(Q._labeled(spark, SF_SMALL))
    scored = ml.score(Q._scoring_input(spark, SF_SMALL), models)
    assert scored.where("pos not in (0, 1) or neg not in (0, 1)").count() == 0 < scored.count()
    assert "concat_ws(_" not in scored._jdf.queryExecution().toString()
    assert set(ml.evaluate(models, halves)) == {"pos", "neg"}


def test_active_features_are_counted_without_dense_vectors(spark):
    """a row was spelled out to the length of the vocabulary."""
    rows = Q.q_ml_features(spark, SF_SMALL)
    plan = rows._jdf.queryExecution().toString()
    assert "vector_to_array" not in plan and "filter(" not in plan
    vocabulary = {r.term for r in Q.q_ngram_vocabulary(spark, SF_SMALL).collect()}
    features = ml.labeled_features(Q._labeled(spark, SF_SMALL)).collect()
    assert {r.Input_id: r.n_active for r in rows.collect()} == {r.Input_id: len(vocabulary & set(r.features)) for r in features}


def test_a_text_without_a_body_has_the_intercepts(spark):
    models, _ = Q.trained(spark, SF_SMALL)
    rows = spark.createDataFrame([("x", None), ("y", "")], "id string, body string").select(
        "id", "body", *[F.lit(None).cast(t).alias(c) for c, t in (("flair", "string"), ("created_utc", "long"), (
            "title", "string"), ("sid", "string"), ("cscore", "long"), ("sscore", "long"))])
    want = [int(1 / (1 + np.exp(-m.intercept)) > t) for m, t in ((models.pos, 0.2), (models.neg, 0.25))]
    assert [[r.pos, r.neg] for r in ml.score(rows, models).collect()] == [want, want]


def test_term_fit_on_words_equals_that_on_pairs(spark):
    """N-grams are not spelled out, shuffled or joined as strings; ids
    that repeat have the terms of all their rows."""
    texts = _texts(seed=7)
    rnd = random.Random(1)
    rows = [(str(k % 140), w, int(rnd.random() < 0.4), int(rnd.random() < 0.2)) for k, w in enumerate(texts)]
    words = ngram_terms.stored(spark.createDataFrame(rows, "Input_id string, words array<string>, positive int, negative int"), "w")
    labels = words.select(F.col("Input_id").alias("id"), "positive", "negative")
    grams = F.udf(lambda w: sorted(_grams(w or [])), "array<string>")
    out = []
    for pairs in (term_fit.postings(words), term_fit.postings(words.select("Input_id", grams("words").alias("features"))).cache()):
        terms = ngram_terms.stored(term_fit.dictionary(pairs, 10), "t")
        encoded = term_fit.encode(pairs, terms)
        model = term_fit.fit(encoded, labels, terms, steps=3, rate=0.2)
        scored = term_fit.score(labels.select("id"), encoded, model)
        out.append(([tuple(r) for r in terms.select("term_id", "term", "df").orderBy("term_id").collect()],
                    [(r.pos, r.neg) for r in model.weights.orderBy("term_id").collect()], (model.pos, model.neg),
                    sorted((r.id, round(r.p_pos, 12), round(r.p_neg, 12)) for r in scored.collect())))
    (a, w, i, p), (b, x, j, q) = out
    assert a == b and np.allclose(w, x, atol=1e-12) and np.allclose(i, j, atol=1e-12) and p == q and len(w) == len(a) > 20


def test_fit_without_texts_or_terms(spark):
    none = spark.createDataFrame([], "id string, term_ids array<int>")
    terms = spark.createDataFrame([(0, "a", 10)], "term_id long, term string, df long")
    labels = spark.createDataFrame([], "id string, positive int, negative int")
    assert [tuple(r) for r in term_fit.fit(none, labels, terms).weights.collect()] == [(0, 0.0, 0.0)]
    labels = spark.createDataFrame([("x", 1, 0)], labels.schema)
    model = term_fit.fit(none, labels, terms.limit(0))
    assert model.weights.count() == 0 and model.pos > 0 > model.neg
    assert term_fit.score(labels.select("id"), none, model).count() == 1
