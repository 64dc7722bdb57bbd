"""Classifier pipeline: thresholds, determinism, save/load, output shape."""

from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sift.functions import flags
from sift.operators import ml
from sift.plans import queries as Q

from .conftest import SF_SMALL


def test_threshold_and_nan_guard(spark):
    df = spark.createDataFrame([(Vectors.dense([0.7, 0.3]),), (Vectors.dense([0.8, 0.2]),),
                                (Vectors.dense([float("nan"), float("nan")]),)], ["p"])
    got = [r[0] for r in df.select(flags.class_one_above(F.col("p"), 0.2)).collect()]
    assert got == [1, 0, 0]


def test_split_is_layout_independent(spark):
    feats = ml.labeled_features(Q._labeled(spark, SF_SMALL))
    a1, _ = ml.split(feats, seed=42)
    a2, _ = ml.split(feats.repartition(3), seed=42)
    ids1 = sorted(r[0] for r in a1.select("Input_id").collect())
    ids2 = sorted(r[0] for r in a2.select("Input_id").collect())
    assert ids1 == ids2 and 0 < len(ids1) < feats.count()


def test_train_score_save_load(spark):
    models, halves = Q.trained(spark, SF_SMALL)
    assert models.pos.bestModel.getMaxIter() == ml.MAX_ITER
    assert models.vectorizer.getMinDF() == ml.MIN_DF
    scored = Q.q_ml_score(spark, SF_SMALL)
    assert scored.columns == ["id", "flair", "created_utc", "title", "pos", "neg"]
    again = Q.q_ml_save_load(spark, SF_SMALL)
    assert scored.exceptAll(again).count() == 0 and again.exceptAll(scored).count() == 0
    auc = ml.evaluate(models, halves)
    assert set(auc) == {"pos", "neg"}


def test_a_reloaded_model_gives_equal_probabilities_on_all_rows(spark):
    from pyspark.ml.functions import vector_to_array

    from sift.functions.text import with_features
    from sift.session import new_scratch_path
    models, _ = Q.trained(spark, SF_SMALL)
    path = new_scratch_path(spark, "reloaded")
    models.save(path)
    rows = with_features(Q._scoring_input(spark, SF_SMALL), "body").select("id", "features")

    def probabilities(m):
        both = m.neg.transform(m.pos.transform(m.vectorizer.transform(rows)))
        return {r.id: (r.p, r.n) for r in both.select(
            "id", vector_to_array("pos_probability").alias("p"), vector_to_array("neg_probability").alias("n")).collect()}

    before = probabilities(models)
    assert len(before) == rows.count() > 0
    assert probabilities(ml.SentimentModels.load(path)) == before


def test_vocabulary_matches_count_vectorizer(spark):
    models, _ = Q.trained(spark, SF_SMALL)
    ours = {r["term"] for r in Q.q_ngram_vocabulary(spark, SF_SMALL).collect()}
    assert ours == set(models.vectorizer.vocabulary)


def test_too_large_a_vocabulary_is_an_error(spark):
    import pytest
    df = spark.createDataFrame([(["a", "b", "c"],)] * 3, "features array<string>")
    assert len(ml.fit_vectorizer(df, 2, vocab_size=3).vocabulary) == 3
    with pytest.raises(ValueError, match="more than 2 terms"):
        ml.fit_vectorizer(df, 2, vocab_size=2)


def test_probability_is_the_sigmoid_of_the_margin(spark):
    import math
    models, _ = Q.trained(spark, SF_SMALL)
    best = models.pos.bestModel
    vectors = models.vectorizer.transform(ml.labeled_features(Q._labeled(spark, SF_SMALL)))
    weights = best.coefficients.toArray()
    for r in best.transform(vectors).limit(20).collect():
        margin = best.intercept + sum(weights[i] * v for i, v in zip(r["counts"].indices, r["counts"].values))
        assert abs(r["pos_probability"][1] - 1 / (1 + math.exp(-margin))) < 1e-9


def test_a_vocabulary_beyond_two_to_the_18_is_fitted_whole(spark):
    wide = spark.range(3).select(F.transform(F.sequence(F.lit(0), F.lit(299_999) + F.col("id") % 2),
                                             lambda i: F.concat(F.lit("t"), i.cast("string"))).alias("features"))
    model = ml.fit_vectorizer(wide, 2)
    assert len(model.vocabulary) == 300_000 and model.getMinDF() == 2


def test_vectorizer_orders_by_frequency_and_counts_a_term_once_a_text(spark):
    texts = [["a", "a", "a", "a"], ["b", "c"], ["b", "c"], ["b", "d"], ["c", "e"], ["b"], []]
    df = spark.createDataFrame([(t,) for t in texts], "features array<string>")
    assert ml.fit_vectorizer(df, 2).vocabulary == ["b", "c"]
    assert ml.fit_vectorizer(df, 0.5).vocabulary == ["b"]
    assert ml.fit_vectorizer(df, 1).vocabulary[:2] == ["b", "c"]


def test_fits_at_once_fall_with_the_vocabulary():
    assert ml.concurrent_fits(0) == ml.concurrent_fits(1000) == ml.PARALLEL_FITS
    assert ml.concurrent_fits(800_000) == 2 and ml.concurrent_fits(ml.VOCAB_SIZE) == 1
