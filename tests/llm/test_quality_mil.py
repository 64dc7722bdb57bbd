import numpy as np
from pyspark.sql import functions as F

from sift.llm.language_id import held_out
from sift.llm.passages import FEATURES, passage_features
from sift.llm.quality_mil import _backward, _forward, fit, keep_good, learn, score

DOCS = "doc_id long, text string, score string"  # score: a clashing extra column
LABELS = "doc_id long, quality int, toxic int"


def test_gradients_match_differences():
    rnd = np.random.default_rng(1)
    x, starts, y = rnd.normal(size=(9, 5)), np.array([0, 2, 6]), np.array([1.0, 0, 1])
    w = {"encode": rnd.normal(size=(5, 4)), "bias": rnd.normal(size=4), "tanh": rnd.normal(size=(4, 3)),
         "gate": rnd.normal(size=(4, 3)), "attend": rnd.normal(size=3), "score": rnd.normal(size=4),
         "prior": np.array(0.3)}
    weight = np.array([0.5, 1.0, 0.2])

    def loss(w):
        p = _forward(w, x, starts)["p"]
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()

    grads = _backward(w, x, starts, y, weight, 0.0)
    for name, g in grads.items():
        flat = np.atleast_1d(np.asarray(g)).reshape(-1)
        for k in range(len(flat)):
            up, down = ({n: v.copy() for n, v in w.items()} for _ in range(2))
            up[name].reshape(-1)[k] += 1e-6
            down[name].reshape(-1)[k] -= 1e-6
            assert abs((loss(up) - loss(down)) / 2e-6 - flat[k]) < 1e-6


def test_attention_finds_the_telling_passage():
    rnd = np.random.default_rng(2)
    bags, y = [], []
    for k in range(300):
        bag = rnd.normal(size=(rnd.integers(1, 6), FEATURES)).astype(np.float32)
        bag[:, 0] = 0
        y.append(float(k % 2))
        if k % 2:
            bag[rnd.integers(len(bag)), 0] = 3
        bags.append(bag)
    model = fit(bags, np.array(y))
    starts = np.cumsum([0] + [len(b) for b in bags[:-1]])
    attention, p = model.forward(np.concatenate(bags).astype(float), starts)
    assert ((p >= 0.5) == np.array(y)).mean() > 0.95
    strong = np.concatenate([b[:, 0] for b in bags]) > 0
    assert attention[strong].mean() > attention[~strong].mean()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(8)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    test = held_out("doc_id", 3, 1)
    got = score(docs, learn(docs, labels.where(~test))).join(labels, "doc_id").where(test)
    assert got.agg(F.avg(((F.col("score") >= 0.5) == (F.col("quality") == 1)).cast("int"))).first()[0] > 0.95


def test_cases(spark):
    rows = [(1, "Good prose here.", "x"), (2, "JUNK!! $$$ JUNK!!", "x"), (3, None, "x"), (4, "", "x"),
            (None, "Good prose here.", None), (1, "Good prose here.", "x"), (5, "word " * 100_000, "x")]
    df = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, 0), (None, 1, 0), (9, 1, 0), (2, 0, 1)], LABELS)
    model = learn(df, labels)
    got = score(df, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r.score for r in got}
    assert by_id[1] >= 0.5 > by_id[2] and by_id[3] == by_id[4] and by_id[None] == by_id[1]
    kept = keep_good(df, model)
    assert kept.columns == df.columns
    assert kept.where("doc_id = 2").count() == 0 and kept.where("doc_id = 1").count() == 2


def test_nothing_to_learn_and_empty_table(spark):
    df = spark.createDataFrame([(1, "text", "x")], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert score(df, learn(df, none)).first().score == 0.5
    assert score(df, learn(df, spark.createDataFrame([(1, 0, 0)], LABELS))).first().score == 0.0
    assert score(df.limit(0), learn(df.limit(0), none)).collect() == []


def test_passages_of_a_text():
    assert passage_features(None).shape == passage_features(b"").shape == (1, FEATURES)
    assert passage_features(b"w " * 300).shape == (3, FEATURES)
