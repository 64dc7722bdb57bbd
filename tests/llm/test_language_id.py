import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sift.llm.language_id import ORDERS, UNDETERMINED, grams_of, held_out, learn, letter_words, predict

DOCS = "doc_id long, text string, lang string, score string"  # score: a clashing extra column


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(8)
    test = held_out("doc_id", 4, 2)
    model = learn(docs.where(~test))
    got = predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(test)
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95
    assert got.where("score < 0 or score > 1").count() == 0


def test_cases(spark):
    rows = [(1, "the cat and the dog and the bird", "en", "x"), (2, "der Hund und die Katze und der Vogel", "de", "x"),
            (3, None, "en", "x"), (4, "the the", None, "x"), (5, "", "en", "x"), (6, "12 ½ ² --", "de", "x"),
            (None, "und der", None, None), (1, "the cat and the dog and the bird", "en", "x"),
            (7, "Hundekatze", None, "x"), (8, "漢字", None, "x"), (9, "the " * 100_000, None, "x")]
    df = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in predict(df, learn(df)).collect()}
    assert len(rows) - 1 == len(got)
    assert {k: r.lang_pred for k, r in got.items()} == {
        1: "en", 2: "de", 3: "und", 4: "en", 5: "und", 6: "und", None: "de", 7: "de", 8: "de", 9: "en"}
    assert got[3].score == got[5].score == 0.0 and 0 < got[8].score <= 0.5


def test_nothing_learned_and_empty_table(spark):
    df = spark.createDataFrame([(1, "the cat", None, "x")], DOCS)
    assert predict(df, learn(df)).first().lang_pred == "und"
    empty = df.limit(0)
    assert predict(empty, learn(empty)).collect() == []


def test_letter_words():
    assert letter_words("It's 3 cafés, x2!") == ["it", "s", "cafés", "x"]
    assert letter_words(None) == letter_words("12 ²½ _") == []


def _drawn(rnd, letters, n):
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 6))) for _ in range(n))


def _brute(labelled, texts, max_words, max_grams, smoothing=0.5):
    """Language and score of each text by plain counting."""
    langs = sorted({lang for text, lang in labelled if lang is not None and letter_words(text)})
    counts = {(n, x): Counter() for n in (0, *ORDERS) for x in langs}
    for text, lang in set(labelled):
        for w in letter_words(text) if lang is not None else []:
            counts[0, lang][w] += 1
            for n in ORDERS:
                counts[n, lang].update(grams_of(w, n))
    logs = {}
    for n in (0, *ORDERS):
        share = -(-(max_grams if n else max_words) // len(langs))
        known = set()
        for x in langs:
            known |= {p for p, _ in sorted(counts[n, x].items(), key=lambda i: (-i[1], i[0]))[:share]}
        logs[n] = {p: [math.log((counts[n, x][p] + smoothing) / (sum(counts[n, x].values()) + smoothing * (len(known) + 1)))
                       for x in langs] for p in known}

    def vector(word):
        for n in (0, *ORDERS):
            found = [logs[n][p] for p in ([word] if n == 0 else grams_of(word, n)) if p in logs[n]]
            if found:
                return [sum(column) / len(found) for column in zip(*found)]
        return None

    out = []
    for text in texts:
        words = letter_words(text)
        vectors = [v for w in words if (v := vector(w)) is not None]
        if not words:
            out.append((UNDETERMINED, 0.0))
            continue
        if not vectors:
            out.append((langs[0], 1 / len(langs)))
            continue
        total = [sum(column) / math.sqrt(len(vectors)) for column in zip(*vectors)]
        best = max(range(len(langs)), key=lambda k: total[k])
        out.append((langs[best], 1 / sum(math.exp(t - total[best]) for t in total)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_counting(spark, seed):
    rnd = random.Random(seed)
    alphabets = {"aa": "abcde", "bb": "cdefg", "cc": "aegxy", None: "abxyz"}
    labelled = [(_drawn(rnd, letters, rnd.randint(0, 30)), lang)
                for lang, letters in alphabets.items() for _ in range(25)]
    labelled += labelled[:10] + [(None, "aa"), ("", "bb"), ("12", "dd")]
    texts = [t for t, _ in labelled] + [_drawn(rnd, "abcdefgxyzq", 8) for _ in range(40)] + ["漢字 q"]
    model = learn(spark.createDataFrame([(t, x, 1) for t, x in labelled], "text string, lang string, n int"),
                  max_words=60, max_grams=40)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in predict(docs, model).collect()}
    for k, (lang, score) in enumerate(_brute(labelled, texts, 60, 40)):
        assert got[k][0] == lang and got[k][1] == pytest.approx(score, rel=1e-9), texts[k]


def test_a_small_language_is_learned_beside_large_ones(spark):
    rnd = random.Random(3)
    rows = [(_drawn(rnd, "abcdefghij", 6), "large") for _ in range(20_000)]
    rows += [("copy of one text", "copies")] * 20_000 + [(_drawn(rnd, "fghijklmno", 6), "copies") for _ in range(50)]
    rows += [(_drawn(rnd, "klmnopqrst", 6), "small") for _ in range(40)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(6)
    model = learn(df, max_docs=200, max_words=900, max_grams=300)
    assert model.langs == ["copies", "large", "small"]
    assert all(len(rows) <= limit + 2 for rows, limit in
               [(model.rows[0], 900), *[(model.rows[n], 300) for n in ORDERS]])
    fresh = [(k, _drawn(rnd, "klmnopqrst", 8), "small") for k in range(60)]
    fresh += [(100 + k, _drawn(rnd, "abcdefghij", 8), "large") for k in range(60)]
    docs = spark.createDataFrame(fresh, "doc_id long, text string, lang string")
    got = predict(docs, model).join(docs, "doc_id")
    assert got.where("lang = lang_pred").count() >= 114
