from collections import Counter

import pytest

from sift.operators import index, term_counts

ROWS = [(1, ["a", "b", "a", "b", "a"]), (2, []), (3, None), (1, ["a", "c"]), (None, ["a", "a"]),
        (None, ["b"]), (4, ["é"]), (5, ["b", "a", "b"]), (6, ["x"] * 3)]


@pytest.fixture(params=[4, 500_000])
def texts(spark, request, monkeypatch):
    # The function is pickled by value, with the limit of this test.
    monkeypatch.setattr(term_counts, "WORDS", request.param)
    return spark.createDataFrame(ROWS, "id long, words array<string>").repartition(2)


def test_words_per_text(texts):
    want = Counter((key, w) for key, words in ROWS for w in words or [])
    got = [((r.id, r.term), r["count"]) for r in term_counts.per_text(texts).collect()]
    assert len(got) == len(want) and dict(got) == want


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_ngrams_stay_within_a_text(texts, n):
    want = Counter("_".join(words[k:k + n]) for _, words in ROWS if words for k in range(len(words) - n + 1))
    got = [(r.term, r.n) for r in term_counts.ngram_counts(texts, n).collect()]
    assert len(got) == len(want) and dict(got) == want


def test_words_are_counted_before_the_groups(spark, capsys):
    texts = spark.createDataFrame([(1, "a b a")], "song_id long, text string")
    counts = index.token_counts(texts)
    counts.explain()
    plan = capsys.readouterr().out
    assert "Generate" not in plan and "MapInArrow" in plan
    assert sorted(map(tuple, counts.collect())) == [(1, "a", 2), (1, "b", 1)]


@pytest.mark.parametrize("max_hot", [1, 4, 10_000])
def test_scores_are_clustered_as_they_are_counted(spark, tmp_path, max_hot):
    rows = [(s, f"w{k}", s % 3 + 1) for s in range(40) for k in range(s % 7 + 1)] + [(3, None, 2), (None, "w0", 5)]
    tokens = spark.createDataFrame(rows, "song_id long, token string, count long").repartition(3)
    songs = spark.createDataFrame([(s,) for s in range(40)], "song_id long")
    df = index.doc_frequency(tokens)
    index.write_scores(tokens, songs, df, f"{tmp_path}/scores", 3, max_hot)
    order = lambda rows: sorted(map(tuple, rows), key=repr)
    stored = spark.read.parquet(f"{tmp_path}/scores")
    assert order(stored.collect()) == order(index.tfidf(tokens, songs, df).collect())


def test_index_writes_its_scores_once(spark, tmp_path, monkeypatch):
    written, write = [], index.write_scores
    monkeypatch.setattr(index, "write_scores", lambda *a, **kw: written.append(a[3]) or write(*a, **kw))
    texts = spark.createDataFrame([(1, "a b a"), (2, "b c")], "song_id long, text string")
    songs = spark.createDataFrame([(1, 7, "x", "/1"), (2, 7, "y", "/2")],
                                  "song_id long, artist_id long, song_name string, page_link string")
    idx = index.build(texts, songs, spark.createDataFrame([(7, "z")], "artist_id long, artist_name string"),
                      str(tmp_path))
    assert written == [f"{tmp_path}/tfidf"] and idx.scores.count() == 4
    assert sorted((r.song_id, r.token, round(r.score, 6)) for r in idx.scores.collect()) == [
        (1, "a", 0.60206), (1, "b", 0.0), (2, "b", 0.0), (2, "c", 0.30103)]
