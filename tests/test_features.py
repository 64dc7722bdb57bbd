"""Linear link removal, shares in one pass, term-keyed classifiers, block
maxima and index segments, each against a plain version."""

import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from sift.functions.links import strip_links_exact
from sift.operators import blocks, index, ranked, search, segments, sentiment, term_fit
from sift.session import delete_path, new_scratch_path

LINK = re.compile(r"\[((?:(?!\]\(http).)*)\]\(http[^ )]*\)", re.DOTALL)


def _plain_links(text):
    while True:
        m = LINK.search(text)
        if m is None:
            return text
        text = text[:m.start()] + m.group(1) + text[m.end():]


def test_links_on_random_texts():
    rnd = random.Random(6)
    parts = ["[", "]", "](http", "](http://x)", "(http", ")", " ", "a", "](", "h", "http", "[b](http://y)", "](ht", "tp", "\n"]
    for _ in range(40_000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14)))
        assert strip_links_exact(text) == _plain_links(text), text


@pytest.mark.parametrize("text", [
    "word [x] [y] " * 80_000 + "](http", "[" * 400_000 + "](http:)" * 100_000, "](http" * 160_000,
    "[" * 150_000 + "a" + "]" * 150_000 + "](http)" + "(http)" * 100_000, "[](http)" * 120_000 + "b" + "[](http)" * 9,
    "[a](http x" * 100_000])
def test_links_in_linear_time(text):
    started = time.process_time()
    strip_links_exact(text)
    assert time.process_time() - started < 4


def test_share_all_equals_the_single_tables(spark):
    rnd = random.Random(1)
    rows = [(f"c{k}", rnd.choice(["Texas", "Ohio", "nowhere", None]), rnd.choice([0, 86_400, 90_000, None]),
             rnd.choice([1, 2, None]), rnd.choice([5, 6]), rnd.choice(["s1", "s2", "s3", None]), rnd.random() < 0.6,
             rnd.random() < 0.3) for k in range(200)]
    scored = spark.createDataFrame(rows, "id string, flair string, created_utc long, cscore long, sscore long, "
                                         "sid string, pos boolean, neg boolean")
    scored = scored.withColumn("pos", F.col("pos").cast("int")).withColumn("neg", F.col("neg").cast("int"))
    shares = sentiment.share_all(scored)
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert same(sentiment.share_table(shares, "overall"), sentiment.share_overall(scored))
    for keep in (False, True):
        assert same(sentiment.share_table(shares, "day", keep), sentiment.share_by_day(scored, keep))
        assert same(sentiment.share_table(shares, "state", keep), sentiment.share_by_state(scored, keep))
        for name in ("comment_score", "submission_score", "story"):
            assert same(sentiment.share_table(shares, name, keep),
                        sentiment.share_by(scored, sentiment.SHARE_KEYS[name], keep))
    plan = shares._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2  # twice printed by adaptive execution at most


def test_area_under_roc_by_pairs(spark):
    rnd = random.Random(3)
    rows = [(g, rnd.choice([0.1, 0.2, 0.5, 0.50001, 0.9]) if g < 2 else rnd.random(), int(rnd.random() < 0.3))
            for g in (0, 1, 2) for _ in range(150)] + [(3, 0.5, 1), (3, 0.2, 1)]
    got = {r["g"]: r["auc"] for r in term_fit.area_under_roc(
        spark.createDataFrame(rows, "g int, s double, l int").repartition(6), "g", "s", "l").collect()}
    for g in (0, 1, 2):
        ones, zeros = ([s for h, s, l in rows if h == g and l == k] for k in (1, 0))
        wins = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros)
        assert math.isclose(got[g], wins / (len(ones) * len(zeros)))
    assert got[3] is None


def test_term_fit_follows_plain_steps(spark):
    rnd = random.Random(5)
    terms = {k: [t for t in "abcdefgh" if rnd.random() < 0.5] + ["hot"] for k in range(60)}
    terms[60] = []
    label = {k: rnd.choice([1, -1, 0]) for k in terms}
    features = spark.createDataFrame([(str(k), t + t[:1]) for k, t in terms.items()], "Input_id string, features array<string>")
    labels = spark.createDataFrame([(str(k), int(v == 1), int(v == -1)) for k, v in label.items()],
                                   "id string, positive int, negative int")
    pairs = term_fit.postings(features)
    known = term_fit.dictionary(pairs, 25)
    rows = sorted(known.collect(), key=lambda r: r.term_id)
    df = {t: sum(t in v for v in terms.values()) for t in [*"abcdefgh", "hot"]}
    assert [(r.term, r.df) for r in rows] == sorted(((t, n) for t, n in df.items() if n >= 25), key=lambda x: (-x[1], x[0]))
    assert [r.term_id for r in rows] == list(range(len(rows)))
    encoded = term_fit.encode(pairs, known)
    model = term_fit.fit(encoded, labels, known, steps=4, rate=0.2, reg=0.05)
    vocab = [r.term for r in rows]
    for side, want in (("pos", 1), ("neg", -1)):
        w, b = dict.fromkeys(vocab, 0.0), 0.0
        p = lambda k: 1 / (1 + math.exp(-b - sum(w.get(t, 0) for t in set(terms[k]))))
        for _ in range(4):
            r = {k: p(k) - (label[k] == want) for k in terms}
            g = {t: sum(v for k, v in r.items() if t in terms[k]) / len(r) for t in vocab}
            w, b = {t: w[t] - 0.2 * (g[t] + 0.05 * w[t]) for t in vocab}, b - 0.2 * sum(r.values()) / len(r)
        got = {vocab[x.term_id]: x[side] for x in model.weights.collect()}
        assert all(math.isclose(got[t], w[t], abs_tol=1e-12) for t in vocab)
        assert math.isclose(getattr(model, side), b, abs_tol=1e-12)
        scored = {x.id: x for x in term_fit.score(labels.select("id"), encoded, model, 0.3, 0.4).collect()}
        assert all(math.isclose(scored[str(k)][f"p_{side}"], p(k)) for k in terms)
        assert all(scored[str(k)][side] == int(p(k) > (0.3 if side == "pos" else 0.4)) for k in terms)


def _catalog(spark, n=1500):
    """Songs whose rare words score high in few blocks."""
    rnd = random.Random(9)
    texts = []
    for k in range(n):
        words = ["all"] + ["common"] * rnd.randint(0, 3) + ([f"rare{k % 7}"] * rnd.randint(1, 40) if k % 50 == 0 else [])
        texts.append((k, " ".join(words + [rnd.choice(["x", "y", "z"])])))
    texts = spark.createDataFrame(texts, "song_id long, text string")
    songs = texts.select("song_id", (F.col("song_id") % 4).alias("artist_id"), F.lit("s").alias("song_name"),
                         F.lit("/").alias("page_link"))
    artists = spark.createDataFrame([(i, f"a{i}") for i in range(3)], "artist_id long, artist_name string")
    return texts, songs, artists


def test_matched_pages_equal_the_plain_search_and_skip_blocks(spark):
    texts, songs, artists = _catalog(spark)
    tokens = index.token_counts(texts)
    scores = index.tfidf(tokens, songs)
    totals, names = index.song_totals(scores), search.name_table(songs, artists)
    places = ranked.build(tokens, totals, names, new_scratch_path(spark, "r")).places
    idx = blocks.build(scores, places, new_scratch_path(spark, "b"), block=32)
    queries = spark.createDataFrame([(0, "rare0 rare1", "or"), (1, "common x", "and"), (2, "all common y", "or"),
                                     (3, "none", "or"), (4, "rare3 none", "and"), (5, "rare2 common", "and")],
                                    "query_id long, text string, mode string")
    plain = search.batch_matches(scores, None, names, queries, score_scope="query")
    rows = lambda df: sorted(tuple(r) for r in df.select("query_id", "rank", "song_id", "score").collect())
    for page in (1, 2):
        assert rows(blocks.page(idx, queries, page, probe=2)) == rows(search.batch_page(plain, names, page))
    seen = []
    mixed = spark.createDataFrame([(0, "rare0 common", "or")], "query_id long, text string, mode string")
    plain = search.batch_matches(scores, None, names, mixed, score_scope="query")
    got = blocks.page(idx, mixed, 1, size=5, probe=2, blocks_scored=seen)
    assert rows(got) == rows(search.batch_page(plain, names, 1, size=5))
    assert seen[0] > 20 and seen[1] <= 4  # the others cannot reach the five best


def test_segments_merge_to_the_whole_index(spark):
    texts, songs, artists = _catalog(spark, 300)
    path = new_scratch_path(spark, "seg")
    part = lambda df, k: df.where(F.col("song_id") % 3 == k)
    whole = sorted((r.song_id, r.token, round(r.score, 9)) for r in index.tfidf(index.token_counts(texts), songs).collect())
    now = lambda: sorted((r.song_id, r.token, round(r.score, 9)) for r in segments.scores(spark, path).collect())
    segments.add(path, "a", part(songs, 0), part(texts, 0))
    segments.add(path, "b", part(songs, 1), tokens=index.token_counts(part(texts, 1)))
    again = songs.where(F.col("song_id") % 3 != 1)  # songs 0, 3, ... are known already
    segments.add(path, "c", again, texts)
    delete_path(spark, segments.add(path, "lost", songs.limit(0), texts) + "/complete")  # a load lost midway
    assert now() == whole and len(segments.segments(spark, path)) == 3
    segments.compact(spark, path, "one")
    assert now() == whole and [p.rsplit("/", 1)[-1] for p in segments.segments(spark, path)] == ["one"]
    song, token, frequencies = segments.open_segments(spark, path)
    assert song.count() == 300 and frequencies.where("token = 'all'").first().df == 300
    with pytest.raises(FileNotFoundError):
        segments.open_segments(spark, path + "-none")


def test_a_compaction_takes_effect_before_its_clean_up(spark, monkeypatch):
    texts, songs, artists = _catalog(spark, 60)
    path = new_scratch_path(spark, "seg")
    segments.add(path, "a", songs.where("song_id < 30"), texts)
    segments.add(path, "b", songs, texts)
    monkeypatch.setattr(segments, "delete_path", lambda *a: None)
    segments.compact(spark, path, "one")
    assert segments.open_segments(spark, path)[0].count() == 60
