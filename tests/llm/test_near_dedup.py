import random

import numpy as np
import pytest

from sift.llm.components import components
from sift.llm.near_dedup import _gamma_table, classes, draw, draw_plain, keep_one, may_reach, similar
from tests.llm.brute import jaccard, linked, shingle_set, weighted_jaccard, weighted_sets

SCHEMA = "doc_id long, text string, key string"  # key: a clashing extra column


def _text(rnd, n):
    return [f"w{rnd.randint(0, 3000)}" for _ in range(n)]


def _corpus(seed=3):
    rnd = random.Random(seed)
    rows, doc = [], 0
    for size in (2, 3, 40):
        base = _text(rnd, 150)
        for _ in range(size):
            copy = list(base)
            for _ in range(rnd.randint(0, 2)):
                copy[rnd.randrange(len(copy))] = "edit" + str(rnd.random())
            rows.append((doc, " ".join(copy), "x"))
            doc += 1
    for _ in range(40):
        rows.append((doc, " ".join(_text(rnd, 80)), "x"))
        doc += 1
    rows += [(500, rows[0][1], "x"), (501, None, "x"), (502, None, "x"), (503, "", "x"),
             (504, "a b", "x"), (505, "a b", None), (500, rows[0][1], "y")]
    return rows


def _components(rows, threshold):
    sets = [(k, shingle_set(t)) for k, (_, t, _) in enumerate(rows)]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in sets:
        for j, b in sets[:i]:
            if a and b and jaccard(a, b) >= threshold:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(rows))]


def _between(got, texts):
    """Whether the classes lie between those of thresholds a little higher and
    lower (document frequencies are estimates)."""
    sets = weighted_sets(texts)
    high, low = (linked(sets, weighted_jaccard, t) for t in (0.805, 0.795))
    assert all(got[k] == got[high[k]] for k in range(len(texts)))
    assert all(low[k] == low[got[k]] for k in range(len(texts)))
    return high


def test_classes_match_weighted_brute_force(spark):
    texts = [t for _, t, _ in _corpus() if t]
    rnd = random.Random(8)
    for k in range(60):  # copies around the threshold
        words = texts[k % 45].split()
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(len(words))] = f"new{rnd.random()}"
        texts.append(" ".join(words))
    texts += [" ".join([w] * 300) for w in ("again", "again", "once")] + ["long " + "word text " * 60_000] * 2
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], SCHEMA).repartition(4)
    for options in ({}, {"block": 4}):  # small blocks: buckets in many parts
        got = {r.doc_id: r.class_id for r in classes(df, **options).collect()}
        high = _between(got, texts)
    assert 40 < len(set(high)) < len(texts) - 40


def test_null_ids_share_classes(spark):
    rows = [(None, "a b c d e f g", "x"), (None, "a b c d e f g", "x"), (7, "h i j k l m", "x"), (None, "h i j k l m", "x"),
            (None, None, "x"), (3, None, None)]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.class_id is None, r.class_id or 0)
                 for r in classes(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(False, 3, False, 3), (False, 7, False, 7), (True, 0, False, 7)] + [(True, 0, True, 0)] * 3


def test_classes_match_plain_brute_force(spark):
    rows = _corpus()
    texts = [(i, t or "", x) for i, t, x in rows]
    df = spark.createDataFrame([(k, t, x) for k, (_, t, x) in enumerate(rows)], SCHEMA).repartition(4)
    got = {r.doc_id: r.class_id for r in classes(df, plain=True).collect()}
    roots = _components(texts, 0.8)
    want = {}
    for k, r in enumerate(roots):
        want.setdefault(r, []).append(k)
    for members in want.values():
        if rows[members[0]][1]:
            assert {got[m] for m in members} == {min(members)}
    assert got[len(rows) - 5] == len(rows) - 5  # nulls and empty texts stay alone


def test_keep_one_keeps_a_row_of_each_class(spark):
    rows = _corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    kept = keep_one(df)
    assert kept.columns == df.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == [0, 2, 5] + list(range(45, 85)) + [501, 502, 503, 504]


@pytest.mark.parametrize("options", [{"hub_rounds": 1}, {"hub_rounds": 1, "block": 4}])
def test_rounds_and_blocks_do_not_change_the_classes(spark, options):
    rnd = random.Random(9)
    base = _text(rnd, 60)
    rows = []
    for k in range(60):  # near copies of a text that is not there, about the threshold apart
        copy = list(base)
        for _ in range(rnd.randint(0, 2)):
            copy[rnd.randrange(len(copy))] = f"e{rnd.random()}"
        rows.append((k, " ".join(copy), "x"))
    df = spark.createDataFrame(rows, SCHEMA)
    _between({r.doc_id: r.class_id for r in classes(df, **options).collect()}, [t for _, t, _ in rows])
    got = {r.doc_id: r.class_id for r in classes(df, plain=True, **options).collect()}
    roots = _components(rows, 0.8)
    assert len(set(roots)) > 1
    assert all((got[i] == got[j]) == (roots[i] == roots[j]) for i in range(60) for j in range(i))


def test_block_mask_leaves_no_similar_pair_out():
    rnd = np.random.default_rng(4)
    pool = np.sort(rnd.integers(0, 2 ** 63, 60).astype(np.uint64))
    sets = []
    for _ in range(80):
        take = np.sort(rnd.choice(60, rnd.integers(1, 60), replace=False))
        sets.append((pool[take], rnd.uniform(1, 3, len(take))))
    for plain in (False, True):
        mask = may_reach(sets[:30], sets[30:], 0.6, plain)
        exact = np.array([[similar(a, b, 0.6, plain) for b in sets[30:]] for a in sets[:30]])
        assert exact.any() and not (exact & ~mask).any() and mask.mean() < 0.5


def test_samples_agree_with_weighted_jaccard():
    rnd = np.random.default_rng(1)
    shingles = rnd.integers(0, 2 ** 63, 400).astype(np.uint64)
    wa, wb = rnd.uniform(1, 2, 300), rnd.uniform(1, 2, 300)
    a, b = np.sort(shingles[:300]), np.sort(shingles[100:])
    table = _gamma_table()
    zero = np.zeros(300, np.int64)
    sa, sb = draw(zero, a, wa, 3000, table)[0], draw(zero, b, wb, 3000, table)[0]
    _, at, bt = np.intersect1d(a, b, return_indices=True)
    shared = np.minimum(wa[at], wb[bt]).sum()
    exact = shared / (wa.sum() + wb.sum() - shared)
    assert abs((sa == sb).mean() - exact) < 0.03


@pytest.mark.parametrize("edges", [[(1, 2), (2, 3), (9, 8), (3, 3)], [(i, i + 1) for i in range(30)],
                                   [(0, i) for i in range(1, 50)], []])
def test_components(spark, edges):
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    groups = {}
    for a, b in edges:
        merged = groups.get(a, {a}) | groups.get(b, {b})
        for x in merged:
            groups[x] = merged
    assert got == {x: min(g) for x, g in groups.items() if x != min(g)}


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert classes(empty).collect() == []
    assert keep_one(empty).collect() == []


def test_plain_samples_agree_with_plain_jaccard():
    rnd = np.random.default_rng(1)
    shingles = rnd.integers(0, 2 ** 63, 400).astype(np.uint64)
    zero = np.zeros(300, np.int64)
    a, b = np.sort(shingles[:300]), np.sort(shingles[100:])
    assert abs((draw_plain(zero, a, 3000) == draw_plain(zero, b, 3000)).mean() - 0.5) < 0.03


def test_texts_and_the_same_texts_repeated_are_one_class(spark):
    rnd = random.Random(11)  # plain similarity above 0.9, weighted about 0.6 and less
    rows = []
    for k in range(200):
        words = _text(rnd, 100)
        rows += [(2 * k, " ".join(words), "x"), (2 * k + 1, " ".join(words * (2 + k % 2)), "x")]
    got = {r.doc_id: r.class_id for r in classes(spark.createDataFrame(rows, SCHEMA), plain=True).collect()}
    assert [k for k in range(200) if got[2 * k + 1] != 2 * k] == []
