import random

import numpy as np
import pytest

from sift.llm import ngram_join
from tests.llm.brute import words

SCHEMA = "doc_id long, text string, key string, n string"  # clashing extra columns


def _sets(rows):
    out = []
    for _, text, *_ in rows:
        w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)) if text else []
        out.append({tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if w else set())
    return out


def _plain(rows):
    sets, up = _sets(rows), list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                up[root(i)] = root(j)
    least = {}
    for k, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            least[root(k)] = min(least.get(root(k), doc_id), doc_id)
    key = lambda r: tuple((v is not None, v or 0) for v in r)
    return sorted(((d, len(s), least.get(root(k))) for k, (s, (d, *_)) in enumerate(zip(sets, rows))), key=key)


def _got(df, **options):
    got = ngram_join.join(df, **options)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((tuple(r) for r in got.collect()), key=lambda r: tuple((v is not None, v or 0) for v in r))


def _rows(seed, count=260):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["É", "A", "\x1fx"]
    passage = [rnd.choice(vocab) for _ in range(60)]
    rows, bases = [], []
    for k in range(count):
        kind = rnd.random()
        if bases and kind < 0.6:  # near copies around the threshold
            text = list(rnd.choice(bases[-6:]))
            for _ in range(rnd.randint(0, 1 + len(text) // 25)):
                text[rnd.randrange(len(text))] = rnd.choice(vocab)
            text = text[rnd.randint(0, 3):]
        elif kind < 0.75:
            text = passage + [rnd.choice(vocab) for _ in range(rnd.randint(1, 30))]
        else:
            text = [rnd.choice(vocab) for _ in range(rnd.choice([1, 2, 4, 5, 8, 40, 150]))]
            bases.append(text)
        rows.append((rnd.randint(0, 200), rnd.choice([" ", "\n", "\t "]).join(text), "x", None))
    rows += rows[:4] + [(300, None, "x", "1"), (301, "", None, None), (302, " \n", "", ""), (None, rows[0][1], "x", "x"),
                        (None, "all alone here w1 w2", "x", "x"), (303, "a A a A a", "", ""), (304, "A a a a", "", ""),
                        (305, "a a a a", "", ""), (306, "a a a", "", ""), (307, "A A A", "", "")]
    return rows


@pytest.mark.parametrize("seed,options", [
    (1, {}), (2, {"small": 1, "hub_rounds": 1, "block": 4}), (3, {"small": 2, "hub_rounds": 0, "block": 7}),
    (4, {"rare": 0.5}), (5, {"small": 1, "hub_rounds": 3})])
def test_matches_brute_force(spark, seed, options):
    rows = _rows(seed)
    assert _got(spark.createDataFrame(rows, SCHEMA).repartition(5), **options) == _plain(rows)


def test_empty_table_and_no_words(spark):
    df = spark.createDataFrame([(1, None, "", ""), (1, " ", "", "")], SCHEMA)
    assert _got(df.limit(0)) == [] and _got(df) == [(1, 0, 1), (1, 0, 1)]


def test_very_long_texts(spark):
    rnd = random.Random(8)
    long = [f"v{rnd.randrange(5000)}" for _ in range(40_000)]
    near = [w if rnd.random() > 0.01 else "x" for w in long]
    far = [w if rnd.random() > 0.2 else "y" for w in long]
    rows = [(k, " ".join(t), "", "") for k, t in enumerate([long, near, far, ["one"] * 50_000, ["one"] * 4])]
    assert _got(spark.createDataFrame(rows, SCHEMA).repartition(3)) == _plain(rows)


@pytest.mark.parametrize("percent", [85, 60, 95])
def test_linked_sets_share_a_combination(percent):
    """Whatever the frequencies are, for pairs on the threshold."""
    rng = np.random.default_rng(percent)
    for trial in range(400):
        n = int(rng.choice([1, 2, 3, 5, 6, 7, 13, 40, 120, 500]))
        index = ngram_join.Index(rng.choice([1, 20, 200], 2 * 64).astype(np.int64), 64, 16.0, percent)
        a = np.unique(rng.integers(0, 2 ** 63, n, dtype=np.uint64))
        gone = int(rng.integers(0, n - -(-percent * n // 100) + 1))
        b = rng.permutation(a)[gone:]
        while True:  # as many new ones as the threshold allows
            more = np.concatenate([b, rng.integers(0, 2 ** 63, 1, dtype=np.uint64)])
            if not ngram_join.links(a, np.sort(more), percent) or rng.random() < 0.02:
                break
            b = more
        b = np.sort(b)
        assert ngram_join.links(a, b, percent)
        assert ngram_join.may_link(ngram_join.Index.histogram(a), ngram_join.Index.histogram(b), percent)
        assert len(np.intersect1d(index.combinations(a), index.combinations(b))), (n, len(b), gone)


def test_combinations_stay_linear():
    rng = np.random.default_rng(1)
    for estimate in (1, 20, 200):
        index = ngram_join.Index(np.full(128, estimate), 64, 16.0, 85)
        for n in (10, 100, 1000, 10_000):
            buckets = index.combinations(np.unique(rng.integers(0, 2 ** 63, n, dtype=np.uint64)))
            assert len(buckets) < 4 * n + 20


def test_block_links_equal_pairs():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2 ** 63, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[:k], rng.integers(0, 2 ** 63, 4, dtype=np.uint64)])) for k in range(40, 60)]
    want = [[ngram_join.links(a, b, 85) for b in sets] for a in sets]
    assert ngram_join.linked(sets, sets, 85).tolist() == want
