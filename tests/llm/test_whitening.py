import math
import random

import numpy as np
import pytest

from sift.llm import whitening
from sift.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, whitened string, n int"  # clashing extra columns


def _plain(vectors, components=32):
    """Exact integers, then LAPACK."""
    x = np.array([[math.floor(64 * c) for c in v] for v in vectors], object) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    t = n * x - sums
    y = (t / n).astype(float)
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1], q[:, ::-1]
    return [int((r * r).sum()) for r in t], y @ q / np.sqrt(e), e / e.sum()


def _check(got, ids, vectors, tolerance=1e-7):
    deviation, white, share = _plain(vectors)
    d = min(32, len(vectors[0]))
    assert len(got) == len(ids) * d
    table = {(r.vec_id, r.component): r for r in got}
    for k in range(d):
        mine = np.array([table[i, k + 1].whitened for i in ids])
        sign = np.sign(mine @ white[:, k])
        assert np.abs(mine * sign - white[:, k]).max() < tolerance
        assert abs(table[ids[0], k + 1].explained / share[k] - 1) < 1e-10
    assert [table[i, 1].deviation for i in ids] == deviation
    assert {r.n for r in got} == {len(ids)}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_rank_one_updates_follow_the_eigenvalues():
    rng = np.random.default_rng(5)
    for lanes, d, count in [(3, 12, 60), (1, 1, 5), (2, 7, 4)]:
        values, vectors = np.zeros((lanes, d)), np.tile(np.eye(d), (lanes, 1, 1))
        a = np.zeros((lanes, d, d))
        for k in range(count):
            v = rng.normal(size=(lanes, d)) * 10.0 ** rng.integers(-6, 3)
            if k % 5 == 0:
                v[:, rng.integers(d)] = 0.0
            if k % 7 == 3:
                v = np.round(vectors[:, :, 0] * 3, 1)
            if k % 9 == 4:
                v[0] = 0.0
            a += v[:, :, None] * v[:, None, :]
            values, vectors = whitening.rank_one(values, vectors, v)
        for g in range(lanes):
            assert np.abs(vectors[g].T @ vectors[g] - np.eye(d)).max() < 1e-12
            assert np.abs(vectors[g] * values[g] @ vectors[g].T - a[g]).max() < 1e-12 * np.abs(a[g]).max()
            assert (np.diff(values[g]) >= 0).all()


def test_equal_poles_are_deflated():
    values, vectors = np.ones((1, 6)), np.eye(6)[None].copy()
    values, vectors = whitening.rank_one(values, vectors, np.arange(1.0, 7)[None])
    assert np.allclose(values[0], [1, 1, 1, 1, 1, 92])
    assert np.abs(vectors[0].T @ vectors[0] - np.eye(6)).max() < 1e-14


def test_combined_lanes_equal_one_lane():
    rng = np.random.default_rng(9)
    rows = rng.normal(size=(203, 9)) * np.arange(1, 10) + 40
    lanes = whitening.Spectra(5, 9)
    for at in range(0, len(rows), 5):
        lanes.add(rows[at:at + 5])
    one = lanes.joined()
    centred = rows - rows.mean(axis=0)
    assert one.n[0] == 203 and np.allclose(one.mean[0], rows.mean(axis=0))
    assert np.allclose(one.vectors[0] * one.values[0] @ one.vectors[0].T, centred.T @ centred, rtol=1e-10, atol=1e-9)


@pytest.mark.parametrize("partitions,d", [(1, 5), (40, 40)])
def test_matches_plain_eigenvectors(spark, partitions, d):
    rng = np.random.default_rng(d)
    mix = rng.normal(size=(d, d))
    vectors = (rng.normal(size=(400, d)) @ mix).astype(np.float32).astype(float).tolist()
    rows = [(k, v, "x", 1) for k, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    _check(whitening.whitened_rows(df).collect(), list(range(400)), vectors)


def test_odd_rows(spark):
    rnd = random.Random(2)
    good = [[rnd.uniform(-3, 3) for _ in range(3)] for _ in range(30)]
    good = np.array(good, np.float32).astype(float).tolist()
    rows = [(k, v, None, None) for k, v in enumerate(good)] + [(0, good[0], "x", 1)]
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [float("nan"), 0.0, 1.0]),
           (94, [float("inf"), 0.0, 1.0]), (95, [1.0, 2.0]), (96, [3e30, 0.0, 0.0])]
    df = spark.createDataFrame(rows + [(i, v, "x", 1) for i, v in bad] + [(None, good[1], "x", 1)], SCHEMA)
    got = whitening.whitened_rows(df).collect()
    assert {r.vec_id for r in got} == set(range(30)) | {None}
    assert len(got) == 3 * 32 and {r.n for r in got} == {32}
    again = [r.whitened for r in got if r.vec_id == 0]
    assert sorted(again)[::2] == sorted(again)[1::2]


def test_equal_vectors_and_empty_tables(spark):
    same = spark.createDataFrame([(k, [1.5, 2.0], "x", 1) for k in range(9)], SCHEMA)
    assert whitening.whitened_rows(same).collect() == []
    model = whitening.fit(same)
    assert model.n == 9 and [r.deviation for r in whitening.whiten(same, model).collect()] == [0] * 9
    assert whitening.whitened_rows(same.limit(0)).collect() == []
    line = spark.createDataFrame([(k, [float(k), 2.0 * k, 0.0], "x", 1) for k in range(50)], SCHEMA)
    got = whitening.whitened_rows(line).collect()
    assert {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-12


def test_far_values_are_exact(spark):
    vectors = [[2.0 ** 40 * k, 1.0 * k * k] for k in range(-3, 5)]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.deviation for r in whitening.whitened_rows(df).collect()}
    want, _, _ = _plain(vectors)
    assert got == {k: v if v < 2 ** 63 else None for k, v in enumerate(want)}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    got = QUERIES["op11_whitening"](spark, sf).collect()
    _check(got, [r.vec_id for r in rows], [r.embedding for r in rows])
