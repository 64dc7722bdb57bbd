"""The count-min prefilter of terms against a plain count."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sift.operators import frequent


def _terms(seed, n_rare, n_common):
    rnd = random.Random(seed)
    terms = [f"once_{seed}_{k}" for k in range(n_rare)]
    for k in range(n_common):
        terms += [f"common_{k}é"] * rnd.randint(1, 30)
    rnd.shuffle(terms)
    return terms


@pytest.mark.parametrize("seed,min_df", [(1, 10), (2, 2), (3, 10), (4, 1), (5, 2.5)])
def test_equals_the_plain_count(spark, seed, min_df):
    terms = _terms(seed, 4000, 300)
    df = spark.createDataFrame([(t, k) for k, t in enumerate([*terms, None, "", ""])], "term string, doc long")
    got = {r.term: r.df for r in frequent.frequent_terms(df.repartition(5), min_df, len(terms)).collect()}
    want = {t: n for t, n in Counter([*terms, "", ""]).items() if n >= min_df}
    assert got == want


def test_what_is_shuffled_is_under_half_and_holds_every_frequent_term(spark):
    terms = _terms(6, 20_000, 200)
    df = spark.createDataFrame([(t,) for t in terms], "term string").repartition(4)
    kept = Counter(r.term for r in frequent.candidates(df, 10, 128).collect())
    counts = Counter(terms)
    assert all(kept[t] == n for t, n in counts.items() if n >= 10)
    assert all(kept[t] in (0, n) for t, n in counts.items())
    assert sum(kept.values()) < len(terms) / 2
    rare = sum(1 for t in kept if counts[t] == 1)
    assert rare < 0.05 * 20_000


def test_wrong_bounds_and_full_sketches_change_nothing(spark):
    terms = _terms(7, 3000, 100)
    df = spark.createDataFrame([(t,) for t in terms], "term string")
    results = [sorted(map(tuple, frequent.frequent_terms(df, 5, n, max_cells=m).collect()))
               for n, m in ((len(terms), 1 << 22), (1, 1 << 22), (10**9, 1 << 22), (len(terms), 64))]
    assert results[0] and all(r == results[0] for r in results)


def test_one_hot_term_and_empty_table(spark):
    df = spark.range(50_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("term"))
    assert [tuple(r) for r in frequent.frequent_terms(df, 2, 50_000).collect()] == [("hot", 16_667)]
    assert frequent.frequent_terms(df.limit(0), 2, 0).collect() == []
    assert frequent.frequent_terms(df.limit(0), 2, 100).collect() == []


def test_a_task_shuffles_sketches_not_terms(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("term"))
    plan = frequent.frequent_terms(df, 10, 20_000)._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan[plan.index("count_min_sketch"):]
    assert "partial_count_min_sketch" in before_exchange
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
