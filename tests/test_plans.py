"""Plan properties that matter at scale, checked on the physical plan."""

from pyspark.sql import functions as F

from sift.functions import text as T
from sift.operators import index, search
from sift.session import new_scratch_path


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_single_query_pushes_tokens_into_the_index_scan(spark):
    texts = spark.createDataFrame([(1, "love me"), (2, "you and me")], "song_id long, text string")
    songs = spark.createDataFrame([(1, 1, "a", "/1"), (2, 1, "b", "/2")],
                                  "song_id long, artist_id long, song_name string, page_link string")
    artists = spark.createDataFrame([(1, "z")], "artist_id long, artist_name string")
    idx = index.build(texts, songs, artists, new_scratch_path(spark, "plan-idx"))
    found = search.search_one(spark, idx.scores, idx.totals, idx.names, "love you", "or")
    found.collect()
    plan = _plan(found)
    assert "PushedFilters: [In(token" in plan or "PushedFilters: [IsNotNull(token), In(token" in plan


def test_exploding_words_does_not_re_run_cleaning(spark):
    docs = spark.createDataFrame([(1, "a b. c")], "doc_id long, text string")
    words = T.explode_terms(docs.select("doc_id", T.clean_words(F.col("text")).alias("w")),
                            F.col("w"), "token", "doc_id")
    plan = words._jdf.queryExecution().optimizedPlan().toString()
    # explode() would add an inferred size(...) > 0 filter holding the whole
    # cleaning expression; explode_outer + not-null must not.
    assert "size(" not in plan
    assert sorted(r["token"] for r in words.collect()) == ["a", "b", "c"]


def test_building_text_plans_runs_no_shuffle(spark):
    from sift.plans import queries as Q
    from .conftest import SF_SMALL
    tracker = spark.sparkContext.statusTracker()
    for build in (Q._labelled_words, Q._scoring_input, Q.q_clean_tokens, Q.q_comments_with_title):
        spark.sparkContext.setJobGroup("plan-only", "")
        df = build(spark, SF_SMALL)
        stages = [len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup("plan-only")]
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        # Schema reads are single-stage jobs over file footers; a shuffle or a
        # broadcast would show in the plan as a finished query stage.
        assert all(n == 1 for n in stages)
        assert "QueryStage" not in _plan(df)


def test_scoring_never_shuffles_text_by_story(spark):
    from sift.functions.text import with_features
    from sift.plans import queries as Q
    from .conftest import SF_SMALL
    plan = with_features(Q._scoring_input(spark, SF_SMALL), "body")._jdf.queryExecution().toString()
    exchanges = [line for line in plan.split("\n") if "REPARTITION" in line and "sid" in line]
    assert not exchanges


def test_batch_page_cuts_each_query_before_the_shuffle(spark):
    matches = spark.createDataFrame([(q, s, float(s % 7)) for q in range(3) for s in range(100)],
                                    "query_id long, song_id long, score double")
    names = spark.createDataFrame([(s, f"n{s}", "a", "/l") for s in range(100)],
                                  "song_id long, song string, artist_name string, page_link string")
    page = search.batch_page(matches, names, 2)
    assert "WindowGroupLimit" in _plan(page)
    rows = page.where("query_id = 1").orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(21, 41))
    ordered = sorted(range(100), key=lambda s: (-(s % 7), s))
    assert [r["song_id"] for r in rows] == ordered[20:40]
