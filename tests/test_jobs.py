"""End-to-end comment job on the smallest scale."""

from sift.plans import jobs
from sift.session import new_scratch_path
from sift.sources import files, schemas, tables

from .conftest import SF_SMALL


def test_sentiment_job_writes_reports_and_reuses_models(spark):
    out = new_scratch_path(spark, "job-test")
    args = (tables.comments(spark, SF_SMALL), tables.submissions(spark, SF_SMALL),
            tables.labeled_data(spark, SF_SMALL), out)
    written = jobs.sentiment_job(spark, *args)
    assert set(written) == {"count_all", "count_days", "count_states", "count_cscore",
                            "count_sscore", "count_story", "top_pos", "top_neg"}
    days = files.read_report(spark, written["count_days"], schemas.DAYS_REPORT).collect()
    assert all(r["count"] >= max(r["pos_count"], r["neg_count"]) and r["date"] for r in days)
    overall = files.read_report(spark, written["count_all"], schemas.OVERALL_REPORT).collect()
    assert len(overall) == 1 and overall[0]["count"] > 0
    assert 0.0 <= overall[0]["pos_share"] <= 1.0
    # Second run: models and stages are read back, not rebuilt.
    again = jobs.sentiment_job(spark, *args)
    assert again == written
    assert files.path_exists(spark, f"{out}/models/pos.model/metadata/_SUCCESS")


def test_other_sample_fraction_gives_other_rows(spark):
    from sift.operators import sampling
    out = new_scratch_path(spark, "job-sample-test")
    comments = tables.comments(spark, SF_SMALL)
    args = (comments, tables.submissions(spark, SF_SMALL), tables.labeled_data(spark, SF_SMALL), out)

    def scored():
        return files.read_report(spark, f"{out}/count_all", schemas.OVERALL_REPORT).first()["count"]

    jobs.sentiment_job(spark, *args, sample_fraction=0.5)
    half = scored()
    assert half == sampling.hash_sample(comments, "id", 0.5).count()
    jobs.sentiment_job(spark, *args)
    assert scored() == comments.count() > half
