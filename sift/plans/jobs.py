"""End-to-end jobs, as the reference runs them.

``sentiment_job`` is the comment job: stage the raw inputs as parquet, join
labels, train (or load) the paired classifiers, score comments, and write
the share tables as CSV plus the per-story table and top lists as parquet.
``search_index_job`` builds the stored search index. Both are compositions
of the library's operators; every write goes through the executors to the
given (shared) output folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.flags import NEGATIVE_THRESHOLD, POSITIVE_THRESHOLD
from ..operators import index, ml, sampling, sentiment
from ..sources import files


def sentiment_job(spark: SparkSession, comments: DataFrame, submissions: DataFrame,
                  labeled: DataFrame, out_dir: str, sample_fraction: float | None = None,
                  keep_all: bool = False) -> dict[str, str]:
    """Run the comment job; returns the written paths by name.

    ``sample_fraction`` scores a key-hash sample (the reference scores 2%);
    ``None`` scores every comment. Models are reused from
    ``out_dir/models`` when a completed save exists there.
    """
    out = out_dir.rstrip("/")
    comments = files.stage(spark, f"{out}/stage/comments", lambda: comments)
    submissions = files.stage(spark, f"{out}/stage/submissions", lambda: submissions)
    labeled = files.stage(spark, f"{out}/stage/labeled_data", lambda: labeled)
    labeled_comments = files.stage(spark, f"{out}/stage/labeled_comments",
                                   lambda: sentiment.labeled_comments(labeled, comments))

    model_dir = f"{out}/models"
    # A marker of our own, written after all three models, tells a complete save.
    if files.path_exists(spark, f"{model_dir}/complete/_SUCCESS"):
        models = ml.SentimentModels.load(model_dir)
    else:
        models, _ = ml.train(labeled_comments)
        models.save(model_dir)
        spark.range(1).write.mode("overwrite").parquet(f"{model_dir}/complete")

    to_score = comments if sample_fraction is None else \
        sampling.hash_sample(comments, "id", sample_fraction)
    with_title = sentiment.comments_with_title(to_score, submissions)
    # What the scores depend on is part of the stage's name.
    scope = (f"sample={'all' if sample_fraction is None else sample_fraction}"
             f"-pos={POSITIVE_THRESHOLD}-neg={NEGATIVE_THRESHOLD}")
    scored = files.stage(spark, f"{out}/stage/scored-{scope}", lambda: ml.score(with_title, models))

    # All tables come from one pass over the scored comments; they are small.
    shares = files.stage(spark, f"{out}/stage/shares-{scope}", lambda: sentiment.share_all(scored))
    written = {}
    for name, dimension in (("count_all", "overall"), ("count_days", "day"), ("count_states", "state"),
                            ("count_cscore", "comment_score"), ("count_sscore", "submission_score")):
        files.write_report(sentiment.share_table(shares, dimension, keep_all), f"{out}/{name}")
        written[name] = f"{out}/{name}"
    by_story = sentiment.share_table(shares, "story", keep_all)
    by_story.write.mode("overwrite").parquet(f"{out}/count_story")
    written["count_story"] = f"{out}/count_story"
    story_table = spark.read.parquet(f"{out}/count_story")
    for name, share in (("top_pos", "pos_share"), ("top_neg", "neg_share")):
        sentiment.top_stories(story_table, share).write.mode("overwrite").parquet(f"{out}/{name}")
        written[name] = f"{out}/{name}"
    return written


def search_index_job(texts: DataFrame | None, songs: DataFrame, artists: DataFrame,
                     out_dir: str, tokens: DataFrame | None = None) -> index.Index:
    """Build and store the search catalog and TF-IDF index under ``out_dir``,
    from texts or from a given token table."""
    return index.build(texts, songs, artists, out_dir.rstrip("/"), tokens=tokens)
