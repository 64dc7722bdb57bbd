"""Report frames and the streaming share job."""

import math

from pyspark.sql import functions as F

from sift.operators import reports
from sift.session import new_scratch_path
from sift.streaming.shares import read_shares, run_share_by_day


def test_state_shades_follow_numpy_rules(spark):
    by_state = spark.createDataFrame([("Texas", 0.5, 0.9), ("Ohio", 0.2, 0.8)],
                                     "flair string, pos_share double, neg_share double")
    rows = {r["state"]: r for r in reports.report_states(spark, by_state).collect()}
    assert len(rows) == 50 and "District of Columbia" not in rows
    tx = rows["Texas"]
    assert abs(tx["pos_shade"] - (1 - math.sqrt((0.5 - 0.3) / (0.7 - 0.3)))) < 1e-12
    assert math.isnan(rows["Ohio"]["pos_shade"])      # below the range: NaN, as numpy
    assert rows["Utah"]["Positive"] is None            # no share row: null


def test_streaming_shares_resume_from_checkpoint(spark):
    src, out, ckpt = (new_scratch_path(spark, n) for n in ("s-src", "s-out", "s-ckpt"))
    day = 86400
    first = spark.createDataFrame([("a", 0, 1, 0), ("b", 10, 0, 1), ("c", day, 1, 1)],
                                  "id string, created_utc long, pos int, neg int")
    first.write.parquet(f"{src}/b=0")
    before = read_shares(spark, out)
    run_share_by_day(spark, src, first.schema, out, ckpt).awaitTermination()
    assert {str(r["date"]) for r in read_shares(spark, out).collect()} == {"1970-01-01", "1970-01-02"}
    assert before.count() == 0 and before.dtypes == read_shares(spark, out).dtypes
    second = spark.createDataFrame([("d", 20, 1, 0)], first.schema)
    second.write.parquet(f"{src}/b=1")
    run_share_by_day(spark, src, first.schema, out, ckpt).awaitTermination()
    day0 = read_shares(spark, out).where(F.col("date") == "1970-01-01").first()
    assert (day0["count"], day0["pos_count"], day0["neg_count"]) == (3, 2, 1)
