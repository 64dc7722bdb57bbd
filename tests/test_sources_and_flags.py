"""Sources, sinks, label flags, link ids, dates and share semantics."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from sift.functions import flags
from sift.operators import sentiment
from sift.session import new_scratch_path
from sift.sources import files, schemas


def test_csv_catalog_quoting(spark):
    d = tempfile.mkdtemp(prefix="sift-csv-")
    path = os.path.join(d, "song.csv")
    with open(path, "w") as f:
        f.write('1,10,"say ""hi"", ok",\n')
        f.write('3,10,"multi\nline",y\n')
        f.write('2,10,"",x\n')
    rows = {r["song_id"]: r for r in files.read_catalog_table(spark, path, "song").collect()}
    assert rows[1]["song_name"] == 'say "hi", ok' and rows[1]["page_link"] is None
    assert rows[3]["song_name"] == "multi\nline"
    # A quoted empty field is an empty string, an unquoted one NULL (as in
    # the database's CSV format).
    assert rows[2]["song_name"] == ""
    assert len(rows) == 3


def test_csv_keeps_spaces_and_line_ends(spark):
    names = ["  lead trail  ", "a\r\nb", "", None, 'q"q', "x,y", "\ttab"]
    df = spark.createDataFrame([(i, 1, n, "/l") for i, n in enumerate(names)],
                               "song_id long, artist_id long, song_name string, page_link string")
    path = new_scratch_path(spark, "csv-spaces")
    files.write_catalog_table(df, path)
    back = {r["song_id"]: r["song_name"] for r in files.read_catalog_table(spark, path, "song").collect()}
    assert back == dict(enumerate(names))


def test_malformed_csv_row_fails(spark):
    path = new_scratch_path(spark, "csv-bad")
    spark.createDataFrame([("1,10,a,b",), ("x7,notanumber,c,d",)], "line string").coalesce(1).write.text(path)
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        files.read_catalog_table(spark, path, "song").collect()


def test_hash_sample_fractions(spark):
    from sift.operators.sampling import hash_sample
    df = spark.range(40_000).selectExpr("if(id = 5, null, id) as id")
    assert hash_sample(df, "id", 1.0).count() == 40_000
    assert hash_sample(df, "id", 0.0).count() == 0
    assert 5 <= hash_sample(df, "id", 0.0005).count() <= 45
    assert abs(hash_sample(df, "id", 0.02).count() - 800) < 120
    assert hash_sample(df.repartition(7), "id", 0.02).exceptAll(hash_sample(df, "id", 0.02)).count() == 0


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace
    from sift.session import scratch_dir
    unset = SimpleNamespace(get=lambda key, default=None: default)
    context = SimpleNamespace(master="spark://m:7077", getConf=lambda: unset, getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(SimpleNamespace(conf=unset, sparkContext=context))


def test_released_scratch_is_deleted(spark):
    from sift import session
    saved = session._CREATED.pop(spark.sparkContext.applicationId, [])
    try:
        path = new_scratch_path(spark, "gone")
        spark.range(3).write.parquet(path)
        session.release_scratch(spark)
        assert not files.path_exists(spark, path)
    finally:
        session._CREATED[spark.sparkContext.applicationId] = saved


def test_label_flags(spark):
    df = spark.createDataFrame([("1",), ("-1",), ("0",), (None,), ("abc",)], "l string")
    got = df.select(flags.positive_flag(F.col("l")).alias("p"),
                    flags.negative_flag(F.col("l")).alias("n")).collect()
    assert [(r["p"], r["n"]) for r in got] == [(1, 0), (0, 1), (0, 0), (None, None), (None, None)]


def test_link_prefix_and_epoch_date(spark):
    df = spark.createDataFrame([("t3_abc", 1541030400)], "l string, t long")
    r = df.select(flags.strip_link_prefix(F.col("l")).alias("s"),
                  flags.epoch_to_date(F.col("t")).alias("d")).first()
    assert r["s"] == "abc" and str(r["d"]) == "2018-11-01"


def test_share_keep_all(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 1, 0), ("b", 1, 1), ("b", 0, 0), (None, 1, 1)],
                               "k string, pos int, neg int")
    assert [r["k"] for r in sentiment.share_by(df, "k").collect()] == ["b"]
    kept = {r["k"]: r for r in sentiment.share_by(df, "k", keep_all=True).collect()}
    assert set(kept) == {"a", "b"} and kept["a"]["pos_share"] == 1.0


def test_share_equals_three_join_form(spark):
    rows = [(k % 7, int(k % 3 == 0), int(k % 5 == 0)) for k in range(200)]
    df = spark.createDataFrame(rows, "k long, pos int, neg int")
    total = df.groupBy("k").count()
    pos = df.where("pos = 1").groupBy("k").agg(F.count("*").alias("pos_count"))
    neg = df.where("neg = 1").groupBy("k").agg(F.count("*").alias("neg_count"))
    joined = total.join(pos, "k").join(neg, "k").select("k", "pos_count", "neg_count")
    ours = sentiment.share_by(df, "k").select("k", "pos_count", "neg_count")
    assert ours.exceptAll(joined).count() == 0 and joined.exceptAll(ours).count() == 0


def test_stage_reads_existing(spark):
    path = new_scratch_path(spark, "stage-test")
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)
    assert files.stage(spark, path, build).count() == 5
    assert files.stage(spark, path, build).count() == 5
    assert len(calls) == 1


def test_report_roundtrip(spark):
    path = new_scratch_path(spark, "report-test")
    df = spark.createDataFrame([("2024-01-02", 3, 1, 2, 1 / 3, 2 / 3)],
                               "date string, count long, pos_count long, neg_count long, "
                               "pos_share double, neg_share double").withColumn("date", F.to_date("date"))
    files.write_report(df, path)
    back = files.read_report(spark, path, schemas.DAYS_REPORT).first()
    assert back["pos_share"] == 1 / 3 and str(back["date"]) == "2024-01-02"


def test_epoch_of_zoneless_timestamp_ignores_session_zone(spark):
    import datetime
    df = spark.createDataFrame([(datetime.datetime(2024, 7, 1, 12, 30, 5, 900000),)],
                               "ts timestamp_ntz")
    want = int(datetime.datetime(2024, 7, 1, 12, 30, 5, tzinfo=datetime.timezone.utc).timestamp())
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ["UTC", "America/Los_Angeles", "Asia/Kolkata"]:
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert df.select(flags.ntz_to_epoch(F.col("ts"))).first()[0] == want, zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
