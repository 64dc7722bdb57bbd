"""Every pipeline stage on rows that are odd in every way, and on no rows."""

import corpus_pipeline
from sift.llm.components import written

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "score string, key string, spans string")  # the last three: clashing extra columns


def _run(spark, docs):
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), name)
        seen[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    return seen


def test_odd_rows(spark):
    good = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(None, "a null id with some words of prose here.", None, None, None, None, None, None),
            (9001, None, None, None, None, None, None, None), (9002, "", "en", "s", 0, "x", "x", "x"),
            (9003, "same text twice, once per id.", "en", "s", 5, "x", "x", "x"),
            (9004, "same text twice, once per id.", "en", "s", 5, "x", "x", "x"),
            (9003, "same text twice, once per id.", "en", "s", 5, "x", "x", "x"),
            (9005, "word " * 60_000 + "mail a.b@c.de now.", "en", "s", 5, "x", "x", "x"),
            (None, "a null id with some words of prose here.", None, None, None, None, None, None)]
    docs = good.selectExpr(*good.columns, "'x' as score", "'x' as key", "'x' as spans").unionByName(
        spark.createDataFrame(rows, SCHEMA))
    seen = _run(spark, docs)
    kept = seen["near_duplicates"].where("text = 'same text twice, once per id.'").collect()
    assert [r.doc_id for r in kept] in ([9003], [])
    redacted = seen["personal_data"]
    assert redacted.where("text like '%a.b@c.de%'").count() == 0
    assert redacted.where("n_chars is distinct from length(text)").count() == 0
    assert seen["mix_to_targets"].where("copies < 1 or rate < 0").count() == 0
    assert seen["mix_to_targets"].columns == docs.columns + ["rate", "copies"]


def test_no_rows(spark):
    seen = _run(spark, spark.createDataFrame([], SCHEMA))
    assert all(df.count() == 0 for df in seen.values())
