"""Training-data pipeline over ``documents`` (counted as part of ``sift.llm``).

Every stage works on all rows its predecessor kept and takes effect: bad texts
and surplus copies go, benchmark passages are cut out, personal data is
redacted, and the last stage draws the mix. All stages but the last return the
columns of ``documents``; the last adds ``rate`` and ``copies``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sift.llm import decontaminate, mixing, near_dedup, pii, quality_mil
from sift.llm.components import written


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` again, after the texts changed."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_mil.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_mil.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(pii.redact(docs, pii.learn(docs)))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    domains = mixing.label_domains(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mixing.mixed_documents(docs, mixing.learn(docs, domains), mixing.TARGETS)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("mix_to_targets", mix_to_targets),
]

#: Models and classes have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; each result is written and read again, so no
    stage computes its predecessors anew."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
