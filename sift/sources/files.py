"""File sources and sinks.

All reads declare their schema (no inference pass). Writes go through the
executors; nothing is funnelled through the driver the way the reference's
``toPandas().to_csv`` does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from ..session import file_system
from . import schemas

# --- fixed values (must equal the reference's for identical results) -------
CSV_DELIMITER = ","
CSV_QUOTE = '"'
# ---------------------------------------------------------------------------


def _csv_options(header: bool) -> dict[str, str]:
    # escape = quote makes a doubled quote ("") read as one quote, as in the
    # database's CSV format. Spaces belong to the field, and with one fixed
    # line separator a carriage return inside quotes stays what it is.
    return {"header": str(header).lower(), "sep": CSV_DELIMITER, "quote": CSV_QUOTE,
            "escape": CSV_QUOTE, "lineSep": "\n", "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false"}


def _csv_reader(spark: SparkSession, schema: StructType, header: bool, multi_line: bool = False):
    # ``multi_line`` keeps quoted newlines inside a field, but such a file
    # cannot be split: only for tables whose fields can hold one.
    # An unquoted empty field is NULL and a quoted one ("") an empty string,
    # as in the database: the reader returns ``nullValue`` for the first and
    # ``emptyValue`` for the second, so ``nullValue`` is set to a character
    # such CSV cannot hold (NUL) and only the unquoted case maps to null.
    # A malformed row fails the read, as it fails the database's load.
    return (spark.read.schema(schema).options(**_csv_options(header))
            .option("multiLine", multi_line)
            .option("nullValue", "\u0000")
            .option("mode", "FAILFAST"))


def _csv_writer(df: DataFrame, header: bool):
    return df.write.mode("overwrite").options(**_csv_options(header))


# --- S1: the search catalog ----------------------------------------------------

CATALOG = {"artist": schemas.ARTIST, "song": schemas.SONG, "token": schemas.TOKEN}
MULTI_LINE = {"artist", "song"}  # names may hold line breaks; tokens never do


def read_catalog_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One catalog table from headerless, double-quoted CSV."""
    return _csv_reader(spark, CATALOG[table], False, table in MULTI_LINE).csv(path)


def read_raw_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The same file with all columns as text; a row with another number of
    fields is kept whole in ``_corrupt_record``. No row ends the read."""
    fields = [StructField(f.name, StringType()) for f in CATALOG[table].fields]
    schema = StructType([*fields, StructField("_corrupt_record", StringType())])
    return (_csv_reader(spark, schema, False, table in MULTI_LINE)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").csv(path))


def write_catalog_table(df: DataFrame, path: str) -> None:
    _csv_writer(df, header=False).csv(path)


# --- S3: comment and submission dumps ------------------------------------------

def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines (bz2 or plain; bz2 splits, so large dumps read in parallel)."""
    return spark.read.schema(schema).json(path)


def read_comments(spark: SparkSession, path: str) -> DataFrame:
    return read_json_lines(spark, path, schemas.COMMENTS)


def read_submissions(spark: SparkSession, path: str) -> DataFrame:
    return read_json_lines(spark, path, schemas.SUBMISSIONS)


def write_json_lines(df: DataFrame, path: str, compression: str | None = "bzip2") -> None:
    w = df.write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.json(path)


# --- S4: labelled comments -----------------------------------------------------

def read_labeled(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; every column is read as a string, like the source."""
    return _csv_reader(spark, schemas.LABELED_DATA, header=True).csv(path)


def write_labeled(df: DataFrame, path: str) -> None:
    _csv_writer(df, header=True).csv(path)


# --- S5 / S6 / S7: parquet stages -------------------------------------------------

def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster's file system (HDFS, object store,
    local), not the driver's local disk."""
    fs, hpath = file_system(spark, path)
    return fs.exists(hpath)


def stage(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read the stage at ``path`` if a completed write exists, else build it,
    write it as parquet and read it back.

    Completion is the ``_SUCCESS`` marker of that stage's own directory (the
    reference tests one directory for three tables). Reading back the written
    files cuts the lineage, so later failures recompute from the stage.
    """
    if not path_exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# --- S10 / S11: report CSVs --------------------------------------------------------

def write_report(df: DataFrame, path: str) -> None:
    """A share table as CSV with a header, written by the executors."""
    _csv_writer(df, header=True).csv(path)


def read_report(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return _csv_reader(spark, schema, header=True).csv(path)
