"""Declared schemas for every file the pipelines read.

Declaring them avoids an inference pass over the data (for bz2 JSON that is a
full extra read) and pins the types the reference's DDL implies.
"""

from pyspark.sql.types import (DateType, DoubleType, LongType, StringType,
                               StructField, StructType)

# Search catalog (comma CSV, double-quote quoting, no header).
ARTIST = StructType([
    StructField("artist_id", LongType(), False),
    StructField("artist_name", StringType(), True),
])
SONG = StructType([
    StructField("song_id", LongType(), False),
    StructField("artist_id", LongType(), True),
    StructField("song_name", StringType(), True),
    StructField("page_link", StringType(), True),
])
TOKEN = StructType([
    StructField("song_id", LongType(), False),
    StructField("token", StringType(), False),
    StructField("count", LongType(), True),
])
TFIDF = StructType([
    StructField("song_id", LongType(), False),
    StructField("token", StringType(), False),
    StructField("score", DoubleType(), True),
])

# Length rules of the catalog DDL (VARCHAR(n)).
MAX_LENGTH = {
    ("artist", "artist_name"): 255,
    ("song", "song_name"): 255,
    ("song", "page_link"): 1000,
    ("token", "token"): 255,
}

# Comment and submission dumps (JSON lines, usually bz2).
COMMENTS = StructType([
    StructField("id", StringType(), True),
    StructField("body", StringType(), True),
    StructField("author", StringType(), True),
    StructField("author_flair_text", StringType(), True),
    StructField("created_utc", LongType(), True),
    StructField("link_id", StringType(), True),
    StructField("score", LongType(), True),
])
SUBMISSIONS = StructType([
    StructField("id", StringType(), True),
    StructField("title", StringType(), True),
    StructField("score", LongType(), True),
])

# Labelled comments (CSV with header; every column a string).
LABELED_DATA = StructType([
    StructField("Input_id", StringType(), True),
    StructField("labeldjt", StringType(), True),
])

# Report CSVs written by the sentiment job and read by the reports.
SHARE_REPORT_VALUE = [
    StructField("count", LongType(), True),
    StructField("pos_count", LongType(), True),
    StructField("neg_count", LongType(), True),
    StructField("pos_share", DoubleType(), True),
    StructField("neg_share", DoubleType(), True),
]


def share_report(key: str, key_type=StringType()) -> StructType:
    return StructType([StructField(key, key_type, True)] + SHARE_REPORT_VALUE)


OVERALL_REPORT = StructType(list(SHARE_REPORT_VALUE))
DAYS_REPORT = share_report("date", DateType())
STATES_REPORT = share_report("flair", StringType())
SSCORE_REPORT = share_report("sscore", LongType())
CSCORE_REPORT = share_report("cscore", LongType())
