"""The driver contract at sf0.001: entry runs, and every SQL-checked query
matches its DuckDB SQL (row count, columns, order-insensitive values)."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as entry
from sift.plans.queries import QUERIES
from sift.sources.tables import TABLES

from .conftest import SF_SMALL

ML = {"ml_cv_auc", "ml_evaluate", "ml_score", "ml_save_load", "ml_share_by_day", "sentiment_job",
      "sample_comments_bernoulli"}


def _norm(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, bool):
        return str(v).lower()
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["query_id", "rank", "song_id", "song", "artist_name", "page_link", "score"]


def test_every_query_has_sql_or_is_ml():
    assert set(QUERIES) - set(entry.oracle_sql()) == ML


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) & set(QUERIES)))
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(df.columns, srows) == _digest(dcols, drows)
