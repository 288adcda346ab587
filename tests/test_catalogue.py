"""Every query against its SQL, and the rows of those without SQL."""

from __future__ import annotations

from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as entry
from kontora.plans import catalogue

FOLDER = "/root/testdata/sf0.001"
TABLES = "orders documents pages".split()


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, datetime):
        return v.isoformat()
    return repr([plain(x) for x in v]) if isinstance(v, (list, tuple)) else repr(v)


def rows_of(names, rows):
    at = [names.index(c) for c in sorted(names)]
    return sorted(tuple(plain(r[i]) for i in at) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, FOLDER)
    want = duck.sql(catalogue.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_without_sql(spark, name):
    assert catalogue.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert {r.tier for r in entry.entry(spark).collect()} >= {"tier1_email", "dropped"}
