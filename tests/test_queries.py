"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import datetime
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


def plain(x):
    if isinstance(x, datetime.datetime) and x.time() == datetime.time(0):
        return str(x.date())
    return str(x) if isinstance(x, datetime.date) else round(x + 0.0, 6) if isinstance(x, float) else x


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    sql = con.sql(entry.oracle_sql()[name])
    assert sorted(sql.columns) == columns
    key = lambda row: tuple(map(str, row))
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=key)
    at = [sql.columns.index(c) for c in columns]
    expected = sorted((tuple(plain(r[i]) for i in at) for r in sql.fetchall()), key=key)
    assert got == expected


def test_entry(spark):
    assert entry.entry(spark).count() > 0
