"""Every query with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import datetime
import decimal
import os

import duckdb
import pytest

from tidemark.plans import queries, shop_queries  # noqa: F401

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in os.listdir(SF):
        c.execute(f"create view {t.removesuffix('.parquet')} as select * from read_parquet('{SF}/{t}')")
    return c


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


def rows(names, found):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=str)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    cursor = duck.execute(queries.SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, cursor.fetchall())


def test_all_queries_have_sql():
    assert set(queries.QUERIES) == set(queries.SQL)
