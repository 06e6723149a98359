"""The registered queries against their SQL at the smallest scale; check.py runs all of them."""

import re

import duckdb
import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries

# the corpus queries have tests of their own
NAMES = [n for n in oracle_sql() if not re.match(r"op\d|pipeline", n)]


@pytest.fixture(scope="module")
def db(sf):
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf, db, name):
    df = queries()[name](spark, sf)
    got = check.rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = db.execute(oracle_sql()[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == check.rows_of(columns, res.fetchall())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["currency", "year", "month", "total", "n"] and df.count() > 0


def test_oracles_name_queries():
    assert set(oracle_sql()) <= set(queries())
