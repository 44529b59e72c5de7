"""Every registered query against its SQL on DuckDB, at the smallest scale."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry
from tools.check_queries import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in SQL:
        assert columns
        return
    cur = duck.execute(SQL[name])
    want_columns, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert columns == want_columns
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
