"""Every query that SQL can express, against DuckDB on the smallest tables."""

import glob
import os

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def sql(tables):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{tables}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    clean = lambda v: round(float(v), 9) if isinstance(v, float) else v
    return sorted(tuple(str(clean(r[i])) for i in order) for r in values)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, tables, sql, name):
    got = entry.queries()[name](spark, tables)
    want = sql.execute(entry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(names, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
