"""Every registered query against its SQL over the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_module

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the test tables are not here")


@pytest.fixture(scope="module")
def views():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(rows, columns, get):
    return sorted(tuple(repr(round(v, 9) if isinstance(v := get(r, c), float) else v) for c in columns) for r in rows)


@pytest.mark.parametrize("name", sorted(n for n in entry_module.queries() if not n[1:2].isdigit() or n.startswith("p6_")))
def test_query_agrees_with_its_sql(spark, views, name):
    df = entry_module.queries()[name](spark, DATA)
    rows, columns = df.collect(), sorted(df.columns)
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    other = views.sql(sql)
    assert sorted(other.columns) == columns
    at = {c: i for i, c in enumerate(other.columns)}
    assert plain(rows, columns, lambda r, c: r[c]) == plain(other.fetchall(), columns, lambda r, c: r[at[c]])


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
