"""Queries that once read a part of their tables, over all of them."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry_module

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the test tables are not here")


@pytest.mark.parametrize(("name", "key", "table"), [("rule_evidence", "mode", "qwen_answers"), ("metrics_sources", "wave_id", "source_occurrences")])
def test_every_mode_and_wave(spark, name, key, table):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    got = entry_module.queries()[name](spark, DATA).collect()
    rows = con.sql(entry_module.oracle_sql()[name])
    want = [dict(zip(rows.columns, r, strict=True)) for r in rows.fetchall()]
    plain = lambda rows: sorted(repr(sorted((k, round(v, 9) if isinstance(v, float) else v) for k, v in r.items())) for r in rows)
    assert plain(r.asDict() for r in got) == plain(want)
    assert {r[key] for r in got} == {k for (k,) in con.sql(f"SELECT DISTINCT {key} FROM {table} WHERE {key} IS NOT NULL").fetchall()}
