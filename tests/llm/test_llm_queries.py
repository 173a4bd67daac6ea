"""Queries of the subpackage run over the smallest tables; those with SQL agree with it."""

from __future__ import annotations

import os

import duckdb
import pytest

from citeloom.llm.queries import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the test tables are not here")


@pytest.mark.parametrize("name", sorted(registry.queries))
def test_query(spark, name):
    df = registry.queries[name](spark, DATA)
    rows = sorted(tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect())
    if name in registry.sql:
        con = duckdb.connect()
        for table in ("source_rank_items", "qwen_sources"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
        other = con.sql(registry.sql[name])
        at = sorted(range(len(other.columns)), key=lambda i: other.columns[i])
        assert rows == sorted(tuple(str(r[i]) for i in at) for r in other.fetchall())
    if name.endswith("_found"):
        assert len(rows) == len(set(rows))


COLUMNS = {
    "p1_found": ["answer_id"], "p2_found": ["first_row_id", "copy_row_id"], "p3_found": ["scope", "domain", "source_key"], "p4_found": ["turn_id", "defect_type"], "p5_found": ["turn_id"], "p7_ids": ["doc_id", "ids"], "p9_found": ["doc_id", "line_no", "pii_type"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    assert registry.queries[name](spark, DATA).columns == COLUMNS[name]
