"""Bounds of problem 3: right with any of them left out, few scores or few items per partition."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from citeloom.llm import topn
from tests.llm.test_text_forms import ITEMS, best


@pytest.mark.parametrize("kept", [0, 1, 100_000])
@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("gh"), st.integers(1, 30), st.sampled_from([None, 1, 2]), st.sampled_from("ABCDEFGHIJKLM")), max_size=120), st.integers(1, 3))
def test_few_items_with_many_scores(spark, kept, drawn, parts):
    rows = [(g, "x", s, o, k, "a", "b", "c", "d") for g, s, o, k in drawn]
    before, topn.BROADCAST_ROWS = topn.BROADCAST_ROWS, kept
    try:
        got = sorted((r.g, r.h, r.item) for r in topn.top_n(spark.createDataFrame(rows, ITEMS).repartition(parts), ["g", "h"], "s", "o", "k", 10).collect())
    finally:
        topn.BROADCAST_ROWS = before
    assert got == best(rows, 10)


def test_bounds_filter_before_anything_is_shuffled(spark):
    rows = [("g", "x", i % 5000, 1, str(i), "a", "b", "c", "d") for i in range(20_000)]
    df = spark.createDataFrame(rows, ITEMS).repartition(3)
    plan = topn.top_n(df, ["g", "h"], "s", "o", "k", 10)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert {(r.g0, r.g1) for r in topn.local_bounds(df.selectExpr("g AS g0", "h AS g1", "s AS score", "o AS ord", "k AS item"), ["g0", "g1"], 10).collect()} == {("g", "x")}
