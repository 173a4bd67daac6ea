"""Chances of problem 8 where some documents are certain."""

from __future__ import annotations

import pytest

from citeloom.llm import mixing


@pytest.mark.parametrize(("rest", "rate"), [(30, 0.3 / 0.75), (90, (90 - 50) / 25), (100, 2.0), (10, 10 / 75)])
def test_what_certain_documents_free_is_spread(spark, rest, rate):
    # Fifty tokens of single texts, fifty of texts that stand twice.
    sized = spark.createDataFrame([(i, "s", 10, 1.0) for i in range(5)] + [(10 + i, "s", 5, 0.5) for i in range(10)], "doc_id bigint, source string, n_tokens bigint, weight double")
    needs = spark.createDataFrame([("p", "s", rest), ("p", "t", 5), ("q", "s", 0)], "plan_id string, source string, rest bigint")
    got = {(r.plan_id, r.source): r.per_weight for r in mixing.draw_rates(sized, needs).collect()}
    assert set(got) == {("p", "s")} and got["p", "s"] == pytest.approx(rate)
    expected = sum(n * min(1.0, got["p", "s"] * w) for n, w in [(10, 1.0)] * 5 + [(5, 0.5)] * 10)
    assert expected == pytest.approx(rest)


def test_shares_reached_over_many_seeds(spark):
    sized = spark.createDataFrame([(i, "s", 10, 1.0) for i in range(20)] + [(100 + i, "s", 10, 0.25) for i in range(80)], "doc_id bigint, source string, n_tokens bigint, weight double").cache()
    targets = spark.createDataFrame([("p", "s", 1.0, 1)], "plan_id string, source string, target_share double, max_repeats int")
    needs = mixing.source_needs(sized, targets, 500)
    drawn = [[r.doc_id for r in mixing.mix(sized, needs, seed).collect()] for seed in range(12)]
    assert all(480 <= 10 * len(d) <= 500 for d in drawn)
    # Single texts are certain (rate 1.5), so the other half comes of the repeated ones.
    assert sum(i < 100 for d in drawn for i in d) >= 0.95 * 12 * 20
