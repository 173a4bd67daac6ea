"""Hashing in parts, and groups that are compared before they are counted."""

from __future__ import annotations

import random

import numpy as np
import pytest

from citeloom.llm import copies
from tests.llm.test_text_forms import sources


def test_parts_do_not_change_hashes(monkeypatch):
    rng = random.Random(1)
    texts = [rng.choice([None, "", "A b|c" * rng.randint(0, 40), "x" * rng.randint(0, 300)]) for _ in range(200)]
    whole = copies.form_hash(texts, copies.TITLE_SEPARATORS, 0, [k % 3 for k in range(200)])
    monkeypatch.setattr(copies, "PART_CHARS", 100)
    assert (copies.form_hash(texts, copies.TITLE_SEPARATORS, 0, [k % 3 for k in range(200)]) == whole).all()


def test_a_collision_stops_both_results(spark):
    same = lambda titles, seed=0: np.zeros(len(titles), dtype=np.int64)
    before, copies.title_hash = copies.title_hash, same
    try:
        df = sources(spark, [(1, ("a", "u")), (2, ("b", "u"))])
        groups = spark.createDataFrame([(0, 0, (1, "a", "u"), 2)], "_title_key bigint, _url_key bigint, first struct<id:bigint,title:string,url:string>, row_count bigint")
        keyed = lambda slim, title, url, seed: slim.selectExpr("*", "0L AS _title_key", "0L AS _url_key")
        real, copies.with_form_keys = copies.with_form_keys, keyed
        with pytest.raises(Exception, match="share a hash under seed 0"):
            copies._verified(copies._slim(df, "source_row_id", "title", "url"), groups, 0).collect()
        copies.with_form_keys = real
    finally:
        copies.title_hash = before
