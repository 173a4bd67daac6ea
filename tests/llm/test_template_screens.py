"""Problem 5: screens spare no text that the patterns find something in; what alignment decides."""

from __future__ import annotations

import os
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from citeloom.llm import templates
from citeloom.llm.screens import hints_in
from tests.llm.test_text_defects import qa

DATA = "/root/testdata/sf0.01/qwen_answers.parquet"


@pytest.mark.parametrize(("name", "pattern"), [(n, p) for n in templates.HINTS for p in getattr(templates, n)])
def test_hints_stand_wherever_a_pattern_finds(name, pattern):
    @settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.from_regex(re.compile(pattern, re.I | re.M)))
    def check(text):
        assert name in hints_in(templates.HINTS, text)

    check()


@pytest.mark.parametrize("pattern", templates.PLACEHOLDERS)
def test_marks_stand_wherever_a_placeholder_does(pattern):
    if pattern == r"_{4,}":
        assert templates._MARKS.search("____")
        return

    @settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.from_regex(re.compile(pattern, re.M)))
    def check(text):
        assert templates._MARKS.search(text)

    check()


@pytest.mark.skipif(not os.path.exists(DATA), reason="the test tables are not here")
def test_screened_and_unscreened_findings_agree():
    rows = pd.read_parquet(DATA)
    for q, a in zip(rows.question, rows.answer, strict=True):
        assert templates.residue(q, a) == templates.residue(q, a, screen=False)


def test_window_hashes_know_their_window():
    a, b = templates.window_hashes("abcdefgh"), templates.window_hashes("xxabcdefgh")
    assert (a == b[2:]).all() and len(np.unique(b)) == 5 and len(templates.window_hashes("abc")) == 0


def found(spark, rows):
    return {r.row_id for r in templates.template_residue(qa(spark, rows)).collect()}


def test_slots_decide_on_placeholders(spark):
    lone = [("a", "q", "Posted under #teatime# by a friend of ours.")]
    assert found(spark, lone) == set()
    assert found(spark, [*lone, ("b", "q", "Posted under nothing by a friend of ours.")]) == {"a"}
    numbers = [("n", "q", "{{city}} 2016年的一份报告。"), ("m", "q", "甲市 2019年的一份报告。")]
    assert found(spark, numbers) == {"n"}


def test_templates_decide_on_notices(spark):
    page = "网页加载失败，请联系管理员，编号 %d。" + "这里是本站的页脚，版权归本站所有，转载请注明出处，谢谢您的访问与支持。" * 3
    assert found(spark, [(f"p{i}", "哪个好？", page.split("。")[0] % i) for i in range(2)]) == set()
    assert found(spark, [(f"p{i}", "哪个好？", page.split("。")[0] % i) for i in range(3)]) == {"p0", "p1", "p2"}
    prose = "店员说网站曾经显示访问异常，后来又好了，这款茶的保质期是十二个月，开封后要放在阴凉处，也有人更看重价格。第二天去店里问过，说是系统的缘故。店里的价格比网上低一些，可以试喝，也可以退换，买两盒还会送一个茶杯，颜色任选。"
    assert found(spark, [("x", "哪个好？", prose)]) == set()


def test_explanations_stay_where_the_question_asks(spark):
    notice = [(f"n{i}", "哪个好？", "登录状态已失效，请重新登录后查看") for i in range(3)]
    told = [("t", "为什么要重新登录？", "登录状态已失效时会这样提示。重新登录以后就能看到报告，与商品无关。"), ("u", "为什么要重新登录？", "茶很好。\n登录状态已失效，请重新登录后查看")]
    assert found(spark, notice + told) == {"n0", "n1", "n2", "u"}
