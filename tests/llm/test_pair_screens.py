"""Screens of problem 4 spare no text that its patterns or languages would tell."""

from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from citeloom.llm import pairs
from citeloom.llm.language import language


@pytest.mark.parametrize(("name", "pattern"), [(n, p) for n in ("REFUSING", "COURTESY") for p in getattr(pairs, n)])
def test_hints_stand_wherever_a_pattern_finds(name, pattern):
    @settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.from_regex(re.compile(pattern, re.I)))
    def check(text):
        assert any(h in text.lower().translate(pairs._CASES) for h in pairs.HINTS[name])

    check()


def test_a_refusal_by_its_own_words():
    x, _, _ = pairs.clause_features("Welcher Tee ist gut?", "Dazu können wir keine Auskunft geben.", False)
    assert x[0, pairs.FEATURES.index("refusing")] == 1


def test_foreign_clauses_in_an_answer_called_chinese():
    foreign = "Staff suggest halving the first serving before going on with it."
    answer = f"{foreign}{'这款茶的保质期是十二个月开封后要放在阴凉处。' * 4}"
    assert language(answer) == "zh"
    x, size, parts = pairs.clause_features("云记的茶靠谱吗？", answer + foreign, False)
    assert [bool(v) for v in x[:, pairs.FEATURES.index("foreign")]] == [language(p) != "zh" for p in parts] and x[:, pairs.FEATURES.index("foreign")].any()
