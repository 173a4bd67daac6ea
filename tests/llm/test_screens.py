"""What a screen spares a text, its pattern would not have found there."""

from __future__ import annotations

import os

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from citeloom.llm import pii


@pytest.mark.parametrize(
    ("text", "kind"),
    [("寄到文三路二十号", "address"), ("收件人王明，", "name"), ("收货人王明，", "name"), ("寄件人王明，", "name"), ("抄送人王明，", "name"), ("Grüner Weg 12", "address"), ("电话 12345 ---- 6789", "phone")],
)
def test_forms_that_were_screened_off(text, kind):
    assert [k for k, _, _ in pii.find_pii(text)] == [kind]


@pytest.mark.parametrize("at", range(len(pii._patterns())))
def test_screens_of_pii_pass_what_the_patterns_find(at):
    kind, pattern = pii._patterns()[at]

    @settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.from_regex(pattern))
    def check(text):
        for m in pattern.finditer(text):
            if kind != "phone" or 9 <= sum(c.isdigit() for c in m[m.lastindex if m.lastindex and len(m[m.lastindex]) > 1 else 0]) <= 18:
                assert (kind, pattern) in pii._screened(text)

    check()


DATA = "/root/testdata/sf0.01/documents.parquet"


@pytest.mark.skipif(not os.path.exists(DATA), reason="the test tables are not here")
def test_screened_and_unscreened_findings_agree(monkeypatch):
    texts = [t for t in pd.read_parquet(DATA).text if t]
    screened = [pii.find_pii(t) for t in texts]
    monkeypatch.setattr(pii, "_screened", lambda text: pii._patterns())
    monkeypatch.setattr(pii, "times_in", lambda words, text: 7)
    assert [pii.find_pii(t) for t in texts] == screened


def test_chinese_numerals_are_house_numbers():
    assert [k for k, _, _ in pii.find_pii("寄到湖州市人民路八十八号，谢谢。")] == ["address"]
