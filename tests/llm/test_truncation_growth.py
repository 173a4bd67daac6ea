"""Problem 1 on corpora in which the same cut ending comes back, as it does the more often the larger they are."""

from __future__ import annotations

import numpy as np
import pytest

from citeloom.llm import truncation

NAMES = [a + b for a in ("Tam", "Kest", "Brev", "Quin", "Nor", "Lum", "Vel", "Zan") for b in ("vita", "dane", "lora", "bria", "wick")]
PLACES = ["Lower Fennick", "Port Selwick", "North Quell", "Talbury", "Greymarsh"]


def _whole(i: int) -> str:
    name, place = NAMES[i % len(NAMES)], PLACES[i % len(PLACES)]
    return f"{name} lists oat fibre {i} and hawthorn as its main ingredients. Several stores in {place} offered samples of {name} last season.\n- keep the receipt from {name}\n- compare prices in {place}."


def _found(spark, texts):
    rows = spark.createDataFrame([(f"{i:04}", t) for i, t in enumerate(texts)], "row_id string, text string")
    return {int(r.row_id) for r in truncation.find_truncated(rows, "row_id", "text").collect()}


@pytest.mark.parametrize("ending", ["as its main ingredi", "as its main ingredients. Several stor", "as its main ingredi…", "as its main ingredients. Several stor..."])
def test_the_same_half_word_at_many_ends_is_no_word(spark, ending):
    whole = [_whole(i) for i in range(80)]
    cut = [f"{whole[i]}\n{NAMES[i % len(NAMES)]} lists oat fibre {i} and hawthorn {ending}" for i in range(30)]
    assert _found(spark, whole + cut) == set(range(80, 110))


def test_copies_with_another_first_line_do_not_vouch_for_their_cut(spark):
    whole = [_whole(i) for i in range(80)]
    cut = [f"Copy {i}\nThe panel of Talbury found that {NAMES[0]} was described as rather mild by most of the people who" for i in range(6)]
    more = [f"The people who buy {n} keep it cool, and the people who return it ask the panel." for n in NAMES]
    assert _found(spark, whole + more + cut) == set(range(120, 126))


def test_a_sign_off_at_many_ends_is_whole(spark):
    whole = [_whole(i) for i in range(80)]
    closed = [f"{_whole(i)}\n{sign}" for i in range(100, 112) for sign in ("-- end of the overview", "——以上内容整理自公开网页")]
    assert _found(spark, whole + closed) == set()


def test_only_the_last_token_of_a_text_is_apart():
    texts = ["one two\nthree", "甲乙…", "five 12.", "since it ends.", "a", "…"]
    tokens = truncation._Tokens(texts)
    places = tokens.lasts([len(t) - len(t[: truncation._end(t)].rstrip()) for t in texts])
    alone = truncation._Tokens(["three", "乙", "12", ".", "a"])
    assert list(tokens.exact[places[:5]]) == list(alone.exact[np.flatnonzero(~alone.line)]) and tokens.line[places[5]]
    assert list(tokens.text[places]) == list(range(6))


def test_pieces_of_a_long_text_end_at_its_own_end_only(spark, monkeypatch):
    whole = [_whole(i) for i in range(80)]
    cut = [f"Part {i}\n" + "\n".join(_whole(j) for j in range(i, i + 5)) + f"\n{NAMES[i]} lists oat fibre {i} and hawthorn as its main ingredi" for i in range(6)]
    expected = _found(spark, whole + cut)
    pieces = [truncation._Tokens(list(truncation._pieces(t))) for t in cut]
    monkeypatch.setattr(truncation, "PART_CHARS", 60)
    for t, tokens in zip(cut, pieces, strict=True):
        parts = list(truncation._pieces(t))
        assert "".join(parts) == t and [p[-1] == "\n" for p in parts] == [True] * (len(parts) - 1) + [False]
        assert len(parts) > 5 and not tokens.line[-1]
    assert expected == set(range(80, 86))
