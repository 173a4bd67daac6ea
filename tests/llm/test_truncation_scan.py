"""The vectorised scan of problem 1 against plain versions."""

from __future__ import annotations

import html
import json
import random

import numpy as np
import pytest

from citeloom.llm import bloom, truncation

TEXTS = ["", "茶\r\n很\n好&<b>\"'\\\t😀�", "\n", "\r", "a" * 5000 + " 茶 end", "1. 甲\n- 乙 12.5", "é́ß"]


def test_lengths_under_each_encoding():
    got = dict(zip(truncation.MEASURES, truncation.lengths_of(TEXTS).T, strict=True))
    whole = [t.rstrip("�") for t in TEXTS]
    assert list(got["characters"]) == list(map(len, whole))
    assert list(got["utf16"]) == [len(t.encode("utf-16-le")) // 2 for t in whole]
    assert list(got["utf8"]) == [len(t.encode()) for t in whole]
    escaped = [html.escape(t).replace("&#x27;", "&quot;") for t in whole]
    assert list(got["html"]) == [len(t) for t in escaped] and list(got["html_utf8"]) == [len(t.encode()) for t in escaped]
    assert list(got["json"]) == [len(json.dumps(t, ensure_ascii=False)) - 2 for t in whole]
    assert list(got["crlf"]) == [len(t.replace("\r\n", "\n").replace("\n", "\r\n")) for t in whole]


@pytest.mark.parametrize("filling", ["长", "word ", "w", "1", "- ", " "])
def test_the_end_of_a_long_text_counts_as_in_the_corpus(filling):
    for n in (0, 5, 60, 70, 1000, 50_000):
        text = filling * n + "and so the price of it stays at 12"
        tokens = truncation._Tokens([text])
        whole = [int(g[-1:].view(np.int64)[0]) for g in tokens.grams()]
        grams, counts = truncation._tails([text])
        assert list(grams[0]) == whole and (counts[0] == len(tokens.exact) if len(tokens.exact) <= truncation.LONGEST else counts[0] > truncation.LONGEST)


def test_pieces_of_long_texts_give_the_same_counts(monkeypatch):
    rng = random.Random(2)
    text = "\n".join(" ".join(rng.choice(["tea", "Tea.", "3.5", "好", "。", "- x"]) for _ in range(rng.randint(0, 9))) for _ in range(400))
    def counts():
        out = {}
        for part in truncation._parts([text, None, " ", "x"]):
            tokens = truncation._Tokens(part)
            for level, gram in enumerate(tokens.grams()):
                for g, e in zip(gram, tokens.ends, strict=True):
                    n, k = out.get((level, g), (0, 0))
                    out[level, g] = n + 1, k + int(e)
        return out

    whole = counts()
    monkeypatch.setattr(truncation, "PART_CHARS", 100)
    pieces = counts()
    line = {(level, g) for level, g in pieces if pieces[level, g] != whole.get((level, g))}
    # A piece starts with a line of its own, as the line it cuts off did; nothing else may differ.
    assert len(line) <= len(truncation.PHRASES)


def test_filter_passes_every_key(spark):
    keys = bloom.mixed(np.arange(5000, dtype=np.uint64) + np.uint64(7)).view(np.int64)
    df = spark.createDataFrame([(int(k),) for k in keys], "k bigint")
    for most in (0, 100, 10**6):
        words = bloom.filter_of(df, "k", most)
        assert bloom.may_hold(words, keys.view(np.uint64)).all() and len(words) * 64 <= max(64, 2 * bloom.BITS_PER_KEY * min(most, 5000))
    other = bloom.mixed(np.arange(100_000, dtype=np.uint64) + np.uint64(10**6))
    assert bloom.may_hold(words, other).mean() < 0.03
    assert not bloom.may_hold(bloom.filter_of(df.limit(0), "k", 10), other).any()


def test_a_limit_of_few_characters(spark):
    rng = random.Random(3)
    rows = [(str(i), "".join(rng.choice("甲乙丙丁戊己庚辛") for _ in range(16))) for i in range(40)] + [(f"s{i}", "好" * i + "。") for i in range(1, 9)]
    found = truncation.hidden_limits(spark.createDataFrame([(i, t, "a") for i, t in rows], "i string, text string, store string"), ["store"]).collect()
    assert {(r.store, r.limit_length) for r in found if r.measure == "characters"} == {("a", 16)}
    tiny = spark.createDataFrame([(str(i), t, "a") for i, t in enumerate(["可以", "不行", "很好", "一般", "没有", "还行"])], "i string, text string, store string")
    assert truncation.hidden_limits(tiny, ["store"]).count() == 0
