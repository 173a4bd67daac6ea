from __future__ import annotations

import re
import unicodedata
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

import pytest
from pyspark.sql import functions as F

from citeloom import constants as C
from citeloom.functions import ids, text, urls


def values(spark, rows, column, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, c {kind}")
    return [r.v for r in df.select("i", column(F.col("c")).alias("v")).orderBy("i").collect()]


def test_normalize(spark):
    rows = ["ＡＢＣ　 鸿   茅 药 酒 ", None, "", " \t\n ", "Ångström…", "①ﬁ"]
    want = [" ".join(unicodedata.normalize("NFKC", r or "").lower().split()) for r in rows]
    assert values(spark, rows, text.normalize) == want
    assert want[0] == "abc 鸿 茅 药 酒"


def test_strip_takes_all_unicode_space(spark):
    rows = ["　a　", " x\x1f", None, "\u2028", "b\u200b"]
    assert values(spark, rows, text.strip) == [None if r is None else r.strip() for r in rows]


@pytest.mark.parametrize(
    ("answer", "aliases", "count"),
    [("鸿 茅 药 酒", ["鸿茅药酒"], 1), ("HONGMAO and hongmao", ["HongMao"], 2), ("鸿茅药酒", ["鸿茅", "鸿茅药酒"], 2), ("a.b", ["a.b"], 1), ("axb", ["a.b"], 0), ("x", [" "], 0), (None, ["x"], 0)],
)
def test_mentions(spark, answer, aliases, count):
    assert values(spark, [answer], lambda c: text.mention_count(text.normalize(c), aliases)) == [count]


def test_notices(spark):
    refusal = C.REFUSAL_SENTENCES[0]
    assert values(spark, [refusal, f" {refusal}\n", f"前言。{refusal}", None], text.is_refusal) == [True, True, False, False]
    busy = "当前访问人数过多，疯狂加服务器中，请稍后再试"
    assert values(spark, [busy, busy + "好" * 120, "请稍后再试", None, ""], text.is_busy) == [True, False, False, False, False]
    quota = ["抱歉，今日次数已用完，请稍后再试。", "今日次数已用完", "今日次数已用完，" + "长" * 300, "他说今日次数已用完", None, ""]
    assert values(spark, quota, text.is_quota_exhausted) == [True, True, False, False, False, False]
    assert values(spark, ["请拖动下方滑块完成验证", "好", None], text.shows_risk_control) == [True, False, False]


def rule_oracle(t, rules, markers):
    out = []
    for rule, terms in rules:
        for term in terms:
            for m in re.finditer(re.escape(term), t):
                if not any(k in t[max(0, m.start() - 14) : m.start()] for k in markers):
                    out.append((rule, term, m.start() + 1, t[max(0, m.start() - 18) : m.end() + 18].strip()))
    return out


def test_rules_match_a_plain_search(spark):
    rows = ["存在虚假宣传问题，被处罚两次。后来又被处罚", "没有证据表明存在虚假宣传", "", "停售", "未被处罚", "x" * 40 + "行政处罚" + "y" * 40]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    found = df.select("i", F.inline(text.rule_hits(F.col("t"), C.NEGATIVE_RULES, C.NEGATION_MARKERS))).collect()
    for i, t in enumerate(rows):
        assert [(r.rule, r.term, r.start, r.evidence) for r in found if r.i == i] == rule_oracle(t, C.NEGATIVE_RULES, C.NEGATION_MARKERS)
    assert any(r.i == 4 for r in found)  # the marker 未被 is never wholly before the hit


def test_cards_are_peeled_from_quick_answers_only():
    body = "正文第一行\n正文第二行。"
    cards = "\n00:30\n一个卡片标题\ncreator_1\n另一个标题\n用户日记"
    assert text.strip_cards(body + cards, "quick") == body
    assert text.strip_cards(body + cards, "research") == body + cards
    assert text.strip_cards(None, "quick") == "" and text.strip_cards("  a  ", "quick") == "a"
    assert text.strip_cards("标题\n作者甲", "quick") == ""


def canonical_oracle(url):
    raw = url.strip()
    if not raw:
        return ""
    p = urlsplit(raw)
    host = (p.hostname or "").lower()
    if not host:
        return raw
    try:
        port = p.port
    except ValueError:
        return raw
    usual = {("http", 80), ("https", 443)}
    place = host if port is None or (p.scheme.lower(), port) in usual else f"{host}:{port}"
    kept = sorted((k, v) for k, v in parse_qsl(p.query, keep_blank_values=True) if k.strip().lower() not in C.TRACKING_KEYS and not k.strip().lower().startswith("utm_"))
    return urlunsplit((p.scheme.lower(), place, p.path or "/", urlencode(kept), ""))


URLS = [
    "HTTPS://WWW.Example.COM", "http://a.test:80/x?b=2&a=1#f", "https://a.test:443/", "http://a.test:8080/p", "https://u:p@a.test/", "https://a.test/?utm_source=x&UTM_Campaign=y&spm=1&k=v", "https://a.test/?a", "https://a.test/?a=&b=c%20d+e",
    "https://a.test/?q=%E4%BD%A0~*", "", "  ", "not a url", "/relative?x=1", "https://a.test?x=1", "https://a.test:99999/", "https://a.test:abc/", "https://[::1]:8080/a", "//host.test/p", "https://a.test/?a=1&a=1&&b", "https://a.test/p?x=中文",
    "https://a.test/p?x=a=b", "ftp://a.test/x y",
]


def test_canonical_url_matches_urllib(spark):
    assert values(spark, [*URLS, None], urls.canonical_url) == [*map(canonical_oracle, URLS), None]


def test_domains(spark):
    rows = ["https://www.A.test/x", "http://u@b.test:8/", "x", "", None, "https://www.www.c.test"]
    assert values(spark, rows, urls.domain) == ["a.test", "b.test", "", "", None, "www.c.test"]
    assert values(spark, rows, urls.site_name) == ["a.test", "b.test", None, None, None, "www.c.test"]


def test_ids_reject_nulls(spark):
    df = spark.createDataFrame([("b", "q", "quick"), ("b", None, "quick")], "b string, q string, m string")
    column = ids.task_id(F.lit("p"), F.col("b"), F.col("q"), F.col("m")).alias("v")
    one = df.where("q IS NOT NULL").select(column).first().v
    assert one.startswith("p_task_") and len(one) == 23
    made = df.select(column)
    with pytest.raises(Exception, match="question_id must not be null"):
        made.collect()


def test_queries_are_unquoted_and_distinct(spark):
    rows = [["“甲”", "甲", " b ", "''"], [], None]
    assert values(spark, rows, text.distinct_queries, "array<string>") == [["甲", "b"], [], None]


def test_ratio(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (None, 3), (1, None)], "a int, b int")
    assert [r.v for r in df.select(text.ratio(F.col("a"), F.col("b")).alias("v")).collect()] == [0.5, 0.0, 0.0, 0.0]


CARDED = ["正文。\n00:30\n标题一\n甲_1\n标题二\n乙", "x\r\n标题 三\r\nabc", "00:10\n00:20\nab", "一 两个 三字母", " 只有\n一行 \n", "标题\n甲乙\n" * 3000, "序\n" * 2999 + "标题\n甲乙", None, "", "长" * 121 + "\n甲乙", "正文\n\n\n标题\n甲乙\n"]


def test_cards_by_column_and_on_the_driver(spark):
    for mode in ("quick", "research", None):
        want = [text.strip_cards(t, mode) for t in CARDED]
        assert values(spark, CARDED, lambda c: text.clean_answer(c, F.lit(mode).cast("string"))) == want  # noqa: B023
    assert [text.strip_cards(t, "quick") for t in CARDED[:6]] == ["正文。\n00:30\n标题一\n甲_1\n标题二\n乙", "x", "00:10\n00:20\nab", "一", "", ""]
