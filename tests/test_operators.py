from __future__ import annotations

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from citeloom import constants as C
from citeloom.operators import citations, hosts, mention, metrics, package, runs, sentiment

ITEM = "question_id string, mode string, status string, answer string, item_pos bigint, sources array<struct<rank:int,title:string,url:string>>"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


# --- citations ------------------------------------------------------------------------------------


def occ(spark, rows):
    return spark.createDataFrame(rows, "question_id string, mode string, source_key string, domain string, title string, url string, rank int, item_pos bigint, source_pos int")


def test_occurrences_follow_answers(spark):
    items = spark.createDataFrame(
        [("q", "quick", "pass", "好", 0, [(1, " T ", " HTTPS://A.test/x?utm_source=1 "), (2, None, " "), (3, "x", "https://www.b.test")]), ("q", "research", "fail", "好", 1, [(1, "t", "https://c.test")]), ("r", "quick", "pass", " ", 2, [(1, "t", "https://c.test")])], ITEM
    )
    got = [(r.source_key, r.domain, r.title, r.rank, r.source_pos) for r in citations.occurrences(items).orderBy("source_pos").collect()]
    assert got == [("https://a.test/x", "a.test", "T", 1, 0), ("https://www.b.test/", "b.test", "x", 3, 2)]


def test_dedup_keeps_the_first_and_scopes_count(spark):
    rows = [("q1", "quick", "k", "d", "first", "u", 3, 0, 0), ("q1", "quick", "k", "d", "second", "u", 1, 0, 1), ("q1", "research", "k", "d", "third", "u", 2, 1, 0), ("q2", "quick", "j", None, None, None, None, 2, 0)]
    one = citations.dedup(occ(spark, rows))
    assert one.count() == 3 and one.where("source_key = 'k' AND mode = 'quick'").first().title == "first"
    ranks = {(r.scope, r.source_key): r for r in citations.source_ranks(one).collect()}
    assert (ranks["all", "k"].occurrence_count, ranks["all", "k"].question_count, ranks["all", "k"].first_seen_order) == (2, 1, 1)
    assert ranks["all", "k"].average_order == 2.5 and ranks["all", "j"].average_order is None
    assert ranks["quick", "j"].first_seen_order == 2 and ranks["all", "k"].share == pytest.approx(2 / 3)
    host = {(r.scope, r.host): r for r in citations.host_ranks(one).collect()}
    assert set(host) == {("quick", "d"), ("research", "d"), ("all", "d")} and host["all", "d"].share == pytest.approx(2 / 3)


def test_top_is_ten_and_scopes_without_rows_are_zero(spark):
    rows = [(f"q{i}", "quick", f"k{i:02d}", "d", "t", "u", 1, i, 0) for i in range(12)]
    ranks = citations.source_ranks(citations.dedup(occ(spark, rows)))
    got = {r.scope: r for r in citations.concentration(ranks, citations.source_order()).collect()}
    assert (got["quick"].unique_keys, got["quick"].top_occurrences, got["quick"].outside_top) == (12, 10, 2)
    assert (got["research"].total_occurrences, got["research"].top_share) == (0, 0.0)
    assert citations.top(ranks, citations.source_order()).where("scope = 'all'").count() == 10


def test_first_seen_order_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(citations, "BLOCK", 3)
    rng = random.Random(1)
    rows = [(f"q{i // 2}", ("quick", "research")[i % 2], f"k{rng.randrange(12)}", "d", "t", "u", 1, i, j) for i in range(20) for j in range(rng.randrange(4))]
    one = sorted(tuple(r) for r in citations.dedup(occ(spark, rows)).collect())
    for scope in C.SCOPES:
        seen = sorted((r for r in one if scope in ("all", r[1])), key=lambda r: (r[7], r[8], r[2]))
        want: dict = {}
        for n, r in enumerate(seen, 1):
            want.setdefault(r[2], n)
        got = {r.source_key: r.first_seen_order for r in citations.source_ranks(citations.dedup(occ(spark, rows))).where(F.col("scope") == scope).collect()}
        assert got == want


def test_citations_of_an_empty_table(spark):
    none = occ(spark, [])
    assert citations.source_ranks(citations.dedup(none)).count() == 0 and citations.host_ranks(none).count() == 0


def test_cards_and_links(spark):
    cards = spark.createDataFrame(
        [("a", "r1", "2", "t1", "u1", 0), ("a", "r1", "x", "t2", "u2", 1), ("a", "r2", "1", "t", "u3", 2), ("a", "r1", "1", "dup", "u1", 3), ("a", "r1", None, " ", "u4", 4)],
        "answer string, req_id string, refer_num string, title string, url string, card_pos int",
    )
    got = citations.quick_cards(cards, F.lit("r1")).orderBy("source_pos").collect()
    assert [(r.rank, r.title) for r in got] == [(2, "t1"), (2, "t2")]
    links = spark.createDataFrame([("a", "https://x", "", 0), ("a", "https://x", "named", 1), ("a", " ", "t", 2), ("a", "https://y", "t", 3)], "answer string, href string, title string, link_pos int")
    assert rows_of(citations.research_links(links)) == [("a", 1, "named", "https://x"), ("a", 2, "t", "https://y")]


# --- hosts (problem 6) ------------------------------------------------------------------------------

SO = "wave_id string, question_id string, mode string, source_key string, domain string, extra int"
HR = "wave_id string, scope string, host string, occurrence_count bigint, question_count bigint"


def test_host_counts_match_brute_force(spark):
    rng = random.Random(3)
    rows = [
        (f"w{rng.randrange(2)}", rng.choice(["q1", "q2", "q3", None]), rng.choice(["quick", "research", "other", None]), f"k{rng.randrange(6)}", rng.choice(["hot"] * 6 + ["a", "b", "", None]), 1) for _ in range(600)
    ]
    want = {}
    for w, q, m, k, d, _ in set(rows):
        if d and m in ("quick", "research"):
            for scope in (m, "all"):
                n, qs = want.setdefault((w, scope, d), (set(), set()))
                n.add((q, m, k))
                qs.add(q)
    got = {(r.wave_id, r.scope, r.host): (r.occurrence_count, r.question_count) for r in hosts.host_counts(spark.createDataFrame(rows, SO)).collect()}
    assert got == {k: (len(n), len(qs - {None})) for k, (n, qs) in want.items()}


def test_host_disagreements(spark):
    rows = [("w", "q", "quick", "k", "a", 0), ("w", "q", "quick", "k", "b", 0), ("w", "q", "quick", "k", "c", 0), ("w", "q", "quick", "k", "c", 0)]
    reported = [("w", "quick", "a", 1, 1), ("w", "quick", "a", 1, 1), ("w", "all", "a", 1, None), ("w", "quick", "b", 2, 1), ("w", "all", "b", 1, 1), ("w", "quick", "c", 1, 1), ("w", "quick", "gone", 0, 0), ("w", "quick", "", 9, 9), ("w", "quick", None, 9, 9)]
    got = rows_of(hosts.host_disagreements(spark.createDataFrame(rows, SO), spark.createDataFrame(reported, HR)))
    assert got == [("w", "all", "a"), ("w", "all", "c"), ("w", "quick", "b"), ("w", "quick", "gone")]
    assert hosts.host_disagreements(spark.createDataFrame([], SO), spark.createDataFrame([], HR)).count() == 0


def test_weighted_summary(spark):
    rows = [("a", 1), ("a", 1), ("a", 3), ("a", None), ("b", None), ("c", 5), ("c", 2)]
    weighted = hosts.weighted_values(spark.createDataFrame(rows, "k string, v int"), ["k"], "v")
    got = {r.k: tuple(r)[1:] for r in hosts.weighted_summary(weighted, ["k"]).collect()}
    assert got["a"] == (4, 2, 1, 1.0, pytest.approx(2.6)) and got["b"] == (1, 0, None, None, None) and got["c"][2] == 2


# --- mention and sentiment ------------------------------------------------------------------------

TARGETS = {"t": ["Brand", "Brand X"], "none": ["nobody"]}


def items(spark, rows):
    return spark.createDataFrame([(q, m, s, a, i, None) for i, (q, m, s, a) in enumerate(rows)], ITEM)


def test_mention_rates(spark):
    rows = items(spark, [("q1", "quick", "pass", "brand x"), ("q1", "research", "pass", "no"), ("q2", "quick", "pass", "other"), ("q3", "quick", "fail", "brand"), ("q4", "quick", "pass", C.REFUSAL_SENTENCES[0])])
    detail = mention.mention_detail(rows, TARGETS)
    assert detail.where("target_id = 't' AND item_pos = 0").first().mention_count == 2
    got = {(r.target_id, r.scope): (r.valid_count, r.mentioned_count, r.mention_rate) for r in mention.mention_summary(detail, TARGETS).collect()}
    assert got["t", "quick"] == (2, 1, 0.5) and got["t", "all_answers"] == (3, 1, pytest.approx(1 / 3)) and got["t", "question_level"] == (2, 1, 0.5) and got["none", "research"] == (1, 0, 0.0)
    empty = mention.mention_summary(mention.mention_detail(items(spark, []), TARGETS), TARGETS)
    assert empty.count() == 8 and empty.agg(F.sum("valid_count")).first()[0] == 0


@pytest.mark.parametrize("bad", [{}, {" ": ["a"]}, {"a": [" "]}])
def test_targets_are_checked(bad):
    with pytest.raises(ValueError):
        mention.build_targets(bad)


class Scripted:
    """Answers by what the text says."""

    def classify(self, answer_text, target_id, aliases):
        if "limit" in answer_text:
            raise sentiment.ProviderError("rate_limit", "slow down")
        if "late" in answer_text:
            raise sentiment.ProviderError("timeout", "too late")
        if "boom" in answer_text:
            raise RuntimeError("boom")
        if "odd" in answer_text:
            return "fine"
        return " Positive " if "good" in answer_text else "negative" if "bad" in answer_text else "neutral"


def test_sentiment_rows(spark):
    rows = items(spark, [("q1", "quick", "pass", f"Brand {w}") for w in ("good", "bad", "so", "limit", "late", "boom", "odd", "good 虚假宣传")] + [("q9", "quick", "pass", "nothing")])
    got = {r.item_pos: r for r in sentiment.sentiment_detail(rows, {"t": ["Brand"]}, Scripted(), {"t": C.NEGATIVE_RULES}).collect()}
    assert [got[i].sentiment_status for i in range(9)] == ["success", "success", "success", "rate_limited", "timeout", "failed", "failed", "success_with_warnings", "not_applicable"]
    assert (got[0].final_sentiment, got[5].error_type, got[6].error_type, got[7].final_sentiment) == ("positive", "RuntimeError", "ValueError", "negative")
    assert got[7].reason == "negative priority rule: false_advertising" and got[7].rule_override and got[8].provider is None and got[0].provider == "Scripted"


def test_sentiment_summary_takes_the_worst_label_of_a_question(spark):
    rows = items(spark, [("q1", "quick", "pass", "Brand so"), ("q1", "research", "pass", "Brand bad"), ("q2", "quick", "pass", "Brand limit"), ("q3", "quick", "pass", "Brand good")])
    detail = sentiment.sentiment_detail(rows, {"t": ["Brand"]}, Scripted())
    got = {r.scope: r for r in sentiment.sentiment_summary(detail, {"t": ["Brand"]}).collect()}
    q = got["question_level"]
    assert (q.planned_count, q.classified_count, q.failed_count, q.negative_count, q.positive_count) == (3, 2, 1, 1, 1)
    assert got["quick"].non_negative_rate == 1.0 and got["research"].negative_rate == 1.0
    assert sentiment.error_count(detail).first().error_count == 1


def test_retries():
    waits, calls = [], []

    class Flaky:
        def classify(self, *_):
            calls.append(1)
            if len(calls) < 4:
                raise sentiment.ProviderError("timeout", "t")
            return "neutral"

    assert sentiment.RetryingClassifier(Flaky(), 3, (3.0, 8.0), waits.append).classify("", "", []) == "neutral" and waits == [3.0, 8.0, 8.0]
    calls.clear()
    with pytest.raises(sentiment.ProviderError):
        sentiment.RetryingClassifier(Flaky(), 1, (), waits.append).classify("", "", [])


@pytest.mark.parametrize(("status", "body", "kind"), [(429, "", "rate_limit"), (503, "", "transient_api_error"), (404, "", "api_error"), (200, "x", "invalid_response"), (200, json.dumps({"message": {"content": json.dumps({"label": "neutral"})}}), None)])
def test_http_classifier(status, body, kind):
    c = sentiment.HttpClassifier("http://h", "m", 1, lambda *_: (status, body))
    if kind is None:
        assert c.classify("t", "t", ["a"]) == "neutral"
    else:
        with pytest.raises(sentiment.ProviderError) as error:
            c.classify("t", "t", ["a"])
        assert error.value.error_type == kind


def test_factory():
    assert sentiment.classifier_name(sentiment.create_classifier("lexicon", 2, positive=["a"], negative=[])) == "lexicon"
    with pytest.raises(ValueError):
        sentiment.create_classifier("other")


def test_metrics_need_the_same_targets(spark):
    a = mention.mention_summary(mention.mention_detail(items(spark, []), {"a": ["a"]}), {"a": ["a"]})
    b = sentiment.sentiment_summary(sentiment.sentiment_detail(items(spark, []), {"b": ["b"]}, Scripted()), {"b": ["b"]})
    with pytest.raises(Exception, match="summaries differ"):
        metrics.target_metrics(a, b).collect()


# --- runs -------------------------------------------------------------------------------------------


def test_gates(spark):
    rows = [("ok", "pass"), ("part", "pass"), ("part", "fail"), ("wait", "pending"), ("stop", "blocked"), ("stop", "fail")]
    df = runs.with_gates(runs.status_counts(spark.createDataFrame(rows, "b string, status string"), ["b"]))
    got = {r.b: (r.batch_status, r.gate_status, r.can_export) for r in df.collect()}
    assert got == {"ok": ("completed", "completed", True), "part": ("partial", "partial", False), "wait": ("completed", "blocked", False), "stop": ("blocked", "blocked", False)}


def test_upsert_replaces_in_place(spark):
    old = spark.createDataFrame([("a", "quick", "fail", 0), ("b", "quick", "pass", 1)], "question_id string, mode string, status string, pos bigint")
    new = spark.createDataFrame([("a", "quick", "pass", 0), ("c", "quick", "pass", 1)], old.schema)
    got = [(r.question_id, r.status) for r in runs.upsert(old, new, ["question_id", "mode"]).orderBy("added", "pos").collect()]
    assert got == [("a", "pass"), ("b", "pass"), ("c", "pass")]


def test_resume_and_stop(spark):
    tasks = spark.createDataFrame([("a", "quick"), ("b", "quick"), ("c", "quick")], "question_id string, mode string")
    done = spark.createDataFrame([("a", "quick", "pass"), ("b", "quick", "blocked")], "question_id string, mode string, status string")
    assert {r.question_id for r in runs.pending_tasks(tasks, done, ["question_id", "mode"]).collect()} == {"b", "c"}
    log = spark.createDataFrame([("x", 0, "pass"), ("x", 1, "blocked"), ("x", 2, "pass"), ("y", 0, "fail")], "b string, pos int, status string")
    assert rows_of(runs.until_first_blocked(log, ["b"], ["pos"]).select("b", "pos")) == [("x", 0), ("x", 1), ("y", 0)]


def test_task_violations(spark):
    rows = [("a", "q", "quick"), ("a", "q", "quick"), (" ", "q", "research"), ("b", None, "Quick "), (None, "", None)]
    got = Counter(r.violation for r in runs.task_violations(spark.createDataFrame(rows, "question_id string, question string, mode string")).collect())
    assert got == {"duplicate_key": 1, "blank_question_id": 2, "blank_question": 2, "bad_mode": 2}


# --- package ----------------------------------------------------------------------------------------

ANSWER = "platform string, question_id string, question string, answer string, turn_id string, chat_url string, mode string, mode_label string, search_queries array<string>, sources array<struct<rank:int,title:string,url:string>>, citation_mapping_available boolean, acquired_at timestamp_ntz"


def answers(spark, sources, question_id="q1"):
    return spark.createDataFrame([("p", question_id, "Q?", "好的回答", "t", "u", "quick", "快速", ["a"], sources, False, None)], ANSWER)


def test_package_rows(spark):
    rows = answers(spark, [(1, "T", " https://www.a.test/x "), (2, None, "https://www.a.test/x"), (3, "U", "https://b.test")])
    b, p = F.lit("b"), F.lit("p")
    a = package.package_answers(rows, b, p).first()
    assert a.mode_code == "quick" and a.is_complete and a.source_count_raw == 3 and json.loads(a.platform_meta_json)["search_queries"] == ["a"]
    s = package.package_sources(rows, b, p).orderBy("source_order").collect()
    assert [r.is_duplicate_in_answer for r in s] == [False, True, False] and s[0].source_site_name_raw == "a.test" and s[0].answer_id == a.answer_id
    with pytest.raises(Exception, match="no url"):
        package.package_sources(answers(spark, [(1, "T", " ")]), b, p).collect()
    with pytest.raises(Exception, match="question_id must not be null"):
        package.package_answers(answers(spark, [], None), b, p).collect()


def test_verify_lists_all_violations(spark):
    tasks = spark.createDataFrame([("t1",), ("t1",)], "task_id string")
    answer = spark.createDataFrame([("a1", "t1", '{"mention": 1}'), ("a2", "t9", "[]")], "answer_id string, task_id string, platform_meta_json string")
    sources = spark.createDataFrame([("s1", "a9")], "occurrence_id string, answer_id string")
    got = [(r.check_no, r.subject) for r in package.verify(tasks, answer, sources, {"task_count": 2, "answer_count": 2, "source_count": 5}).orderBy("check_no", "subject").collect()]
    assert got == [(11, "1"), (12, "t1"), (13, "a2"), (14, "s1"), (15, "a1"), (15, "a2")]


def test_repair(spark):
    busy = "当前访问人数过多，疯狂加服务器中，请稍后再试"
    tasks = spark.createDataFrame([("t1", "success", None, None), ("t2", "success", None, None)], "task_id string, task_status string, error_code string, error_message string")
    answer = spark.createDataFrame([("a1", "t1", "quick", busy, busy), ("a2", "t2", "quick", "正文。\n标题甲\n作者甲", None)], "answer_id string, task_id string, mode_code string, answer_text_raw string, answer_text_clean string")
    sources = spark.createDataFrame([("s1", "a1", None, "https://x.test"), ("s2", "a2", "", "https://www.y.test/")], "occurrence_id string, answer_id string, source_site_name_raw string, source_url_raw string")
    t, a, s = package.repair(tasks, answer, sources)
    assert {r.task_id: r.task_status for r in t.collect()} == {"t1": "failed", "t2": "success"}
    assert [(r.answer_id, r.answer_text_clean) for r in a.collect()] == [("a2", "正文。")] and [(r.occurrence_id, r.source_site_name_raw) for r in s.collect()] == [("s2", "y.test")]


def test_weighted_percentiles_match_the_plain_ones(spark, monkeypatch):
    import random

    import numpy as np

    from citeloom.operators import hosts

    monkeypatch.setattr(hosts, "WIDTH", 7)
    rng = random.Random(4)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), rng.choice([None, *range(-30, 60)])) for _ in range(3000)] + [("one", 5), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v int")
    got = {r.k: r for r in hosts.weighted_summary(hosts.weighted_values(df, ["k"], "v"), ["k"], percentiles=(0.0, 0.25, 0.5, 0.9, 1.0)).collect()}
    for key in {k for k, _ in rows}:
        values = [v for k, v in rows if k == key and v is not None]
        r = got[key]
        assert r.row_count == sum(k == key for k, _ in rows) and r.distinct_count == len(set(values))
        want = [None] * 5 if not values else [float(np.percentile(values, 100 * p)) for p in (0.0, 0.25, 0.5, 0.9, 1.0)]
        assert [r.p00, r.p25, r.p50, r.p90, r.p100] == pytest.approx(want)
        assert r.mode_value == (min(sorted(set(values)), key=lambda v: (-values.count(v), v)) if values else None)
    assert hosts.weighted_summary(hosts.weighted_values(df.limit(0), ["k"], "v"), ["k"]).count() == 0


def test_outcomes_of_attempts(spark):
    from citeloom import constants as C
    from citeloom.operators import runs

    texts = {"Q": "今日次数已用完", "B": "当前访问人数过多，疯狂加服务器中，请稍后再试", "R": C.REFUSAL_SENTENCES[0]}

    def machine(letters):
        """The retries as a loop: one after a busy service, one after a refusal."""
        left = list(letters)

        def ask():
            if not left:
                raise EOFError
            got = left.pop(0)
            if got == "B":
                if not left:
                    raise EOFError
                got = left.pop(0)
                if got == "B":
                    raise ValueError(("fail", C.BUSY_ERROR))
            if got == "Q":
                raise ValueError(("blocked", C.QUOTA_ERROR))
            return got

        try:
            if ask() == "R" and ask() == "R":
                return "blocked", C.REFUSAL_ERROR
            return "pass", None
        except ValueError as error:
            return error.args[0]
        except EOFError:
            return "pending", None

    import itertools

    cases = ["".join(c) for n in range(1, 5) for c in itertools.product("QBRO", repeat=n)]
    rows = [(c, "quick", "q", k, texts.get(x, f"{c}{k}")) for c in cases for k, x in enumerate(c)] + [("null", "quick", "q", 0, None)]
    got = {r.question_id: r for r in runs.attempt_outcomes(spark.createDataFrame(rows, "question_id string, mode string, question string, attempt int, answer string")).collect()}
    assert {c: (got[c].status, got[c].error_type) for c in cases} == {c: machine(c) for c in cases}
    assert got["BRO"].answer == "BRO2" and got["OO"].answer == "OO0" and got["RR"].output_path == "RR_quick_blocked.json" and got["BB"].output_path == "BB_quick_failed.json" and got["B"].output_path is None
