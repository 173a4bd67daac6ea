"""Queries over answers: validity, mentions, priority rules, sentiment, the metric cube."""

from __future__ import annotations

from pyspark.sql import functions as F

from citeloom.functions import text
from citeloom.operators import mention, metrics, sentiment
from citeloom.plans.registry import Registry
from citeloom.sources.tables import table

registry = Registry()

#: Parameters of the queries. The aliases of the first target overlap, and then count twice.
TARGETS = {"baixu": ["柏序", "柏序堂"], "norara": ["Norara"], "fen undo": ["Fen undo"], "unseen": ["没有这个品牌名"]}
RULES = (("supply", ("停止进货", "已经失效")), ("confusion", ("混为一谈", "写错了")))
MARKERS = ("没有", "并非", "原因")
POSITIVE, NEGATIVE = ("温和", "性价比", "稳定", "sturdy", "mild"), ("偏苦", "差评", "停止进货", "slightly bitter")


def items(spark, d):
    """Landed answers as analysis items; a null answer is a failed task. Repeated rows count once."""
    rows = table(spark, d, "qwen_answers").select("turn_id", "question_id", "mode", "question", "answer").distinct()
    return rows.withColumns({"status": F.when(F.col("answer").isNotNull(), "pass").otherwise("fail"), "item_pos": F.col("turn_id")})


_S = r"\s\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x1c-\x1f"
_REFUSAL = "你好，我无法回答这个问题，我们换一个话题聊聊吧。"
_ITEMS = rf"""WITH item AS (SELECT DISTINCT turn_id, question_id, mode, question, answer FROM qwen_answers),
valid AS (SELECT *, lower(answer) AS t FROM item WHERE answer IS NOT NULL AND regexp_replace(answer, '[{_S}]+', '', 'g') <> '' AND regexp_replace(answer, '^[{_S}]+|[{_S}]+$', '', 'g') <> '{_REFUSAL}')
"""
_COUNTS = {
    "baixu": r"len(regexp_extract_all(t, '柏\s*序')) + len(regexp_extract_all(t, '柏\s*序\s*堂'))",
    "norara": r"len(regexp_extract_all(t, 'n\s*o\s*r\s*a\s*r\s*a'))",
    "fen undo": r"len(regexp_extract_all(t, 'f\s*e\s*n\s*u\s*n\s*d\s*o'))", "unseen": r"len(regexp_extract_all(t, '没有这个品牌名'))",
}
_DETAIL = _ITEMS + ", detail AS (" + " UNION ALL ".join(f"SELECT question_id, mode, turn_id AS item_pos, '{k}' AS target_id, ({v})::BIGINT AS mention_count FROM valid" for k, v in _COUNTS.items()) + ")\n"


@registry.add(
    "answer_validity",
    _ITEMS + "SELECT turn_id, turn_id IN (SELECT turn_id FROM valid) AS valid FROM item",
)
def answer_validity(spark, d):
    return items(spark, d).select("turn_id", text.is_valid_answer(F.col("status"), F.col("answer")).alias("valid"))


_NOTICES = rf"""WITH a AS (SELECT DISTINCT answer_id, answer_text_raw AS raw, trim(regexp_replace(answer_text_raw, '[{_S}]+', ' ', 'g')) AS t FROM geo_answers)
SELECT answer_id, coalesce(regexp_replace(raw, '^[{_S}]+|[{_S}]+$', '', 'g') = '{_REFUSAL}', FALSE) AS refusal,
  coalesce(length(t) <= 120 AND contains(t, '当前访问人数过多') AND contains(t, '疯狂加服务器中') AND contains(t, '请稍后再试'), FALSE) AS busy,
  coalesce(length(t) BETWEEN 1 AND 300 AND regexp_matches(t, '{text.quota_pattern()}'), FALSE) AS quota,
  coalesce(contains(raw, '请拖动下方滑块完成验证') OR contains(raw, '通过验证以确保正常访问') OR contains(raw, '验证失败'), FALSE) AS risk FROM a"""


@registry.add("answer_notices", _NOTICES)
def answer_notices(spark, d):
    raw = F.col("answer_text_raw")
    rows = table(spark, d, "geo_answers").select("answer_id", "answer_text_raw").distinct()
    return rows.select("answer_id", text.is_refusal(raw).alias("refusal"), text.is_busy(raw).alias("busy"),
        text.is_quota_exhausted(raw).alias("quota"), text.shows_risk_control(raw).alias("risk"))


@registry.add(
    "text_normalized",
    rf"""SELECT task_id, trim(regexp_replace(lower(replace(translate(question, '？，！：；（）％', '?,!:;()%'), '…', '...')), '[{_S}]+', ' ', 'g')) AS normalized FROM geo_tasks""",
)
def text_normalized(spark, d):
    return table(spark, d, "geo_tasks").select("task_id", text.normalize(F.col("question")).alias("normalized"))


@registry.add("text_document_normalized")
def text_document_normalized(spark, d):
    return table(spark, d, "documents").select("doc_id", text.normalize(F.col("text")).alias("normalized"))


CLEAN = rf"""WITH a AS (SELECT DISTINCT answer_id, mode_code, regexp_replace(coalesce(answer_text_raw, ''), '^[{_S}]+|[{_S}]+$', '', 'g') AS v FROM geo_answers),
lined AS (SELECT *, regexp_split_to_array(v, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]') AS lines FROM a),
shaped AS (SELECT *, reverse(array_to_string(list_transform(list_transform(lines, lambda x: regexp_replace(x, '^[{_S}]+|[{_S}]+$', '', 'g')), lambda x: CASE
  WHEN regexp_full_match(x, '[0-9]{{1,2}}:[0-9]{{2}}') THEN 'D' WHEN regexp_full_match(x, '[A-Za-z0-9_\-一-鿿#?]{{2,20}}') THEN 'N' WHEN length(x) BETWEEN 2 AND 120 THEN 'T' ELSE '-' END), '')) AS shape FROM lined),
cut AS (SELECT *, length(regexp_extract(shape, '^(?:N[NT]D?)+')) AS cards FROM shaped)
SELECT answer_id, CASE WHEN mode_code = 'quick' AND cards > 0
  THEN regexp_replace(array_to_string(list_transform(lines[1:len(lines) - cards], lambda x: regexp_replace(x, '[{_S}]+$', '', 'g')), chr(10)), '[{_S}]+$', '', 'g') ELSE v END AS answer_text_clean FROM cut"""


@registry.add("clean_answer_tail", CLEAN)
def clean_answer_tail(spark, d):
    rows = table(spark, d, "geo_answers").select("answer_id", "answer_text_raw", "mode_code").distinct()
    return rows.select("answer_id", text.clean_answer(F.col("answer_text_raw"), F.col("mode_code")).alias("answer_text_clean"))


@registry.add("search_query_counts",
    "SELECT mode, q AS query, count(*)::BIGINT AS n FROM (SELECT mode, unnest(list_distinct(list_transform(search_queries, lambda x: trim(x)))) AS q FROM (SELECT DISTINCT * FROM qwen_answers)) WHERE q <> '' GROUP BY mode, q")
def search_query_counts(spark, d):
    rows = table(spark, d, "qwen_answers").select("turn_id", "mode", "search_queries").distinct()
    return rows.select("mode", F.explode(text.distinct_queries(F.col("search_queries"))).alias("query")).groupBy("mode",
        "query").agg(F.count(F.lit(1)).alias("n"))


@registry.add(
    "search_queries_unquoted",
    rf"""WITH q AS (SELECT DISTINCT turn_id, search_queries FROM qwen_answers), each AS (SELECT turn_id, unnest(search_queries) AS q FROM q)
SELECT DISTINCT turn_id, u AS query FROM (SELECT turn_id, regexp_replace(regexp_replace(w, '^["“”'']+|["“”'']+$', '', 'g'), '^[{_S}]+|[{_S}]+$', '', 'g') AS u
  FROM (SELECT turn_id, q AS w FROM each UNION ALL SELECT turn_id, '“' || q || ' ”' FROM each UNION ALL SELECT turn_id, chr(39) || q FROM each)) WHERE u <> ''""",
)
def search_queries_unquoted(spark, d):
    """Search queries of an answer as they are and in quotation marks; each comes once."""
    rows = table(spark, d, "qwen_answers").select("turn_id", "search_queries").distinct()
    q = F.col("search_queries")
    every = F.concat(q, F.transform(q, lambda x: F.concat(F.lit("“"), x, F.lit(" ”"))), F.transform(q, lambda x: F.concat(F.lit("'"), x)))
    return rows.select("turn_id", F.explode(text.distinct_queries(every)).alias("query"))


@registry.add("mention_detail",
    _DETAIL + "SELECT question_id, mode, item_pos, target_id, mention_count, mention_count > 0 AS mentioned FROM detail")
def mention_detail(spark, d):
    return mention.mention_detail(items(spark, d), TARGETS)


_FRAME = "frame AS (SELECT t.target_id, s.scope FROM (VALUES ('baixu'), ('norara'), ('fen undo'), ('unseen')) t(target_id), (VALUES ('quick'), ('research'), ('all_answers'), ('question_level')) s(scope))"
_SUMMARY = (
    _DETAIL
    + f""", {_FRAME},
counted AS (SELECT target_id, mode AS scope, count(*) AS v, count(*) FILTER (mention_count > 0) AS m FROM detail GROUP BY target_id, mode
  UNION ALL SELECT target_id, 'all_answers', count(*), count(*) FILTER (mention_count > 0) FROM detail GROUP BY target_id
  UNION ALL SELECT target_id, 'question_level', count(DISTINCT question_id), count(DISTINCT CASE WHEN mention_count > 0 THEN question_id END) FROM detail GROUP BY target_id),
mention AS (SELECT target_id, scope, coalesce(v, 0)::BIGINT AS valid_count, coalesce(m, 0)::BIGINT AS mentioned_count, coalesce(m::DOUBLE / nullif(v, 0)::DOUBLE, 0.0) AS mention_rate FROM frame LEFT JOIN counted USING (target_id, scope))
"""
)


@registry.add("mention_by_scope", _SUMMARY + "SELECT * FROM mention")
def mention_by_scope(spark, d):
    return mention.mention_summary(mention.mention_detail(items(spark, d), TARGETS), TARGETS)


def _rule_sql() -> str:
    parts = []
    for r, (rule, terms) in enumerate(RULES):
        for k, term in enumerate(terms):
            n = len(term)
            negated = " OR ".join(f"contains(substring(t, greatest(1, i - 14), i - greatest(1, i - 14)), '{m}')" for m in MARKERS)
            parts.append(
                f"""SELECT turn_id, mode, '{rule}' AS rule, '{term}' AS term, i::INTEGER AS start, trim(substring(t, greatest(1, i - 18), least(length(t), i + {n - 1} + 18) - greatest(1, i - 18) + 1)) AS evidence
  FROM (SELECT turn_id, mode, t, unnest(list_filter(range(1, length(t) + 1), lambda i: substring(t, i, {n}) = '{term}')) AS i FROM normal WHERE contains(t, '{term}')) WHERE NOT ({negated})"""
            )
    return " UNION ALL ".join(parts)


#: Priority rules look at normalised text; full-width marks are what NFKC changes in these answers.
_NORMAL = _ITEMS + rf""", normal AS (SELECT turn_id, mode, trim(regexp_replace(lower(replace(translate(answer, '？，！：；（）％～｜', '?,!:;()%~|'), '…', '...')), '[{_S}]+', ' ', 'g')) AS t FROM valid)
"""


@registry.add("rule_evidence", _NORMAL + "SELECT turn_id, mode, rule, term, start, evidence FROM (" + _rule_sql() + ")")
def rule_evidence(spark, d):
    """The evidence of the priority rules in the answers of all modes."""
    return _evidence(items(spark, d))


def _evidence(rows):
    valid = rows.where(text.is_valid_answer(F.col("status"), F.col("answer")))
    normal = valid.select("turn_id", "mode", text.normalize(F.col("answer")).alias("t"))
    return normal.select("turn_id", "mode", F.inline(text.rule_hits(F.col("t"), RULES, MARKERS)))


def _classifier():
    return sentiment.LexiconClassifier(POSITIVE, NEGATIVE)


def _details(spark, d):
    return sentiment.sentiment_detail(items(spark, d), TARGETS, _classifier(), {"baixu": RULES}, MARKERS)


def _score() -> str:
    count = lambda ws: " + ".join(f"(length(t) - length(replace(t, '{w}', ''))) / {len(w)}" for w in ws)
    return f"({count(POSITIVE)}) - ({count(NEGATIVE)})"


def _hit_sql() -> str:
    terms = [t for _, ts in RULES for t in ts]
    checks = []
    for term in terms:
        negated = " OR ".join(f"contains(substring(n, greatest(1, i - 14), i - greatest(1, i - 14)), '{m}')" for m in MARKERS)
        checks.append(f"len(list_filter(range(1, length(n) + 1), lambda i: substring(n, i, {len(term)}) = '{term}' AND NOT ({negated}))) > 0")
    return " OR ".join(checks)


_SENTIMENT = (
    _DETAIL
    + rf""", mentioned AS (SELECT * FROM detail WHERE mention_count > 0),
labelled AS (SELECT m.question_id, m.mode, m.item_pos, m.target_id, CASE WHEN {_score()} > 0 THEN 'positive' WHEN {_score()} < 0 THEN 'negative' ELSE 'neutral' END AS label,
  trim(regexp_replace(replace(translate(t, '？，！：；（）％～｜', '?,!:;()%~|'), '…', '...'), '[{_S}]+', ' ', 'g')) AS n FROM mentioned m JOIN valid v ON v.turn_id = m.item_pos),
ruled AS (SELECT *, target_id = 'baixu' AND ({_hit_sql()}) AS hit FROM labelled),
sent AS (SELECT question_id, mode, item_pos, target_id, TRUE AS classification_planned, CASE WHEN hit AND label <> 'negative' THEN 'success_with_warnings' ELSE 'success' END AS sentiment_status, label AS model_sentiment,
  CASE WHEN hit THEN 'negative' ELSE label END AS final_sentiment, hit AS rule_hit, hit AND label <> 'negative' AS rule_override FROM ruled
  UNION ALL SELECT i.question_id, i.mode, i.turn_id, t.target_id, FALSE, 'not_applicable', NULL, NULL, FALSE, FALSE FROM item i, (VALUES ('baixu'), ('norara'), ('fen undo'), ('unseen')) t(target_id)
  WHERE NOT EXISTS (SELECT 1 FROM mentioned m WHERE m.item_pos = i.turn_id AND m.target_id = t.target_id))
"""
)
_SENT_COLUMNS = ("question_id", "mode", "item_pos", "target_id", "classification_planned", "sentiment_status", "model_sentiment",
    "final_sentiment", "rule_hit", "rule_override")


@registry.add("sentiment_detail", _SENTIMENT + f"SELECT {', '.join(_SENT_COLUMNS)} FROM sent")
def sentiment_detail(spark, d):
    return _details(spark, d).select(*_SENT_COLUMNS)


_SENT_SUMMARY = (
    _SENTIMENT
    + f""", {_FRAME}, planned AS (SELECT * FROM sent WHERE classification_planned),
q AS (SELECT target_id, question_id, max(CASE final_sentiment WHEN 'negative' THEN 3 WHEN 'positive' THEN 2 ELSE 1 END) AS w FROM planned GROUP BY target_id, question_id),
c AS (SELECT target_id, mode AS scope, count(*) AS p, count(*) FILTER (final_sentiment = 'positive') AS pos, count(*) FILTER (final_sentiment = 'neutral') AS neu, count(*) FILTER (final_sentiment = 'negative') AS neg FROM planned GROUP BY target_id, mode
  UNION ALL SELECT target_id, 'all_answers', count(*), count(*) FILTER (final_sentiment = 'positive'), count(*) FILTER (final_sentiment = 'neutral'), count(*) FILTER (final_sentiment = 'negative') FROM planned GROUP BY target_id
  UNION ALL SELECT target_id, 'question_level', count(*), count(*) FILTER (w = 2), count(*) FILTER (w = 1), count(*) FILTER (w = 3) FROM q GROUP BY target_id),
sentiment AS (SELECT target_id, scope, coalesce(p, 0)::BIGINT AS planned_count, coalesce(p, 0)::BIGINT AS classified_count, coalesce(pos, 0)::BIGINT AS positive_count, coalesce(neu, 0)::BIGINT AS neutral_count, coalesce(neg, 0)::BIGINT AS negative_count,
  0::BIGINT AS failed_count, coalesce(pos + neu, 0)::BIGINT AS non_negative_count, coalesce(pos::DOUBLE / p, 0.0) AS positive_rate, coalesce(neu::DOUBLE / p, 0.0) AS neutral_rate, coalesce(neg::DOUBLE / p, 0.0) AS negative_rate,
  coalesce((pos + neu)::DOUBLE / p, 0.0) AS non_negative_rate FROM frame LEFT JOIN c USING (target_id, scope))
"""
)


@registry.add("sentiment_by_scope", _SENT_SUMMARY + "SELECT * FROM sentiment")
def sentiment_by_scope(spark, d):
    return sentiment.sentiment_summary(_details(spark, d), TARGETS)


class FaultyClassifier:
    """The lexicon behind a service that fails on some texts: one call per text, in Python."""

    name = "faulty"

    def classify(self, answer_text, target_id, aliases):
        if "孕期" in answer_text:
            raise sentiment.ProviderError("rate_limit", "too many calls")
        if "pharmacist" in answer_text:
            raise sentiment.ProviderError("timeout", "too late")
        if "更正" in answer_text:
            return "mixed"
        if "客服" in answer_text:
            raise ValueError("no text")
        return f" {_classifier().classify(answer_text, target_id, aliases).upper()} "


#: Without rules; the first fault of a text counts.
_FAULTY = (
    _DETAIL
    + f""", called AS (SELECT d.question_id, d.mode, d.item_pos, d.target_id, CASE WHEN contains(v.answer, '孕期') THEN 'rate_limit' WHEN contains(v.answer, 'pharmacist') THEN 'timeout'
  WHEN contains(v.answer, '更正') OR contains(v.answer, '客服') THEN 'ValueError' END AS error_type, CASE WHEN {_score()} > 0 THEN 'positive' WHEN {_score()} < 0 THEN 'negative' ELSE 'neutral' END AS label
  FROM detail d JOIN valid v ON v.turn_id = d.item_pos WHERE d.mention_count > 0),
faulty AS (SELECT question_id, mode, item_pos, target_id, CASE error_type WHEN 'rate_limit' THEN 'rate_limited' WHEN 'timeout' THEN 'timeout' WHEN 'ValueError' THEN 'failed' ELSE 'success' END AS sentiment_status,
  error_type, CASE WHEN error_type IS NULL THEN label END AS final_sentiment FROM called)
"""
)


def _faulty(spark, d):
    return sentiment.sentiment_detail(items(spark, d), TARGETS, FaultyClassifier()).where("classification_planned")


@registry.add("sentiment_classifier_faults", _FAULTY + "SELECT * FROM faulty")
def sentiment_classifier_faults(spark, d):
    return _faulty(spark, d).select("question_id", "mode", "item_pos", "target_id", "sentiment_status", "error_type", "final_sentiment")


@registry.add("sentiment_error_count",
    _FAULTY + "SELECT count(*) FILTER (sentiment_status IN ('failed', 'rate_limited', 'timeout'))::BIGINT AS error_count FROM faulty")
def sentiment_error_count(spark, d):
    return sentiment.error_count(_faulty(spark, d))


@registry.add(
    "sentiment_retries",
    _FAULTY + "SELECT item_pos, target_id, 'success' AS sentiment_status, label AS final_sentiment FROM called WHERE error_type = 'timeout' OR error_type = 'rate_limit'",
)
def sentiment_retries(spark, d):
    """Texts on which the service fails at first, called again inside the task."""

    class Recovering(FaultyClassifier):
        def __init__(self):
            self.failed = set()

        def classify(self, answer_text, target_id, aliases):
            key = hash((answer_text, target_id))
            if key not in self.failed:
                self.failed.add(key)
                raise sentiment.ProviderError("transient_api_error", "once more")
            return _classifier().classify(answer_text, target_id, aliases)

    retried = sentiment.RetryingClassifier(Recovering(), 2, ())
    rows = items(spark, d).where(F.contains("answer", F.lit("孕期")) | F.contains("answer", F.lit("pharmacist")))
    return sentiment.sentiment_detail(rows, TARGETS, retried).where("classification_planned").select("item_pos", "target_id",
        "sentiment_status", "final_sentiment")


@registry.add(
    "metrics_targets",
    _SUMMARY.rstrip() + _SENT_SUMMARY[len(_DETAIL) :].replace(f", {_FRAME}", "")
    + """SELECT target_id, """ + ", ".join(
        f"max({c}) FILTER (scope = '{s}') AS {s}_{c}" for s in ("quick", "research", "all_answers",
        "question_level") for c in ("mention_rate", "non_negative_rate", "negative_rate")
    ) + " FROM mention JOIN sentiment USING (target_id, scope) GROUP BY target_id",
)
def metrics_targets(spark, d):
    rows = items(spark, d)
    mentions = mention.mention_summary(mention.mention_detail(rows, TARGETS), TARGETS)
    return metrics.target_metrics(mentions, sentiment.sentiment_summary(_details(spark, d), TARGETS))
