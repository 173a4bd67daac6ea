"""Queries of the subpackage."""

from __future__ import annotations

from pyspark.sql import functions as F

from citeloom.llm import copies, mixing, pairs, pii, templates, tokens, topn, truncation
from citeloom.plans.registry import Registry
from citeloom.sources.tables import table

registry = Registry()


def _form(column: str) -> str:
    return rf"lower(regexp_replace({column}, '[\p{{P}}\p{{Z}}\p{{C}}$+<=>^`|~]', '', 'g'))"


def _parts(column: str, separators: str) -> str:
    return f"list_sort(list_filter(list_transform(regexp_split_to_array({column}, '[{separators}]'), lambda x: {_form('x')}), lambda x: x <> ''))"


_FORMS = rf"""WITH form AS (SELECT source_row_id AS i, {_parts("title", "|｜")} AS t, {_form("regexp_extract(url, '^[^?#]*')")} AS p, {_parts(r"regexp_extract(url, '^[^?#]*[?]([^#]*)', 1)", "&;")} AS q,
  {_form("regexp_extract(url, '#(.*)$', 1)")} AS f FROM qwen_sources WHERE source_row_id IS NOT NULL),
grp AS (SELECT t, p, q, f, min(i) AS first_row_id, count(*)::BIGINT AS row_count FROM form GROUP BY t, p, q, f)
"""


@registry.add("p2_found",
    _FORMS + "SELECT DISTINCT first_row_id, i AS copy_row_id FROM form JOIN grp USING (t, p, q, f) WHERE i <> first_row_id")
def p2_found(spark, d):
    return copies.form_copies(table(spark, d, "qwen_sources"))


@registry.add("p2_records",
    _FORMS + "SELECT first_row_id, s.title, s.url, row_count FROM grp JOIN qwen_sources s ON s.source_row_id = first_row_id")
def p2_records(spark, d):
    return copies.form_groups(table(spark, d, "qwen_sources"))


TOP_SQL = """
WITH item AS (SELECT DISTINCT scope, domain, source_key, occurrence_count, first_seen_order FROM source_rank_items
  WHERE occurrence_count IS NOT NULL AND domain IS NOT NULL AND domain <> '' AND scope IS NOT NULL AND source_key IS NOT NULL),
best AS (SELECT * FROM item QUALIFY row_number() OVER (PARTITION BY scope, domain, source_key
  ORDER BY occurrence_count DESC, first_seen_order ASC NULLS LAST) = 1)
"""


def _top(spark, d):
    rows = table(spark, d, "source_rank_items").where(F.col("domain") != "")
    return topn.top_n(rows, ["scope", "domain"], "occurrence_count", "first_seen_order", "source_key", 10)


@registry.add(
    "p3_found",
    TOP_SQL
    + """SELECT scope, domain, source_key FROM best QUALIFY row_number() OVER (PARTITION BY scope, domain
  ORDER BY occurrence_count DESC, first_seen_order ASC NULLS LAST, source_key) <= 10""",
)
def p3_found(spark, d):
    return _top(spark, d).select("scope", "domain", F.col("item").alias("source_key"))


@registry.add(
    "p3_places",
    TOP_SQL
    + """SELECT scope, domain, source_key, occurrence_count, row_number() OVER (PARTITION BY scope, domain
  ORDER BY occurrence_count DESC, first_seen_order ASC NULLS LAST, source_key)::INTEGER AS place FROM best QUALIFY place <= 10""",
)
def p3_places(spark, d):
    return _top(spark, d).select("scope", "domain", F.col("item").alias("source_key"), F.col("score").alias("occurrence_count"), "place")


@registry.add("p7_ids")
def p7_ids(spark, d):
    return tokens.encode_documents(table(spark, d, "documents"))


def _mix(spark, d):
    sized = mixing.sized_documents(table(spark, d, "documents"))
    needs = mixing.source_needs(sized, table(spark, d, "mix_targets"))
    return mixing.mix(sized, needs), needs


@registry.add("p8_mix")
def p8_mix(spark, d):
    return _mix(spark, d)[0]


@registry.add("p8_shares")
def p8_shares(spark, d):
    return mixing.mix_shares(*_mix(spark, d))


@registry.add("p9_found")
def p9_found(spark, d):
    return pii.find_in(table(spark, d, "documents")).select("doc_id", "line_no", "pii_type").distinct()


@registry.add("p9_redacted")
def p9_redacted(spark, d):
    return table(spark, d, "documents").select("doc_id", pii.redact("text").alias("text"))


@registry.add("p5_found")
def p5_found(spark, d):
    return templates.template_residue(table(spark, d, "qwen_answers")).select(F.col("row_id").alias("turn_id")).distinct()


@registry.add("p5_clean_answers")
def p5_clean_answers(spark, d):
    rows = table(spark, d, "qwen_answers")
    clean = templates.is_residue_free(rows, templates.template_residue(rows))
    return clean.select("turn_id", "mode", "answer").distinct()


def _geo_answers(spark, d):
    """Answers with their batch's product; batch ids are few and unique."""
    batches = table(spark, d, "geo_manifests").groupBy("batch_id").agg(F.min("product_id").alias("product_id"))
    return table(spark, d, "geo_answers").join(batches, "batch_id", "left")


@registry.add("p1_found")
def p1_found(spark, d):
    found = truncation.find_truncated(_geo_answers(spark, d), "answer_id", "answer_text_raw", ["product_id", "mode_code"])
    return found.select(F.col("row_id").alias("answer_id"))


@registry.add("p1_shares")
def p1_shares(spark, d):
    answers = _geo_answers(spark, d)
    found = truncation.find_truncated(answers, "answer_id", "answer_text_raw", ["product_id", "mode_code"])
    return truncation.truncation_shares(answers, found, ["product_id", "mode_code"], "answer_id")


@registry.add("p1_limits")
def p1_limits(spark, d):
    return truncation.hidden_limits(_geo_answers(spark, d), ["product_id", "mode_code"], "answer_text_raw")


@registry.add("p4_found")
def p4_found(spark, d):
    return pairs.pair_defects(table(spark, d, "qwen_answers"), groups=("mode",)).select(F.col("row_id").alias("turn_id"), "defect_type")


@registry.add("p4_defect_counts")
def p4_defect_counts(spark, d):
    return pairs.pair_defects(table(spark, d, "qwen_answers"),
        groups=("mode",)).groupBy("defect_type").agg(F.count(F.lit(1)).alias("turns"))
