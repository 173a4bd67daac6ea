"""Queries over batch runs and package tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from citeloom import constants as C
from citeloom.functions import ids, text
from citeloom.operators import package, row_checks, runs
from citeloom.plans.answers import CLEAN
from citeloom.plans.registry import Registry
from citeloom.sources.tables import table

registry = Registry()
#: Parameters of the queries that build a package from the answers.
BATCH, PLATFORM = "batch_0001", "assistant"
#: Error codes that stop a batch.
BLOCKING = "(RiskControl|Quota)Error$"


def results(spark, d):
    """Package tasks as run results: failed tasks with a blocking error are blocked, running ones pending."""
    status = (
        F.when(F.col("task_status") == "success", "pass").when(F.col("task_status") == "running",
        "pending").when(F.col("error_code").rlike(BLOCKING), "blocked").otherwise("fail")
    )
    mode = F.when(F.col("mode_code") == "expert", "research").otherwise(F.col("mode_code"))
    return table(spark, d, "geo_tasks").select("task_id", "batch_id", "question_id", "question", mode.alias("mode"), status.alias("status"),
        F.col("error_code").alias("error_type"), "error_message")


_RESULTS = """WITH result AS (SELECT task_id, batch_id, question_id, question, CASE mode_code WHEN 'expert' THEN 'research' ELSE mode_code END AS mode,
  CASE WHEN task_status = 'success' THEN 'pass' WHEN task_status = 'running' THEN 'pending' WHEN regexp_matches(error_code, '(RiskControl|Quota)Error$') THEN 'blocked' ELSE 'fail' END AS status,
  error_code AS error_type, error_message FROM geo_tasks)
"""


@registry.add("task_mode_counts", "SELECT mode_code, count(*)::BIGINT AS task_count FROM geo_tasks GROUP BY mode_code")
def task_mode_counts(spark, d):
    return runs.mode_counts(table(spark, d, "geo_tasks"), "mode_code")


@registry.add(
    "task_violations",
    """SELECT question_id, mode, 'blank_question_id' AS violation FROM (SELECT trim(question_id) AS question_id, question, mode FROM qwen_answers) WHERE coalesce(question_id, '') = ''
UNION ALL SELECT question_id, mode, 'blank_question' FROM qwen_answers WHERE coalesce(trim(question), '') = ''
UNION ALL SELECT question_id, mode, 'bad_mode' FROM qwen_answers WHERE mode IS NULL OR mode NOT IN ('quick', 'research')
UNION ALL SELECT question_id, mode, 'duplicate_key' FROM qwen_answers GROUP BY question_id, mode HAVING count(*) > 1""",
)
def task_violations(spark, d):
    return runs.task_violations(table(spark, d, "qwen_answers"))


_COUNTS = """SELECT batch_id, count(*) FILTER (status = 'pass')::BIGINT AS pass_count, count(*) FILTER (status = 'fail')::BIGINT AS fail_count, count(*) FILTER (status = 'blocked')::BIGINT AS blocked_count,
  count(*)::BIGINT AS planned_count, count(*) FILTER (status <> 'pending')::BIGINT AS executed_count, count(*) FILTER (status = 'pending')::BIGINT AS pending_count FROM result GROUP BY batch_id"""


@registry.add("run_status_counts", _RESULTS + _COUNTS)
def run_status_counts(spark, d):
    return runs.status_counts(results(spark, d), ["batch_id"])


@registry.add(
    "run_gate_status",
    _RESULTS
    + f"""SELECT *, CASE WHEN blocked_count > 0 THEN 'blocked' WHEN fail_count > 0 THEN 'partial' ELSE 'completed' END AS batch_status,
  CASE WHEN blocked_count > 0 OR pending_count > 0 THEN 'blocked' WHEN fail_count > 0 THEN 'partial' ELSE 'completed' END AS gate_status,
  blocked_count = 0 AND pending_count = 0 AND fail_count = 0 AS can_export, pass_count::DOUBLE / planned_count AS completion_rate FROM ({_COUNTS})""",
)
def run_gate_status(spark, d):
    return runs.with_gates(runs.status_counts(results(spark, d), ["batch_id"]))


@registry.add("run_resume_pending", _RESULTS + "SELECT batch_id, question_id, mode FROM result r WHERE status <> 'pass'")
def run_resume_pending(spark, d):
    rows = results(spark, d)
    return runs.pending_tasks(rows, rows, ["batch_id", "question_id", "mode"]).select("batch_id", "question_id", "mode")


@registry.add(
    "run_until_first_blocked",
    _RESULTS + """SELECT batch_id, question_id, mode, status FROM result r WHERE NOT EXISTS (SELECT 1 FROM result b WHERE b.batch_id = r.batch_id AND b.status = 'blocked' AND (b.question_id, b.mode) < (r.question_id, r.mode))""",
)
def run_until_first_blocked(spark, d):
    return runs.until_first_blocked(results(spark, d), ["batch_id"], ["question_id", "mode"]).select("batch_id", "question_id", "mode",
        "status")


_TRIED = """WITH tried AS (SELECT DISTINCT turn_id, question, translate(reverse(right(turn_id, 3)), '0123456789abcdef', 'QQBBBBRRRROOOOOO') AS letters FROM qwen_answers)
"""


@registry.add(
    "run_attempts",
    _TRIED + """SELECT turn_id AS question_id, 'quick' AS mode, status, CASE status WHEN 'pending' THEN NULL ELSE turn_id || '_quick' || CASE status WHEN 'blocked' THEN '_blocked' WHEN 'fail' THEN '_failed' ELSE '' END || '.json' END AS output_path,
  CASE status WHEN 'blocked' THEN CASE WHEN regexp_matches(letters, '^B?(RB?)?Q') THEN 'QuotaExhaustedError' ELSE 'RefusalError' END WHEN 'fail' THEN 'ServiceBusyError' END AS error_type,
  CASE WHEN status = 'pass' THEN 'answer ' || (length(regexp_extract(letters, '^B?(RB?)?O')))::VARCHAR END AS answer
FROM (SELECT *, CASE WHEN regexp_matches(letters, '^B?(RB?)?O') THEN 'pass' WHEN regexp_matches(letters, '^B?(RB?)?Q|^B?RB?R') THEN 'blocked' WHEN regexp_matches(letters, '^(B?R)?BB') THEN 'fail' ELSE 'pending' END AS status FROM tried)""",
)
def run_attempts(spark, d):
    """Three attempts at each turn's question, what they bring drawn from the turn's id."""
    rows = table(spark, d, "qwen_answers").select("turn_id", "question").distinct()
    place = F.explode(F.array(*[F.lit(i) for i in (1, 2, 3)]))
    drawn = rows.select("turn_id", "question", place.alias("attempt")).withColumn("c", F.substr("turn_id", F.length("turn_id") + 1 - F.col("attempt"), F.lit(1)))
    said = F.when(F.col("c").isin("0", "1"), C.QUOTA_PHRASES[0]).when(F.col("c").isin(*"2345"), _BUSY).when(F.col("c").isin(*"6789"), C.REFUSAL_SENTENCES[0])
    attempts = drawn.select(F.col("turn_id").alias("question_id"), F.lit("quick").alias("mode"), "question", "attempt", said.otherwise(F.concat(F.lit("answer "), F.col("attempt").cast("string"))).alias("answer"))
    return runs.attempt_outcomes(attempts).drop("question", "error_message")


@registry.add(
    "search_headings",
    """SELECT turn_id, n AS announced, coalesce(len(search_queries), 0)::INTEGER AS found, n <> coalesce(len(search_queries), 0) AS differs, CASE WHEN length(question) % 2 = 0 THEN 'r' || length(question)::VARCHAR END AS request
FROM (SELECT DISTINCT turn_id, question, search_queries, (coalesce(len(search_queries), 0) + length(question) % 2)::INTEGER AS n FROM qwen_answers WHERE question IS NOT NULL)""",
)
def search_headings(spark, d):
    """Headings that announce a number of search words, made up from the answers, against the words there are; and requests of anchors."""
    found = F.greatest(F.coalesce(F.size("search_queries"), F.lit(0)), F.lit(0))
    rows = table(spark, d, "qwen_answers").where("question IS NOT NULL").select("turn_id", "question", "search_queries").distinct().withColumn("found", found)
    odd = F.length("question") % 2
    heading = F.concat(F.lit(" 搜索 "), (F.col("found") + odd).cast("string"), F.lit(" 个关键词，参考 7 篇资料\n"))
    anchor = F.concat(F.when(odd == 0, C.ANCHOR_PREFIX).otherwise("link-"), F.lit("r"), F.length("question").cast("string"), F.lit(" "))
    said = rows.withColumns({"h": text.search_heading(heading), "request": text.anchor_request(anchor)})
    return said.select("turn_id", F.col("h.keywords").alias("announced"), "found", (F.col("h.keywords") != F.col("found")).alias("differs"), "request")


@registry.add(
    "run_latest_merge",
    """SELECT occurrence_id, arg_max(url, (landed_at, url)) AS url, max(landed_at) AS landed_at FROM source_occurrences GROUP BY occurrence_id""",
)
def run_latest_merge(spark, d):
    return runs.latest(table(spark, d, "source_occurrences").select("occurrence_id", "url", "landed_at"), ["occurrence_id"],
        ["landed_at", "url"])


@registry.add(
    "run_upsert",
    """WITH old AS (SELECT user_id, event_type, min(event_id) AS pos, arg_max(value, event_id) AS value FROM events WHERE event_id % 2 = 0 GROUP BY ALL),
new AS (SELECT user_id, event_type, min(event_id) AS pos, arg_max(value, event_id) AS value FROM events WHERE event_id % 2 = 1 GROUP BY ALL)
SELECT user_id, event_type, coalesce(new.value, old.value) AS value, CASE WHEN old.pos IS NULL THEN 1 ELSE 0 END AS added, coalesce(old.pos, new.pos) AS pos FROM old FULL JOIN new USING (user_id, event_type)""",
)
def run_upsert(spark, d):
    """Two halves of the events as a run log and its continuation."""
    rows = table(spark, d, "events").select("user_id", "event_type", "value", F.col("event_id").alias("pos"))
    return runs.upsert(rows.where("pos % 2 = 0"), rows.where("pos % 2 = 1"), ["user_id", "event_type"]).select("user_id", "event_type",
        "value", "added", "pos")


def package_source_rows(spark, d):
    """Answers with a question id and their citations nested, as landed; null ids and failed answers are left out."""
    answers = table(spark, d, "qwen_answers").where("question_id IS NOT NULL AND answer IS NOT NULL").distinct()
    answers = runs.latest(answers, ["question_id", "mode"], ["acquired_at", "turn_id"])
    cited = table(spark, d, "qwen_sources").where(F.length(text.strip(F.col("url"))) > 0)
    # An answer's citations are few.
    nested = cited.groupBy("turn_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "source_row_id", "title", "url"))),
        lambda s: F.struct(s["rank"], s["title"], s["url"])).alias("sources"))
    empty = F.array().cast("array<struct<rank:int,title:string,url:string>>")
    return answers.join(nested, "turn_id", "left").withColumns({"sources": F.coalesce("sources", empty),
        "citation_mapping_available": F.lit(False)})


NEST = r"""WITH a AS (SELECT * FROM (SELECT DISTINCT * FROM qwen_answers WHERE question_id IS NOT NULL AND answer IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY question_id, mode ORDER BY acquired_at DESC, turn_id DESC) = 1),
ids AS (SELECT *, 'assistant_task_' || substring(sha1('batch_0001|' || question_id || '|' || mode), 1, 16) AS task_id FROM a),
ids2 AS (SELECT *, 'assistant_answer_' || substring(sha1(task_id), 1, 16) AS answer_id FROM ids),
s AS (SELECT answer_id, turn_id, question_id, mode, source_row_id, q."rank" AS r, q.title AS title, q.url AS raw_url,
  regexp_replace(q.url, '^[\s\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x1c-\x1f]+|[\s\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x1c-\x1f]+$', '', 'g') AS url
  FROM ids2 JOIN qwen_sources q USING (turn_id))
"""


@registry.add(
    "pkg_task_ids",
    "SELECT task_id, regexp_extract(task_id, '^([a-z]+)_task_', 1) || '_task_' || substring(sha1(batch_id || '|' || question_id || '|' || CASE mode_code WHEN 'expert' THEN 'research' ELSE mode_code END), 1, 16) AS rebuilt FROM geo_tasks",
)
def pkg_task_ids(spark, d):
    rebuilt = ids.task_id(F.regexp_extract("task_id", "^([a-z]+)_task_", 1), F.col("batch_id"), F.col("question_id"), F.col("mode"))
    return results(spark, d).select("task_id", rebuilt.alias("rebuilt"))


@registry.add(
    "pkg_tasks",
    _RESULTS
    + """SELECT 'assistant_task_' || substring(sha1('batch_0001|' || question_id || '|' || mode), 1, 16) AS task_id, question_id, question, CASE mode WHEN 'research' THEN 'expert' ELSE mode END AS mode_code,
  CASE status WHEN 'pass' THEN 'success' WHEN 'pending' THEN 'running' ELSE 'failed' END AS task_status, error_type AS error_code, error_message FROM result""",
)
def pkg_tasks(spark, d):
    return package.package_tasks(results(spark, d), F.lit(BATCH), F.lit(PLATFORM))


@registry.add(
    "pkg_answers",
    NEST
    + """SELECT answer_id, task_id, question_id, CASE mode WHEN 'research' THEN 'expert' ELSE mode END AS mode_code, question AS question_text, answer AS answer_text_raw, 'success' AS acquisition_status, 'PASS' AS validation_status,
  (SELECT count(*) FROM s WHERE s.answer_id = ids2.answer_id)::BIGINT AS source_count_raw, acquired_at AS collected_at FROM ids2""",
)
def pkg_answers(spark, d):
    rows = package.package_answers(package_source_rows(spark, d), F.lit(BATCH), F.lit(PLATFORM))
    return rows.select("answer_id", "task_id", "question_id", "mode_code", "question_text", "answer_text_raw", "acquisition_status",
        "validation_status", "source_count_raw", "collected_at")


@registry.add(
    "pkg_sources",
    NEST
    + r"""SELECT 'assistant_source_' || substring(sha1(answer_id || '|' || r || '|' || url), 1, 16) AS occurrence_id, answer_id, r AS source_order, title AS source_title_raw, url AS source_url_raw,
  row_number() OVER (PARTITION BY answer_id, url ORDER BY r, source_row_id) > 1 AS is_duplicate_in_answer FROM s""",
)
def pkg_sources(spark, d):
    rows = package.package_sources(package_source_rows(spark, d), F.lit(BATCH), F.lit(PLATFORM))
    return rows.select("occurrence_id", "answer_id", "source_order", "source_title_raw", "source_url_raw", "is_duplicate_in_answer")


@registry.add("pkg_legacy_sources",
    NEST + """SELECT substring(sha1(question_id || '|' || mode || '|' || r || '|' || raw_url), 1, 12) AS source_occurrence_id, question_id, mode, r AS "rank", title, raw_url AS url FROM s""")
def pkg_legacy_sources(spark, d):
    return package.legacy_sources(package_source_rows(spark, d))


@registry.add("pkg_legacy_answers",
    NEST + "SELECT question_id, mode, platform, question, answer, turn_id, chat_url, mode_label, acquired_at FROM a")
def pkg_legacy_answers(spark, d):
    return package.legacy_answers(package_source_rows(spark, d)).drop("search_queries")


@registry.add("pkg_legacy_tasks", _RESULTS + "SELECT question_id, mode, question, status, error_type, error_message FROM result")
def pkg_legacy_tasks(spark, d):
    return package.legacy_tasks(results(spark, d))


@registry.add(
    "pkg_fk_violations",
    """SELECT answer_id, task_id FROM geo_answers a WHERE task_id NOT IN (SELECT task_id FROM geo_tasks WHERE task_status <> 'failed' OR error_code IS NULL)""",
)
def pkg_fk_violations(spark, d):
    """Answers against the tasks without an error code."""
    tasks = table(spark, d, "geo_tasks").where("task_status <> 'failed' OR error_code IS NULL")
    return package.orphans(table(spark, d, "geo_answers"), tasks, "task_id", "answer_id")


@registry.add("pkg_unique_violations",
    "SELECT answer_id, count(*)::BIGINT AS row_count FROM geo_answers GROUP BY answer_id HAVING count(*) > 1")
def pkg_unique_violations(spark, d):
    return package.repeated_ids(table(spark, d, "geo_answers"), "answer_id")


@registry.add(
    "pkg_source_count_check",
    """WITH n AS (SELECT turn_id AS answer_id, count(*) AS n FROM qwen_sources GROUP BY turn_id)
SELECT turn_id AS answer_id, (length(turn_id) % 7)::BIGINT AS source_count_raw, coalesce(n, 0)::BIGINT AS source_count FROM (SELECT DISTINCT turn_id FROM qwen_answers) a LEFT JOIN n ON n.answer_id = a.turn_id
WHERE length(turn_id) % 7 <> coalesce(n, 0)""",
)
def pkg_source_count_check(spark, d):
    """Landed citations against a recorded number, here a made-up one."""
    answers = table(spark, d, "qwen_answers").select(F.col("turn_id").alias("answer_id"),
        (F.length("turn_id") % 7).cast("bigint").alias("source_count_raw")).distinct()
    return package.source_count_mismatches(answers, table(spark, d, "qwen_sources").withColumnRenamed("turn_id", "answer_id"))


@registry.add("pkg_forbidden_fields",
    "SELECT event_id::BIGINT AS event_id, 'k' AS field FROM events WHERE props IS NOT NULL AND json_extract(props, '$.k') IS NOT NULL")
def pkg_forbidden_fields(spark, d):
    return package.forbidden_fields(table(spark, d, "events"), "event_id", "props", ("k", "metrics"))


def _with_planted_meta(spark, d):
    """Answers whose meta objects hold forbidden keys where acquisition failed, and are no objects where it was stopped."""
    meta = F.col("platform_meta_json")
    planted = F.when(F.col("acquisition_status") == "failed",
        F.concat(F.lit('{"metrics": 1, "x": {"sentiment": 1}, "mention": '), F.coalesce(meta, F.lit("null")),
        F.lit("}"))).when(F.col("acquisition_status") == "risk_control", F.concat(F.lit("["), F.coalesce(meta, F.lit("null")), F.lit("]")))
    return table(spark, d, "geo_answers").withColumn("platform_meta_json", planted.otherwise(meta))


@registry.add(
    "pkg_forbidden_meta",
    """SELECT DISTINCT answer_id, unnest(CASE acquisition_status WHEN 'failed' THEN ['metrics', 'mention'] WHEN 'risk_control' THEN ['(no object)']
  ELSE CASE WHEN platform_meta_json IS NOT NULL AND NOT json_valid(platform_meta_json) THEN ['(no object)'] ELSE [] END END) AS field FROM geo_answers""",
)
def pkg_forbidden_meta(spark, d):
    return package.forbidden_fields(_with_planted_meta(spark, d), "answer_id", "platform_meta_json").distinct()


@registry.add(
    "pkg_forbidden_raw",
    """SELECT DISTINCT answer_id, CASE WHEN length(answer_text_raw) % 2 = 0 THEN 'mention' ELSE 'metric_result' END AS field FROM geo_answers WHERE acquisition_status <> 'success' AND answer_text_raw IS NOT NULL""",
)
def pkg_forbidden_raw(spark, d):
    """Forbidden keys of raw answer lines; planted where acquisition did not succeed."""
    even = F.length("answer_text_raw") % 2 == 0
    odd_ones = F.col("acquisition_status") != "success"
    rows = table(spark, d, "geo_answers").withColumns({"mention": F.when(odd_ones & even, "x"), "metric_result": F.when(odd_ones & ~even,
        F.length("answer_text_raw"))})
    lines = rows.select("answer_id", F.to_json(F.struct(*[c for c in rows.columns])).alias("line"))
    found = row_checks.row_faults(lines, "line", (), ["answer_id"], C.FORBIDDEN_FIELDS)
    return found.select("answer_id", "field").distinct()


#: What is planted in task lines by the last letter of the task's id: what becomes of a field, and the fault that gives.
_PLANTED = {"0": ("mode_code", "value"), "1": ("question", "missing"), "2": ("task_status", "null"), "3": ("question_id", "type"),
    "4": ("", "no JSON"), "5": ("", "no object")}


@registry.add(
    "pkg_row_schema",
    "SELECT task_id, CASE right(task_id, 1) " + " ".join(f"WHEN '{k}' THEN '{f}'" for k,
    (f, _) in _PLANTED.items()) + " END AS field, CASE right(task_id, 1) "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, (_,
    v) in _PLANTED.items()) + " END AS fault FROM geo_tasks WHERE right(task_id, 1) IN ('0', '1', '2', '3', '4', '5')",
)
def pkg_row_schema(spark, d):
    """Lines of tasks with planted faults against the schema of task rows."""
    end = F.right("task_id", F.lit(1))
    names = ("task_id", "question_id", "question", "mode_code", "task_status", "error_code", "error_message")
    whole = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    swapped = {
        "0": F.to_json(F.struct("task_id", "question_id", "question", F.lit("slow").alias("mode_code"), "task_status")),
        "1": F.to_json(F.struct("task_id", "question_id", "mode_code", "task_status")),
        "2": F.to_json(F.struct("task_id", "question_id", "question", "mode_code", F.lit(None).cast("string").alias("task_status")),
        {"ignoreNullFields": "false"}),
        "3": F.to_json(F.struct("task_id", F.lit(7).alias("question_id"), "question", "mode_code", "task_status")),
        "4": F.concat(whole, F.lit("}")), "5": F.concat(F.lit("["), whole, F.lit("]")),
    }
    line = whole
    for letter, other in swapped.items():
        line = F.when(end == letter, other).otherwise(line)
    return row_checks.row_faults(table(spark, d, "geo_tasks").withColumn("line", line), "line", row_checks.PACKAGE_ROWS["tasks"],
        ["task_id"])


@registry.add(
    "pkg_source_fk",
    """SELECT source_row_id::VARCHAR AS occurrence_id, turn_id AS answer_id FROM qwen_sources WHERE turn_id NOT IN (SELECT turn_id FROM qwen_answers WHERE mode = 'quick' AND answer IS NOT NULL)""",
)
def pkg_source_fk(spark, d):
    """Citations against the quick answers that have a text."""
    answers = table(spark, d, "qwen_answers").where("mode = 'quick' AND answer IS NOT NULL").withColumnRenamed("turn_id", "answer_id")
    sources = table(spark, d, "qwen_sources").select(F.col("source_row_id").cast("string").alias("occurrence_id"),
        F.col("turn_id").alias("answer_id"))
    return package.orphans(sources, answers, "answer_id", "occurrence_id").select("occurrence_id", "answer_id")


@registry.add(
    "pkg_unique_all",
    """SELECT 'task_id' AS key, question_id || '|' || mode_code AS id, count(*)::BIGINT AS row_count FROM geo_tasks GROUP BY question_id, mode_code HAVING count(*) > 1
UNION ALL SELECT 'answer_id', answer_id, count(*)::BIGINT FROM geo_answers GROUP BY answer_id HAVING count(*) > 1
UNION ALL SELECT 'occurrence_id', occurrence_id::VARCHAR, count(*)::BIGINT FROM source_occurrences GROUP BY occurrence_id HAVING count(*) > 1""",
)
def pkg_unique_all(spark, d):
    """Ids of more than one row in the three tables; tasks by question and mode, which batches share."""
    tasks = table(spark, d, "geo_tasks").select(F.concat("question_id", F.lit("|"), "mode_code").alias("task_id"))
    named = lambda rows, key: package.repeated_ids(rows, key).select(F.lit(key).alias("key"), F.col(key).cast("string").alias("id"),
        "row_count")
    return named(tasks, "task_id").unionByName(named(table(spark, d, "geo_answers"), "answer_id")).unionByName(named(table(spark, d,
        "source_occurrences"), "occurrence_id"))


@registry.add("pkg_checksum_rows", "SELECT doc_id, sha256(text) AS sha256 FROM documents WHERE text IS NOT NULL")
def pkg_checksum_rows(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", ids.checksum(F.col("text")).alias("sha256"))


@registry.add(
    "pkg_manifest_counts",
    """SELECT batch_id, coalesce(t, 0)::BIGINT AS task_count, coalesce(a, 0)::BIGINT AS answer_count, m.task_count IS DISTINCT FROM coalesce(t, 0) OR m.answer_count IS DISTINCT FROM coalesce(a, 0) AS differs
FROM geo_manifests m LEFT JOIN (SELECT batch_id, count(*) AS t FROM geo_tasks GROUP BY batch_id) USING (batch_id) LEFT JOIN (SELECT batch_id, count(DISTINCT answer_id) AS a FROM geo_answers GROUP BY batch_id) USING (batch_id)""",
)
def pkg_manifest_counts(spark, d):
    """Counts of the tables against those of the manifests; repeated answers count once."""
    tasks = table(spark, d, "geo_tasks").groupBy("batch_id").agg(F.count(F.lit(1)).alias("t"))
    answers = table(spark, d, "geo_answers").groupBy("batch_id").agg(F.count_distinct("answer_id").alias("a"))
    manifests = table(spark, d, "geo_manifests").select("batch_id", F.col("task_count").alias("mt"), F.col("answer_count").alias("ma"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return manifests.join(tasks, "batch_id", "left").join(answers, "batch_id", "left").select(
        "batch_id", zero("t").alias("task_count"), zero("a").alias("answer_count"),
        (~F.col("mt").eqNullSafe(zero("t")) | ~F.col("ma").eqNullSafe(zero("a"))).alias("differs")
    )



_STRIPPED = r"""[\s\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x1c-\x1f]+"""
_BUSY = "当前访问人数过多，疯狂加服务器中，请稍后再试"


@registry.add(
    "repair_cascade",
    rf"""WITH busy AS (SELECT DISTINCT answer_id, task_id FROM geo_answers WHERE acquisition_status = 'failed')
SELECT t.task_id, CASE WHEN b.task_id IS NOT NULL THEN 'failed' ELSE task_status END AS task_status, CASE WHEN b.task_id IS NOT NULL THEN 'ServiceBusyError' ELSE error_code END AS error_code,
  (SELECT count(*) FROM geo_answers a WHERE a.task_id = t.task_id AND a.answer_id NOT IN (SELECT answer_id FROM busy))::BIGINT AS answers_left,
  (SELECT coalesce(sum(length(a.answer_text_clean)), 0) FROM geo_answers a WHERE a.task_id = t.task_id AND a.answer_id NOT IN (SELECT answer_id FROM busy))::BIGINT AS clean_length
FROM geo_tasks t LEFT JOIN (SELECT DISTINCT task_id FROM busy) b USING (task_id)""",
)
def repair_cascade(spark, d):
    """The repair on a package in which the answers of failed acquisitions read as busy notices; texts are otherwise as landed, cleaned already."""
    raw = F.when(F.col("acquisition_status") == "failed", _BUSY).otherwise(F.col("answer_text_clean"))
    tasks, kept, _ = package.repair(table(spark, d, "geo_tasks"), table(spark, d, "geo_answers").withColumn("answer_text_raw", raw),
        _cited(spark, d))
    left = kept.groupBy("task_id").agg(F.count(F.lit(1)).alias("answers_left"), F.sum(F.length("answer_text_clean")).alias("clean_length"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return tasks.join(left, "task_id", "left").select("task_id", "task_status", "error_code", zero("answers_left"), zero("clean_length"))


def _cited(spark, d):
    """Citations as package sources; every third has its site name already."""
    rows = table(spark, d, "qwen_sources")
    return rows.select(F.col("source_row_id").alias("occurrence_id"), F.col("turn_id").alias("answer_id"),
        F.col("url").alias("source_url_raw"), F.when(F.col("source_row_id") % 3 == 0,
        "known").otherwise(F.when(F.col("source_row_id") % 3 == 1, "")).alias("source_site_name_raw"))


@registry.add(
    "repair_sources",
    rf"""SELECT source_row_id AS occurrence_id, turn_id AS answer_id, CASE WHEN source_row_id % 3 = 0 THEN 'known'
  ELSE nullif(regexp_replace(lower(regexp_extract(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '([^@]*)$', 1)), '(:.*)|^www\.', '', 'g'), '') END AS source_site_name_raw
FROM qwen_sources WHERE turn_id NOT IN (SELECT turn_id FROM qwen_answers WHERE mode = 'research')""",
)
def repair_sources(spark, d):
    """Sources after a repair that drops the research answers: theirs go, missing site names are filled."""
    answers = table(spark, d, "qwen_answers").select(
        F.col("turn_id").alias("answer_id"), F.col("turn_id").alias("task_id"),
        F.when(F.col("mode") == "research", _BUSY).otherwise(F.col("answer")).alias("answer_text_raw"),
        F.col("answer").alias("answer_text_clean"), F.col("mode").alias("mode_code"),
    )
    tasks = answers.select("task_id", F.lit("success").alias("task_status"), F.lit("").alias("error_code"),
        F.lit("").alias("error_message"))
    return package.repair(tasks, answers, _cited(spark, d))[2].select("occurrence_id", "answer_id", "source_site_name_raw")


@registry.add(
    "repair_cleaned",
    """SELECT DISTINCT answer_id, answer_text_clean FROM (""" + CLEAN + """)""",
)
def repair_cleaned(spark, d):
    """Clean texts that a repair makes of raw ones where a package holds none."""
    rows = table(spark, d, "geo_answers").withColumn("answer_text_clean", F.lit(None).cast("string")).withColumn("answer_text_raw",
        F.coalesce("answer_text_raw", F.lit("")))
    none = rows.limit(0).select("answer_id", F.lit("").alias("source_url_raw"), F.lit("").alias("source_site_name_raw"))
    fixed = package.repair(table(spark, d, "geo_tasks"), rows, none)[1]
    return fixed.select("answer_id", F.coalesce("answer_text_clean", F.when(F.col("mode_code") != "quick",
        text.strip(F.col("answer_text_raw"))).otherwise("")).alias("answer_text_clean")).distinct()
