"""Queries that land rows in the files of a batch and read them back: what the readers give is what was written."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from citeloom import schemas
from citeloom.plans.packages import package_source_rows, results
from citeloom.plans.registry import Registry
from citeloom.session import shared_folder
from citeloom.sinks.package import EXACT_TIMES
from citeloom.sources import landed
from citeloom.sources.tables import table
from citeloom.streaming import ingest

registry = Registry()


def _fresh(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_TASKS = """SELECT batch_id || '/' || question_id AS question_id, question, CASE mode_code WHEN 'expert' THEN 'research' ELSE mode_code END AS mode FROM geo_tasks"""


@registry.add("land_tasks", _TASKS)
def land_tasks(spark, d):
    """Task files with a header, quotes and line feeds."""
    rows = results(spark, d).select(F.concat(F.lit(" "), "batch_id", F.lit("/"), "question_id").alias("question_id"), "question", "mode",
        F.lit("x").alias("more"))
    folder = _fresh(spark, "tasks")
    rows.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(folder)
    return landed.read_tasks(spark, folder).drop("item_pos")


@registry.add(
    "land_answers",
    """WITH a AS (SELECT * FROM (SELECT DISTINCT * FROM qwen_answers WHERE question_id IS NOT NULL AND answer IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY question_id, mode ORDER BY acquired_at DESC, turn_id DESC) = 1)
SELECT turn_id, question_id, mode, question, answer, acquired_at, coalesce(len(search_queries), -1)::INTEGER AS queries,
  (SELECT count(*) FROM qwen_sources s WHERE s.turn_id = a.turn_id)::INTEGER AS citations FROM a""",
)
def land_answers(spark, d):
    """Nested answers as JSON lines, with blank lines between them."""
    folder = _fresh(spark, "answers")
    package_source_rows(spark, d).select(F.concat(F.to_json(F.struct("*"), EXACT_TIMES), F.lit("\n")).alias("value")).write.text(folder)
    rows = landed.read_json_lines(spark, folder, schemas.ANSWER)
    return rows.select("turn_id", "question_id", "mode", "question", "answer", "acquired_at",
        F.coalesce(F.size("search_queries"), F.lit(-1)).alias("queries"), F.size("sources").alias("citations"))


_PLACED = """WITH result AS (SELECT batch_id, question_id, question, CASE mode_code WHEN 'expert' THEN 'research' ELSE mode_code END AS mode, error_code AS error_type,
  CASE WHEN task_status = 'success' THEN 'pass' WHEN task_status = 'running' THEN 'pending' WHEN regexp_matches(error_code, '(RiskControl|Quota)Error$') THEN 'blocked' ELSE 'fail' END AS status,
  row_number() OVER (PARTITION BY batch_id ORDER BY question_id, mode_code) - 1 AS pos FROM geo_tasks)
"""


def _summaries(spark, d, planted):
    """Batch summaries, a JSON object per file; a batch's tasks are few. Every fifth row is spoilt where ``planted``."""
    order = F.when(F.col("mode") == "research", "expert").otherwise(F.col("mode"))
    rows = results(spark, d).select("batch_id", F.struct("question_id", order.alias("_o"), "mode", "question", "status",
        "error_type").alias("r"))
    batches = rows.groupBy("batch_id").agg(F.array_sort(F.collect_list("r")).alias("task_results"))
    each = F.transform("task_results", lambda r, i: F.when(F.lit(planted) & (i % 5 == 4),
        F.lit('{"status": "pass"}')).when(F.lit(planted) & (i % 5 == 3), F.lit('"x"')).otherwise(F.to_json(r.dropFields("_o"))))
    folder = _fresh(spark, "summaries")
    batches.select("batch_id", F.concat(F.lit('{"platform": "p",\n"task_results": ['), F.array_join(each, ",\n"),
        F.lit("]}")).alias("value")).repartition("batch_id").write.partitionBy("batch_id").text(folder)
    return folder


@registry.add("land_results", _PLACED + "SELECT pos::INTEGER AS item_pos, question_id, mode, question, status, error_type FROM result")
def land_results(spark, d):
    """Task results of summaries, in their order."""
    rows = landed.read_results(spark, f"{_summaries(spark, d, False)}/*")
    return rows.select("item_pos", "question_id", "mode", "question", "status", "error_type")


@registry.add("land_results_permissive",
    _PLACED + "SELECT pos::INTEGER AS item_pos, question_id, mode, question, status, error_type FROM result WHERE pos % 5 < 3")
def land_results_permissive(spark, d):
    """Task results of summaries in which rows are spoilt: only those rows are left out."""
    rows = landed.read_results(spark, f"{_summaries(spark, d, True)}/*", permissive=True)
    return rows.select("item_pos", "question_id", "mode", "question", "status", "error_type")


@registry.add(
    "land_items",
    """SELECT turn_id, question_id, mode, CASE WHEN answer IS NULL THEN 'fail' ELSE 'pass' END AS status, answer FROM (SELECT DISTINCT turn_id, question_id, mode, answer FROM qwen_answers)""",
)
def land_items(spark, d):
    """Results with the answer file that their path names, whatever the separators of the path."""
    rows = table(spark, d, "qwen_answers").select("turn_id", "question_id", "mode", "question", "answer").distinct()
    status = F.when(F.col("answer").isNull(), "fail").otherwise("pass")
    path = F.concat(F.when(F.length("question") % 2 == 0, "C:\\out\\").otherwise("/out/"), "turn_id", F.lit(".json"))
    none = F.lit(None).cast("string")
    given = rows.select(F.monotonically_increasing_id().alias("item_pos"), "question_id", "mode", "question", status.alias("status"),
        path.alias("output_path"), F.col("turn_id").alias("task"))
    answers = rows.where("answer IS NOT NULL").select(
        F.concat("turn_id", F.lit(".json")).alias("file_name"), "question_id", "mode", "answer", "turn_id", none.alias("chat_url"),
        none.alias("mode_label"), none.alias("platform"), F.array().cast("array<string>").alias("search_queries"),
        F.array().cast(f"array<{schemas.SOURCE}>").alias("sources"), F.lit(False).alias("citation_mapping_available"),
        F.lit(None).cast("timestamp_ntz").alias("acquired_at"),
    )
    return landed.analysis_items(given, answers).select(F.col("task").alias("turn_id"), "question_id", "mode", "status", "answer")


@registry.add("land_package_rows",
    "SELECT task_id, question_id, question, mode_code, task_status, error_code, error_message FROM geo_tasks")
def land_package_rows(spark, d):
    """Task rows of package lines."""
    names = ("task_id", "question_id", "question", "mode_code", "task_status", "error_code", "error_message")
    lines = table(spark, d, "geo_tasks").select(F.lit("p").alias("path"), F.lit("tasks.jsonl").alias("member"),
        F.to_json(F.struct(*names)).alias("line"))
    return landed.package_tables(lines)["tasks"].select(*names)


@registry.add("land_passed_keys",
    _PLACED + "SELECT DISTINCT question_id, mode FROM result WHERE status = 'pass' AND question_id IS NOT NULL AND mode IS NOT NULL")
def land_passed_keys(spark, d):
    return landed.passed_keys(results(spark, d))


@registry.add("stream_upsert",
    "SELECT occurrence_id, arg_max(url, (landed_at, url)) AS url, max(landed_at) AS landed_at FROM source_occurrences GROUP BY occurrence_id")
def stream_upsert(spark, d):
    """Occurrences that land as JSON lines, merged by a stream in several micro-batches."""
    landing, merged, seen = (_fresh(spark, n) for n in ("in", "merged", "seen"))
    table(spark, d, "source_occurrences").select("occurrence_id", "url",
        "landed_at").repartition(4).write.options(**EXACT_TIMES).json(landing)
    kind = spark.read.json(landing).schema["occurrence_id"].dataType.simpleString()
    stream = ingest.landed_stream(spark, landing, f"occurrence_id {kind}, url string, landed_at timestamp_ntz", 2)
    ingest.upsert_stream(stream, merged, seen, ["occurrence_id"], ["landed_at", "url"])
    return ingest.read_upserted(spark, merged, ["occurrence_id"], ["landed_at", "url"])
