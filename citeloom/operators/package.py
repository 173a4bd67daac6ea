"""The relational package: tasks, answers and sources, their checks and repair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citeloom import constants as C
from citeloom.functions import ids, text, urls


def _recoded(c: Column, table: dict[str, str], what: str) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for old, new in table.items():
        out = out.when(c == old, new)
    return out.otherwise(F.raise_error(F.concat(F.lit(f"no {what} like "), F.coalesce(c, F.lit("null")))))


def package_mode(mode: Column) -> Column:
    return _recoded(mode, C.PACKAGE_MODE, "mode")


def package_status(status: Column) -> Column:
    return _recoded(status, C.PACKAGE_STATUS, "task status")


def package_tasks(results: DataFrame, batch_id: Column, platform: Column) -> DataFrame:
    """Task rows of all results; an unknown mode or status is an error."""
    return results.select(
        ids.task_id(platform, batch_id, F.col("question_id"), F.col("mode")).alias("task_id"), "question_id", "question",
        package_mode(F.col("mode")).alias("mode_code"),
        package_status(F.col("status")).alias("task_status"), F.col("error_type").alias("error_code"), "error_message",
    )


def package_answers(answers: DataFrame, batch_id: Column, platform: Column) -> DataFrame:
    """Answer rows; a null question_id is an error."""
    task = ids.task_id(platform, batch_id, F.col("question_id"), F.col("mode"))
    clean = text.clean_answer(F.col("answer"), F.col("mode"))
    meta = F.to_json(
        F.struct(F.col("mode").alias("original_mode"), "mode_label", "turn_id", "chat_url", "search_queries", "citation_mapping_available"),
        {"ignoreNullFields": "false"}
    )
    rows = answers.withColumns({"task_id": task, "answer_text_clean": clean})
    return rows.select(
        ids.answer_id(platform, F.col("task_id")).alias("answer_id"), "task_id", "question_id",
        package_mode(F.col("mode")).alias("mode_code"), F.col("question").alias("question_text"),
        F.col("answer").alias("answer_text_raw"), "answer_text_clean", F.lit("success").alias("acquisition_status"),
        F.lit("PASS").alias("validation_status"),
        (F.length("answer_text_clean") > 0).alias("is_complete"), F.lit("success").alias("source_collection_status"),
        F.coalesce(F.size("sources"), F.lit(0)).cast("bigint").alias("source_count_raw"),
        F.lit(None).cast("string").alias("screenshot_path"), F.col("acquired_at").alias("collected_at"),
        meta.alias("platform_meta_json"),
    )


def package_sources(answers: DataFrame, batch_id: Column, platform: Column) -> DataFrame:
    """Source rows in landed order with the flag of repeated urls in an answer; a blank url is an error."""
    task = ids.task_id(platform, batch_id, F.col("question_id"), F.col("mode"))
    flat = answers.select(ids.answer_id(platform, task).alias("answer_id"), F.posexplode("sources").alias("pos", "s"))
    url = text.strip(F.col("s.url"))
    rows = flat.select(
        "answer_id", "pos", F.col("s.rank").alias("source_order"), F.col("s.title").alias("source_title_raw"),
        F.when(F.coalesce(url, F.lit("")) != "", url).otherwise(F.raise_error(F.lit("a source has no url"))).alias("source_url_raw"),
    )
    seen = F.row_number().over(Window.partitionBy("answer_id", "source_url_raw").orderBy("pos"))
    return rows.withColumn("is_duplicate_in_answer", seen > 1).select(
        ids.source_id(platform, F.col("answer_id"), F.col("source_order"), F.col("source_url_raw")).alias("occurrence_id"), "answer_id",
        "source_order", "source_title_raw",
        urls.site_name(F.col("source_url_raw")).alias("source_site_name_raw"), "source_url_raw",
        F.lit(None).cast("string").alias("source_snippet"), "is_duplicate_in_answer",
    )


def legacy_tasks(results: DataFrame) -> DataFrame:
    return results.select("question_id", "mode", "question", "status", "error_type", "error_message")


def legacy_answers(answers: DataFrame) -> DataFrame:
    known = F.when(F.col("question_id").isNotNull(), F.col("question_id")).otherwise(F.raise_error(F.lit("an answer has no question_id")))
    return answers.select(known.alias("question_id"), "mode", "platform", "question", "answer", "turn_id", "chat_url", "mode_label",
        "search_queries", "acquired_at")


def legacy_sources(answers: DataFrame) -> DataFrame:
    """Source rows of the older package; repeated ones stay."""
    rows = answers.select("question_id", "mode", F.explode("sources").alias("s"))
    return rows.select(
        ids.legacy_source_id(F.col("question_id"), F.col("mode"), F.col("s.rank"), F.col("s.url")).alias("source_occurrence_id"),
        "question_id", "mode", F.col("s.rank").alias("rank"),
        F.col("s.title").alias("title"), F.col("s.url").alias("url"),
    )


# --- checks: each gives the offending keys; an empty result passes -------------------------------


def orphans(child: DataFrame, parent: DataFrame, key: str, row_id: str) -> DataFrame:
    """Child rows whose key no parent has."""
    return child.join(parent.select(key).distinct(), key, "left_anti").select(row_id, key)


def repeated_ids(rows: DataFrame, row_id: str) -> DataFrame:
    """Ids of more than one row, with their number."""
    return rows.groupBy(row_id).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def source_count_mismatches(answers: DataFrame, sources: DataFrame) -> DataFrame:
    """Answers whose recorded number of sources is another than they have."""
    counts = sources.groupBy("answer_id").agg(F.count(F.lit(1)).alias("source_count"))
    found = F.coalesce("source_count", F.lit(0))
    return answers.join(counts, "answer_id", "left").where(~F.col("source_count_raw").eqNullSafe(found)).select("answer_id",
        "source_count_raw", found.alias("source_count"))


def forbidden_fields(rows: DataFrame, row_id: str, json_column: str, forbidden: Sequence[str] = C.FORBIDDEN_FIELDS) -> DataFrame:
    """(row_id, field) of JSON objects with a forbidden key, and (row_id, '(no object)') of what is no object."""
    keys = F.json_object_keys(json_column)
    bad = F.when(keys.isNull(), F.array(F.lit("(no object)"))).otherwise(F.array_intersect(keys, F.array(*[F.lit(f) for f in forbidden])))
    return rows.where(F.col(json_column).isNotNull()).select(row_id, F.explode(bad).alias("field"))


def verify(tasks: DataFrame, answers: DataFrame, sources: DataFrame, counts: dict[str, int] | None = None) -> DataFrame:
    """(check_no, check_name, subject) of every violation, numbered in the order of the checks."""

    def named(no: int, name: str, rows: DataFrame, key: str) -> DataFrame:
        return rows.select(F.lit(no).alias("check_no"), F.lit(name).alias("check_name"), F.col(key).cast("string").alias("subject"))

    found = [
        named(12, "unique task_id", repeated_ids(tasks, "task_id"), "task_id"),
        named(12, "unique answer_id", repeated_ids(answers, "answer_id"), "answer_id"),
        named(12, "unique occurrence_id", repeated_ids(sources, "occurrence_id"), "occurrence_id"),
        named(13, "task of answer", orphans(answers, tasks, "task_id", "answer_id"), "answer_id"),
        named(14, "answer of source", orphans(sources, answers, "answer_id", "occurrence_id"), "occurrence_id"),
        named(15, "forbidden field", forbidden_fields(answers, "answer_id", "platform_meta_json"), "answer_id"),
    ]
    for name, rows in (("task_count", tasks), ("answer_count", answers), ("source_count", sources)) if counts else ():
        found.append(named(11, name, rows.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") != counts[name]), "n"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def repair(tasks: DataFrame, answers: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tables without answers that are notices of a busy service.

    Their tasks become failed, their sources go; quick answers are cleaned again and missing site
    names filled from the url.
    """
    busy = answers.where(text.is_busy(F.col("answer_text_raw"))).select("answer_id", "task_id")
    lost = busy.select("task_id").distinct().withColumn("_lost", F.lit(True))
    marked = tasks.join(lost, "task_id", "left")
    gone = F.coalesce("_lost", F.lit(False))
    tasks_out = marked.withColumns(
        {
            "task_status": F.when(gone, "failed").otherwise(F.col("task_status")),
            "error_code": F.when(gone, "ServiceBusyError").otherwise(F.col("error_code")),
            "error_message": F.when(gone, "The service returned a temporary busy message.").otherwise(F.col("error_message")),
        }
    ).select(*tasks.columns)
    kept = answers.join(busy.select("answer_id").distinct(), "answer_id", "left_anti").select(*answers.columns)
    raw = F.coalesce(F.nullif(F.col("answer_text_raw"), F.lit("")), F.col("answer_text_clean"), F.lit(""))
    again = text.clean_answer(raw, F.lit("quick"))
    differs = again != text.strip(F.coalesce("answer_text_clean", F.lit("")))
    answers_out = kept.withColumn("answer_text_clean",
        F.when((F.col("mode_code") == "quick") & differs, again).otherwise(F.col("answer_text_clean")))
    sources_out = sources.join(busy.select("answer_id").distinct(), "answer_id", "left_anti").withColumn(
        "source_site_name_raw", F.coalesce(F.nullif(F.col("source_site_name_raw"), F.lit("")), urls.site_name(F.col("source_url_raw")))
    ).select(*sources.columns)
    return tasks_out, answers_out, sources_out
