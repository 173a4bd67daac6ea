"""Readers of landed records: task CSV, batch summaries, answer files, JSON lines, package archives."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom import constants as C
from citeloom import schemas
from citeloom.functions import text
from citeloom.operators import runs


def read_tasks(spark: SparkSession, path: str) -> DataFrame:
    """Tasks of a CSV file with a header (a byte order mark is fine), in the order of its rows.

    Columns beyond the three are ignored. Missing columns, no rows, blank values, unknown modes and
    repeated keys are errors; the table of violations says which.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    columns = reader.csv(path).columns
    missing = sorted({"question_id", "question", "mode"} - set(columns))
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    rows = reader.csv(path).select("question_id", "question", "mode")
    if rows.isEmpty():
        raise ValueError(f"{path} has no rows")
    wrong = runs.task_violations(rows).limit(20).collect()
    if wrong:
        raise ValueError(f"{path}: " + "; ".join(f"{r.violation} in ({r.question_id}, {r['mode']})" for r in wrong))
    # A task file is read by one task, so ids ascend with its rows.
    return rows.select(text.strip(F.col("question_id")).alias("question_id"), text.strip(F.col("question")).alias("question"), "mode",
        F.monotonically_increasing_id().alias("item_pos"))


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """Batch summaries, one JSON object per file; a malformed file is an error."""
    return spark.read.schema(schemas.BATCH_SUMMARY).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """Answers, one JSON object per file, with ``file_name``; a malformed file is an error."""
    rows = spark.read.schema(schemas.ANSWER).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return rows.select("*", F.col("_metadata.file_name").alias("file_name"))


def read_results(spark: SparkSession, path: str, permissive: bool = False) -> DataFrame:
    """Task results of batch summaries with item_pos; ``permissive`` leaves out malformed files and, one by one, rows that are no task results."""
    if not permissive:
        return read_summaries(spark, path).select(F.posexplode("task_results").alias("item_pos", "r")).select("item_pos", "r.*")
    texts = spark.read.text(path, wholetext=True)
    rows = texts.select(F.try_variant_get(F.try_parse_json("value"), "$.task_results", "array<variant>").alias("rows"))
    kind = schemas.TASK_RESULT
    each = rows.select(F.posexplode("rows").alias("item_pos", "v")).select("item_pos", F.from_json(F.to_json("v"), kind).alias("r"),
        F.schema_of_variant("v").alias("kind"))
    known = F.col("kind").startswith("OBJECT") & F.col("r.question_id").isNotNull() & F.col("r.mode").isin(*C.MODES) & F.col("r.status").isNotNull()
    return each.where(known).select("item_pos", "r.*")


def passed_keys(results: DataFrame) -> DataFrame:
    return results.where("status = 'pass' AND question_id IS NOT NULL AND mode IS NOT NULL").select("question_id", "mode").distinct()


def analysis_items(results: DataFrame, answers: DataFrame) -> DataFrame:
    """Results with their answer: passed ones need the file their output_path names, others have none.

    An answer's own question_id and mode must be the task's.
    """
    own = answers.select(
        F.col("file_name"), F.col("question_id").alias("_q"), F.col("mode").alias("_m"), "answer", "turn_id", "chat_url", "mode_label",
        "platform", "search_queries", "sources", "citation_mapping_available", "acquired_at"
    )
    named = results.withColumn("file_name", F.when(F.col("status") == "pass", F.element_at(F.split("output_path", r"[/\\]"), -1)))
    joined = named.join(own, "file_name", "left")
    passed = F.col("status") == "pass"
    fault = (
        F.when(passed & F.col("file_name").isNull(), "has no output path").when(passed & F.col("_q").isNull() & F.col("_m").isNull(),
        "has no answer file")
        .when(passed & ~(F.col("_q").eqNullSafe(F.col("question_id")) & F.col("_m").eqNullSafe(F.col("mode"))),
        "has the answer of another task")
    )
    sure = F.when(fault.isNotNull(), F.raise_error(F.concat_ws(" ", F.lit("task"), "question_id", "mode",
        fault)).cast("string")).otherwise(F.col("question_id"))
    return joined.withColumn("question_id", sure).drop("_q", "_m", "file_name")


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank lines and a byte order mark are skipped, a malformed line is an error with its file and text."""
    lines = spark.read.text(path).select(F.regexp_replace("value", "^﻿", "").alias("line"),
        F.col("_metadata.file_path").alias("file")).where(F.trim("line") != "")
    parsed = lines.select("line", "file", F.from_json("line", schema, {"mode": "PERMISSIVE"}).alias("r"),
        F.try_parse_json("line").alias("v"))
    sure = F.when(F.col("v").isNull(), F.raise_error(F.concat(F.lit("no JSON: "), F.substring("line", 1, 200), F.lit(" in "),
        F.col("file")))).otherwise(F.col("r"))
    return parsed.select(sure.alias("r")).select("r.*")


def newest_package(spark: SparkSession, folder: str) -> str | None:
    """The newest archive of a folder that is no repaired one and no copy from before a repair."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder).select("path", "modificationTime")
    plain = files.where(~F.col("path").rlike(r"(_repaired|_before_repair)\.zip$"))
    return plain.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("p")).first().p


#: Lines of an archive that are handed on at once.
LINES = 10_000


def _lines(archive: zipfile.ZipFile, name: str) -> Iterator[tuple[int, str]]:
    """Lines that are not blank, with their numbers; a byte order mark is skipped, broken UTF-8 is replaced."""
    with archive.open(name) as member:
        for n, line in enumerate(io.TextIOWrapper(member, "utf-8-sig", "replace", newline="\n"), 1):
            if line.strip():
                yield n, line.removesuffix("\n")


def read_package_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, member, line_no, line) of package archives, one task per archive."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for p, content in zip(b["path"], b["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for name in archive.namelist():
                        kept: list[tuple] = []
                        for n, line in _lines(archive, name):
                            kept.append((p, name, n, line))
                            if len(kept) == LINES:
                                yield pd.DataFrame(kept, columns=["path", "member", "line_no", "line"])
                                kept = []
                        yield pd.DataFrame(kept, columns=["path", "member", "line_no", "line"])

    return files.mapInPandas(members, "path string, member string, line_no int, line string")


def package_tables(lines: DataFrame) -> dict[str, DataFrame]:
    """tasks, answers and sources of package lines, with the archive's path."""
    out = {}
    for name, schema in (("tasks", schemas.PACKAGE_TASK), ("answers", schemas.PACKAGE_ANSWER), ("sources", schemas.PACKAGE_SOURCE)):
        parsed = lines.where(F.col("member") == f"{name}.jsonl").select("path", F.from_json("line", schema).alias("r"))
        out[name] = parsed.select("path", "r.*")
    return out


def check_archive(archive: bytes | str | Path) -> list[str]:
    """Faults of one archive in the order of the checks, before its rows are looked at.

    Members run through in chunks, so neither the archive (where a path is given) nor a member is
    held as a whole.
    """
    import hashlib

    if not isinstance(archive, bytes) and not Path(archive).exists():
        return ["there is no such file"]
    source = io.BytesIO(archive) if isinstance(archive, bytes) else archive
    if not zipfile.is_zipfile(source):
        return ["it is no ZIP archive"]
    faults = []
    with zipfile.ZipFile(source) as z:
        names = set(z.namelist())
        if names != set(C.PACKAGE_FILES):
            return [f"members missing: {sorted(set(C.PACKAGE_FILES) - names)}, beyond: {sorted(names - set(C.PACKAGE_FILES))}"]
        try:
            manifest = json.loads(z.read("manifest.json"))
        except ValueError:
            return ["the manifest is no JSON"]
        if not isinstance(manifest, dict):
            return ["the manifest is no object"]
        if set(manifest.get("files") or ()) != set(C.PACKAGE_FILES):
            faults.append("the manifest lists other files")
        try:
            sums = json.loads(z.read("checksums.json"))
        except ValueError:
            return [*faults, "the checksums are no JSON"]
        sums = sums.get("files", sums) if isinstance(sums, dict) else {}
        hashed = set(C.PACKAGE_FILES) - {"checksums.json"}
        if set(sums) != hashed:
            faults.append("checksums of other files")
        for name in sorted(hashed & set(sums)):
            digest = hashlib.sha256()
            with z.open(name) as member:
                while chunk := member.read(1 << 20):
                    digest.update(chunk)
            if sums[name] != digest.hexdigest():
                faults.append(f"checksum of {name}")
        for name in ("tasks", "answers", "sources"):
            if manifest.get(f"{name[:-1]}_count") != sum(1 for _ in _lines(z, f"{name}.jsonl")):
                faults.append(f"{name[:-1]}_count")
    return faults
