"""A batch from its landed files to metrics and a verified package."""

from __future__ import annotations

import argparse
import json
import sys
import zipfile
from dataclasses import asdict, dataclass, field
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom import __version__
from citeloom import constants as C
from citeloom.config import load_config
from citeloom.operators import citations, mention, metrics, package, row_checks, runs, sentiment
from citeloom.sinks import metrics as metric_sink
from citeloom.sinks import package as sink
from citeloom.sinks.metrics import task_issues
from citeloom.sources import landed

EXIT = {"completed": 0, "failed": 1, "blocked": 2, "error": 3, "partial": 4}


@dataclass
class PipelineResult:
    status: str = "failed"
    analysis_status: str = "not_run"
    counts: dict = field(default_factory=dict)
    package_path: str | None = None
    package_verified: bool = False
    error_type: str | None = None
    error_message: str | None = None
    started_at: str = ""
    finished_at: str = ""


def analyse(items: DataFrame, targets: mention.Targets, classifier: sentiment.Classifier, rules: dict | None = None) -> dict:
    """Details and summaries of one scan of items; the classifier's rows are kept for all summaries (``kept``, to be released)."""
    items = items.persist()
    mentions = mention.mention_detail(items, targets)
    sentiments = sentiment.sentiment_detail(items, targets, classifier, rules).persist()
    summary, tone = mention.mention_summary(mentions, targets), sentiment.sentiment_summary(sentiments, targets)
    cited = citations.dedup(citations.occurrences(items))
    sources, hosts = citations.source_ranks(cited), citations.host_ranks(cited)
    total = citations.scoped(cited).groupBy("scope").agg(F.count(F.lit(1)).alias("total_occurrences"))
    return {
        "kept": [items, sentiments], "source_ranks": sources, "host_ranks": hosts, "mention_detail": mentions, "mention_summary": summary,
        "sentiment_detail": sentiments, "sentiment_summary": tone, "target_metrics": metrics.target_metrics(summary, tone),
        "occurrences": cited, "source_top": citations.top(sources, citations.source_order()),
        "host_top": citations.top(hosts, citations.host_order()),
        "source_metrics": metrics.source_metrics(citations.concentration(sources, citations.source_order()),
        citations.concentration(hosts, citations.host_order(), (), total)),
    }


def export_legacy(items: DataFrame, package_id: str, platform: str, archive: Path) -> list[str]:
    """Write an older package and check it; the faults found."""
    passed = items.where("status = 'pass'")
    answers = package.legacy_answers(passed).withColumn("citation_mapping_available", F.lit(False)).drop("platform")
    sources = package.legacy_sources(passed).withColumnRenamed("source_occurrence_id", "occurrence_id")
    folder = archive.with_suffix("")
    sink.export_legacy_directory(package.legacy_tasks(items), answers, sources,
        {"platform": platform, "package_id": package_id, "created_at": datetime.now().isoformat()}, folder)
    sink.export_archive(folder, archive)
    return verify(items.sparkSession, archive, legacy=True)


def export(items: DataFrame, batch_id: str, platform: str, manifest: dict, archive: Path) -> list[str]:
    """Write a package and check it; the faults found."""
    batch, name = F.lit(batch_id), F.lit(platform)
    passed = items.where("status = 'pass'")
    tables = (package.package_tasks(items, batch, name), package.package_answers(passed, batch, name),
        package.package_sources(passed, batch, name))
    folder = archive.with_suffix("")
    known = {"schema_version": C.PACKAGE_VERSION, "geo_batch_version": C.BATCH_VERSION, "platform_code": platform, "batch_id": batch_id,
        "product_id": "", "product_name": "", "collector_version": __version__}
    sink.export_directory(*tables, known | manifest, folder)
    sink.export_archive(folder, archive)
    return verify(items.sparkSession, archive)


#: Faults that are returned as they are; beyond, all of them go to a file.
LISTED = 100


def _listed(faults: DataFrame, order: list[str], path: Path) -> list[str]:
    """The faults (column ``fault``) in order. Beyond ``LISTED`` all are written to ``path``, a line each, and the list ends with their total."""
    ordered = faults.orderBy(*order).select("fault")
    rows = [r.fault for r in ordered.limit(LISTED + 1).collect()]
    if len(rows) <= LISTED:
        return rows
    total = 0
    with path.open("w", encoding="utf-8") as out:
        for total, r in enumerate(ordered.toLocalIterator(), 1):
            out.write(json.dumps(r.fault, ensure_ascii=False) + "\n")
    return [*rows[:LISTED], f"{total} faults in all, the first {LISTED} are listed here, all in {path}"]


def verify(spark: SparkSession, archive: Path, legacy: bool = False) -> list[str]:
    """All faults of a package archive, in the order of the checks: container, manifest, rows, then keys.

    Of more than ``LISTED`` the first and the total are returned, and all are in ``.faults.jsonl`` beside the archive.
    """
    faults = landed.check_archive(Path(archive))
    if faults:
        return faults
    lines = landed.read_package_lines(spark, str(archive))
    named = package_row_faults(lines, legacy)
    if not legacy:
        tables = landed.package_tables(lines)
        found = package.verify(tables["tasks"], tables["answers"], tables["sources"])
        named = named.unionByName(found.withColumn("fault",
            F.concat("check_name", F.lit(": "), F.coalesce(F.col("subject").cast("string"), F.lit("None")))))
    return _listed(named, ["check_no", "check_name", "subject"], Path(archive).with_suffix(".faults.jsonl"))


def package_row_faults(lines: DataFrame, legacy: bool = False) -> DataFrame:
    """(check_no, check_name, subject, fault): manifest, lines and rows of a package that break their schema, and forbidden fields of raw answers."""
    manifest = lines.where("member = 'manifest.json'").groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("line"))
    found = [(4, manifest.withColumns({"member": F.lit("manifest.json"), "line_no": F.lit(1)}),
        row_checks.LEGACY_MANIFEST if legacy else row_checks.MANIFEST, ())]
    for name, fields in (row_checks.LEGACY_ROWS if legacy else row_checks.PACKAGE_ROWS).items():
        found.append((10, lines.where(F.col("member") == f"{name}.jsonl"), fields,
            C.FORBIDDEN_FIELDS if name == "answers" and not legacy else ()))
    out = None
    for no, rows, fields, forbidden in found:
        told = row_checks.row_faults(rows, "line", fields, ["member", "line_no"], forbidden)
        check = F.when(F.col("fault") == "no JSON", 9).when(F.col("fault") == "forbidden", 15).otherwise(no)
        subject = F.format_string("%s, line %08d", "member", "line_no")
        text = F.concat_ws(" ", F.concat(F.format_string("%s, line %d", "member", "line_no"), F.lit(":")), F.nullif("field", F.lit("")),
            "fault")
        told = told.select(check.alias("check_no"), F.lit("row").alias("check_name"), subject.alias("subject"), text.alias("fault"))
        out = told if out is None else out.unionByName(told)
    return out


def merge_batches(spark: SparkSession, batch_dir: str, more: str) -> dict:
    """Bring the results of a later run into a batch's summary: rows of the same task are replaced in place, new ones follow. The new summary's header.

    ``more`` is the later summary. Rows are streamed into the file, which replaces the old one when complete.
    """
    path = Path(batch_dir) / "batch_summary.json"
    old, new = (landed.read_results(spark, str(p)).withColumnRenamed("item_pos", "pos") for p in (path, more))
    merged = runs.upsert(old, new, ["question_id", "mode"])
    counts = runs.with_gates(runs.status_counts(merged)).first().asDict()
    head = json.loads(path.read_text(encoding="utf-8"))
    head = {k: v for k, v in head.items() if k != "task_results"} | {k: counts[k] for k in ("planned_count", "executed_count", "pass_count",
        "fail_count", "blocked_count", "pending_count")}
    head |= {"status": counts["batch_status"], "finished_at": datetime.now().isoformat()}
    partial = path.with_suffix(".partial")
    with partial.open("w", encoding="utf-8") as out:
        out.write(json.dumps(head, ensure_ascii=False)[:-1] + ', "task_results": [')
        for n, row in enumerate(merged.orderBy("added", "pos").drop("added", "pos").toLocalIterator()):
            out.write((",\n" if n else "\n") + json.dumps(row.asDict(), ensure_ascii=False))
        out.write("\n]}")
    partial.replace(path)
    return head


def pending_tasks(spark: SparkSession, tasks: str, batch_dir: str) -> DataFrame:
    """Tasks of a CSV file that a resumed run has still to do: those without a passed result."""
    return runs.pending_tasks(landed.read_tasks(spark, tasks),
        landed.read_results(spark, f"{batch_dir}/batch_summary.json", permissive=True), ["question_id", "mode"])


def repair_archive(spark: SparkSession, archive: Path, repaired: Path) -> list[str]:
    """Write a repaired copy of an archive, counts and checksums anew; the faults left in it."""
    with zipfile.ZipFile(archive) as z:
        manifest = json.loads(z.read("manifest.json"))
    tables = landed.package_tables(landed.read_package_lines(spark, str(archive)))
    fixed = package.repair(*(tables[n].drop("path") for n in ("tasks", "answers", "sources")))
    folder = repaired.with_suffix("")
    sink.export_directory(*fixed, manifest, folder)
    sink.export_archive(folder, repaired)
    left = package.source_count_mismatches(fixed[1], fixed[2])
    named = left.withColumn("fault", F.concat(F.lit("source_count_raw of "), F.coalesce(F.col("answer_id").cast("string"), F.lit("None"))))
    return verify(spark, repaired) + _listed(named, ["answer_id"], repaired.with_suffix(".counts.jsonl"))


def run(spark: SparkSession, batch_dir: str, batch_id: str, platform: str, archive: str, targets: mention.Targets | None = None,
    classifier: sentiment.Classifier | None = None, manifest: dict | None = None, rules: dict | None = None) -> PipelineResult:
    """The gate decides: blocked and partial batches end there; analysis errors leave a package and a partial status.

    Without a classifier that of the environment's settings is taken; without rules the usual ones hold for every target. Metrics, task issues and the result are written beside the batch.
    """
    result = PipelineResult(started_at=datetime.now().isoformat())
    try:
        results = landed.read_results(spark, f"{batch_dir}/batch_summary.json")
        counts = runs.with_gates(runs.status_counts(results)).first().asDict()
        result.counts = counts
        result.status = counts["gate_status"]
        if not counts["can_export"]:
            return result
        items = landed.analysis_items(results, landed.read_answers(spark,
            f"{batch_dir}/*_*.json").where("file_name <> 'batch_summary.json'"))
        errors = 0
        if targets:
            result.analysis_status = "failed"
            rules = {t: C.NEGATIVE_RULES for t in targets} if rules is None else rules
            found = analyse(items, targets, classifier or load_config().classifier(), rules)
            for name in ("target_metrics", "source_metrics", "source_top", "host_top", "sentiment_detail", "mention_detail", "occurrences"):
                found[name].write.mode("overwrite").options(ignoreNullFields="false",
                    **sink.EXACT_TIMES).json(f"{batch_dir}/analysis/{name}")
            write_metric_documents(found, targets, Path(batch_dir) / "analysis" / "metrics.json")
            errors = sentiment.error_count(found["sentiment_detail"]).first().error_count
            for kept in found["kept"]:
                kept.unpersist()
            result.analysis_status = "completed_with_warnings" if errors else "completed"
        task_issues(results).coalesce(1).write.mode("overwrite").json(f"{batch_dir}/issues")
        faults = export(items, batch_id, platform, manifest or {}, Path(archive))
        if faults:
            raise ValueError("; ".join(faults))
        result.package_path, result.package_verified = archive, True
        result.status = "partial" if errors else "completed"
    except Exception as error:  # noqa: BLE001 - the result tells
        result.status, result.error_type, result.error_message = "failed", type(error).__name__, str(error)[:2000]
    finally:
        result.finished_at = datetime.now().isoformat()
    write_result(result, Path(batch_dir) / "pipeline-result.json")
    return result


def write_metric_documents(found: dict, targets: mention.Targets, path: Path) -> None:
    """One document with all metrics, read again to be sure that it is whole."""
    cited = found["occurrences"]
    total = citations.scoped(cited).groupBy("scope").agg(F.count(F.lit(1)).alias("total_occurrences"))
    sources = citations.concentration(found["source_ranks"], citations.source_order())
    hosts = citations.concentration(found["host_ranks"], citations.host_order(), (), total)
    documents = (
        metric_sink.mention_metrics(found["mention_summary"]), metric_sink.sentiment_metrics(found["sentiment_summary"], list(targets)),
        metric_sink.source_metrics(sources, hosts, found["source_top"], found["host_top"]),
    )
    metric_sink.write_metrics(*documents, path)
    again = json.loads(path.read_text(encoding="utf-8"))
    if set(again["mention"]) != set(targets) or set(again["sentiment"]) != set(targets):
        raise ValueError(f"{path} does not hold every target")


def write_result(result: PipelineResult, path: Path) -> None:
    """The result as JSON, written and read again."""
    if path.parent.is_dir():
        sink.write_json(asdict(result), path)
        if json.loads(path.read_text(encoding="utf-8"))["status"] != result.status:
            raise ValueError(f"{path} was not written whole")


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="citeloom", description=__doc__)
    parser.add_argument("action", choices=["run", "verify", "repair", "export", "merge"])
    parser.add_argument("path", help="a batch folder, or a package archive to verify or repair")
    parser.add_argument("--batch-id", default="batch_0001")
    parser.add_argument("--platform", default="assistant")
    parser.add_argument("--archive")
    parser.add_argument("--more", help="the summary of a later run, to merge")
    parser.add_argument("--legacy", action="store_true", help="the older package")
    parser.add_argument("--target", action="append", default=[], help="id=alias,alias of a target to analyse, or an id with --alias")
    parser.add_argument("--alias", action="append", default=[])
    try:
        given = parser.parse_args(arguments)
        named = {t.partition("=")[0]: [a for a in t.partition("=")[2].split(",") if a] or given.alias for t in given.target}
        targets = mention.build_targets(named) if named else None
        if given.action == "merge" and not given.more:
            raise ValueError("merge needs --more")
        classifier = load_config().classifier() if targets else None
    except (SystemExit, ValueError) as error:
        if isinstance(error, ValueError):
            print(error, file=sys.stderr)
        return EXIT["error"]
    from citeloom.session import local_session

    spark, told = local_session(), lambda value: print(json.dumps(value, ensure_ascii=False, default=str))
    archive = Path(given.archive or f"{given.path}/{given.batch_id}.zip")
    if given.action in ("verify", "repair", "export"):
        source = Path(given.path)
        if given.action == "verify":
            faults = verify(spark, source, given.legacy)
        elif given.action == "repair":
            faults = repair_archive(spark, source,
                Path(given.archive) if given.archive else source.with_name(f"{source.stem}_repaired.zip"))
        else:
            results = landed.read_results(spark, f"{given.path}/batch_summary.json")
            items = landed.analysis_items(results,
                landed.read_answers(spark, f"{given.path}/*_*.json").where("file_name <> 'batch_summary.json'"))
            faults = export_legacy(items, given.batch_id, given.platform, archive) if given.legacy else export(items, given.batch_id,
                given.platform, {}, archive)
        told(faults)
        return EXIT["failed" if faults else "completed"]
    if given.action == "merge":
        head = merge_batches(spark, given.path, given.more)
        told(head)
        return EXIT[head["status"]]
    result = run(spark, given.path, given.batch_id, given.platform, str(archive), targets, classifier)
    told(asdict(result))
    return EXIT[result.status]


if __name__ == "__main__":
    sys.exit(main())
