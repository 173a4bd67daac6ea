"""Row schemas, older packages, merges of runs, and parts that the driver cannot see."""

from __future__ import annotations

import json
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from citeloom import constants as C
from citeloom import pipeline
from citeloom.operators import row_checks, sentiment
from citeloom.sinks import package as sink
from citeloom.sources import landed
from tests.test_pipeline import batch


def faults(spark, lines, fields, forbidden=()):
    rows = spark.createDataFrame(list(enumerate(lines)), "n int, line string")
    return sorted((r.n, r.field, r.fault) for r in row_checks.row_faults(rows, "line", fields, ["n"], forbidden).collect())


def test_row_faults(spark):
    fields = (row_checks.Field("s"), row_checks.Field("i", "int", least=1), row_checks.Field("b", "bool", required=False), row_checks.Field("t", "time", nullable=True), row_checks.Field("e", allowed=("x",), required=False), row_checks.Field("o", "object", required=False), row_checks.Field("l", "strings", required=False))
    whole = {"s": "a", "i": 1, "b": True, "t": "2026-01-02T03:04:05", "e": "x", "o": {"k": 1}, "l": ["a"], "more": 1}
    lines = [json.dumps(whole), json.dumps(whole | {"t": None, "i": "2", "l": []})]
    assert faults(spark, [*lines, None], fields) == []
    bad = [{"s": 1}, {"s": None}, {"i": 0}, {"i": 1.5}, {"i": "x"}, {"b": "true?"}, {"t": "soon"}, {"e": "y"}, {"o": []}, {"l": [1]}]
    want = [("s", "type"), ("s", "null"), ("i", "value"), ("i", "type"), ("i", "type"), ("b", "type"), ("t", "type"), ("e", "value"), ("o", "type"), ("l", "type")]
    assert faults(spark, [json.dumps(whole | b) for b in bad], fields) == [(n, *w) for n, w in enumerate(want)]
    assert faults(spark, ["{", "[]", '"x"', lines[0] + "}", lines[0] + "," + lines[0], ""], fields) == [(0, "", "no JSON"), (1, "", "no object"), (2, "", "no object"), (3, "", "no JSON"), (4, "", "no JSON"), (5, "", "no JSON")]
    assert faults(spark, ['{"metrics": null, "s": "a"}'], (row_checks.Field("s"), row_checks.Field("i", "int")), C.FORBIDDEN_FIELDS) == [(0, "i", "missing"), (0, "metrics", "forbidden")]
    assert faults(spark, [], fields) == []


def made(spark, tmp_path, **kwargs):
    folder = tmp_path / "batch"
    folder.mkdir()
    result = pipeline.run(spark, str(batch(folder)), "b", "p", str(tmp_path / "b.zip"), **kwargs)
    assert result.error_message is None
    return folder, tmp_path / "b.zip"


def spoil(archive, member, change):
    """The archive with a member changed and its checksum made good."""
    with zipfile.ZipFile(archive) as z:
        content = {n: z.read(n).decode() for n in z.namelist()}
    content[member] = change(content[member])
    folder = archive.with_suffix("")
    for n, text in content.items():
        (folder / n).write_text(text, encoding="utf-8")
    sink.write_json({n: sink.sha256_file(folder / n) for n in C.PACKAGE_FILES if n != "checksums.json"}, folder / "checksums.json")
    sink.export_archive(folder, archive)


def test_schema_and_forbidden_faults_of_an_archive(spark, tmp_path):
    _, archive = made(spark, tmp_path)
    with zipfile.ZipFile(archive) as z:
        assert json.loads(z.read("answers.jsonl").decode().splitlines()[0])["collected_at"].endswith("05.000006")
    spoil(archive, "answers.jsonl", lambda t: t.replace('"PASS"', '"GOOD"', 1).replace('{"answer_id"', '{"sentiment": 1, "answer_id"', 1))
    spoil(archive, "tasks.jsonl", lambda t: t.replace('"question":"Q?",', "", 1))
    spoil(archive, "manifest.json", lambda t: t.replace("geo_package_v1", "v9"))
    got = pipeline.verify(spark, archive)
    assert got == ["manifest.json, line 1: schema_version value", "answers.jsonl, line 1: validation_status value", "tasks.jsonl, line 1: question missing", "answers.jsonl, line 1: sentiment forbidden"]
    spoil(archive, "sources.jsonl", lambda t: t.replace("}\n", "\n", 1))
    assert "sources.jsonl, line 1: no JSON" in pipeline.verify(spark, archive)
    assert pipeline.verify(spark, tmp_path / "none.zip") == ["there is no such file"]


def test_the_older_package(spark, tmp_path):
    folder, _ = made(spark, tmp_path)
    items = landed.analysis_items(landed.read_results(spark, f"{folder}/batch_summary.json"), landed.read_answers(spark, f"{folder}/q*.json"))
    old = tmp_path / "old.zip"
    assert pipeline.export_legacy(items, "pkg", "p", old) == []
    with zipfile.ZipFile(old) as z:
        assert json.loads(z.read("manifest.json"))["package_id"] == "pkg" and json.loads(z.read("sources.jsonl").decode().splitlines()[0])["rank"] == 1
    spoil(old, "tasks.jsonl", lambda t: t.replace('"quick"', '"slow"', 1))
    assert pipeline.verify(spark, old, legacy=True) == ["tasks.jsonl, line 1: mode value"]


def test_priority_rules_and_documents_of_a_run(spark, tmp_path):
    folder = tmp_path / "batch"
    folder.mkdir()
    batch(folder)
    path = folder / "q0_quick.json"
    path.write_text(json.dumps(json.loads(path.read_text(encoding="utf-8")) | {"answer": "Brand 值得推荐，但存在虚假宣传。"}, ensure_ascii=False), encoding="utf-8")
    result = pipeline.run(spark, str(folder), "b", "p", str(tmp_path / "b.zip"), {"t": ["Brand"]})
    assert (result.status, result.error_message) == ("completed", None)
    rows = spark.read.json(f"{folder}/analysis/sentiment_detail").where("rule_override").collect()
    assert [(r.question_id, r.model_sentiment, r.final_sentiment, r.provider) for r in rows] == [("q0", "positive", "negative", "lexicon")]
    document = json.loads((folder / "analysis" / "metrics.json").read_text(encoding="utf-8"))
    assert document["sentiment"]["t"]["quick"]["negative_count"] == 1 and document["sources"]["url_level"]["all"]["total_occurrences"] == 2
    assert json.loads((folder / "pipeline-result.json").read_text())["package_verified"] is True
    assert pipeline.run(spark, str(folder), "b", "p", str(tmp_path / "b.zip"), {"t": ["Brand"]}, rules={}).status == "completed"


def test_a_later_run_is_merged_and_the_rest_pending(spark, tmp_path):
    batch(tmp_path, ("pass", "fail", "pass"))
    later = tmp_path / "later"
    later.mkdir()
    batch(later, ("pass", "pass", "pass", "fail"))
    summary = json.loads((later / "batch_summary.json").read_text())
    summary["task_results"] = [r | {"question": "new"} for r in summary["task_results"][1:] if r["question_id"] in ("q1", "q3")]
    (later / "batch_summary.json").write_text(json.dumps(summary))
    head = pipeline.merge_batches(spark, str(tmp_path), str(later / "batch_summary.json"))
    assert (head["status"], head["pass_count"], head["fail_count"], head["planned_count"]) == ("partial", 3, 1, 4)
    rows = json.loads((tmp_path / "batch_summary.json").read_text())["task_results"]
    assert [(r["question_id"], r["status"], r["question"]) for r in rows] == [("q0", "pass", "Q?"), ("q1", "pass", "new"), ("q2", "pass", "Q?"), ("q3", "fail", "new")]
    tasks = tmp_path / "t.csv"
    tasks.write_text("question_id,question,mode\nq0,Q?,quick\nq3,new,research\nq9,x,quick\n", encoding="utf-8")
    assert {r.question_id for r in pipeline.pending_tasks(spark, str(tasks), str(tmp_path)).collect()} == {"q3", "q9"}


def test_spoilt_rows_of_a_summary_are_left_out(spark, tmp_path):
    path = tmp_path / "s.json"
    row = {"question_id": "a", "mode": "quick", "question": "q", "status": "pass", "output_path": None, "error_type": None, "error_message": None}
    path.write_text(json.dumps({"task_results": [row, {"mode": "quick"}, 7, row | {"mode": "slow"}, row | {"question_id": "b"}]}))
    (tmp_path / "t.json").write_text("{oops")
    got = landed.read_results(spark, str(tmp_path / "*.json"), permissive=True).collect()
    assert [(r.item_pos, r.question_id) for r in got] == [(0, "a"), (4, "b")]


def test_parts_that_the_driver_cannot_see_are_an_error(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Path, "glob", lambda self, pattern: iter(()))
    with pytest.raises(RuntimeError, match="must share the folder"):
        sink.write_json_lines(spark.range(3).select(F.col("id").alias("k")), tmp_path / "x.jsonl", ["k"])
    assert not (tmp_path / "x.jsonl").exists()


def test_cli_knows_its_actions(tmp_path, monkeypatch):
    assert pipeline.main(["merge", str(tmp_path)]) == 3
    monkeypatch.setenv("SENTIMENT_MAX_RETRIES", "-1")
    assert pipeline.main(["run", str(tmp_path), "--target", "t=Brand"]) == 3
    assert isinstance(pipeline.load_config({}).classifier(), sentiment.RetryingClassifier)
