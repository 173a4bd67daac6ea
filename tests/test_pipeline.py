from __future__ import annotations

import json
import zipfile

import pytest

from citeloom import pipeline, schemas
from citeloom.operators import sentiment
from citeloom.sinks import package as sink
from citeloom.sources import landed
from citeloom.streaming import ingest


def batch(folder, statuses=("pass", "pass")):
    results = []
    for i, status in enumerate(statuses):
        mode = ("quick", "research")[i % 2]
        name = f"q{i}_{mode}.json"
        results.append({"question_id": f"q{i}", "mode": mode, "question": "Q?", "status": status, "output_path": f"C:\\out\\{name}", "error_type": None, "error_message": None})
        answer = {
            "platform": "p", "question_id": f"q{i}", "question": "Q?", "answer": f"Brand 回答{i}", "turn_id": f"t{i}", "chat_url": "u", "mode": mode, "mode_label": "m", "search_queries": ["s"],
            "sources": [{"rank": 1, "title": "T", "url": f"https://www.s{i}.test/"}], "citation_mapping_available": False, "acquired_at": "2026-01-02T03:04:05.000006",
        }
        if status == "pass":
            (folder / name).write_text(json.dumps(answer, ensure_ascii=False), encoding="utf-8")
    summary = {"platform": "p", "status": "completed", "planned_count": len(results), "task_results": results, "started_at": "2026-01-02T03:04:05", "finished_at": None}
    (folder / "batch_summary.json").write_text(json.dumps(summary), encoding="utf-8")
    return folder


class Late:
    def classify(self, *_):
        raise sentiment.ProviderError("timeout", "late")


def test_a_complete_batch_gives_a_verified_package(spark, tmp_path):
    archive = tmp_path / "b1.zip"
    folder = tmp_path / "batch"
    folder.mkdir()
    got = pipeline.run(spark, str(batch(folder)), "b1", "p", str(archive), {"t": ["Brand"]}, sentiment.LexiconClassifier(["回答"], []))
    assert (got.status, got.analysis_status, got.package_verified, got.error_message) == ("completed", "completed", True, None)
    with zipfile.ZipFile(archive) as z:
        assert json.loads(z.read("manifest.json"))["answer_count"] == 2
        line = json.loads(z.read("answers.jsonl").decode().splitlines()[0])
        assert line["screenshot_path"] is None and line["platform_meta_json"]["turn_id"].startswith("t")
    assert pipeline.verify(spark, archive) == []
    tables = landed.package_tables(landed.read_package_lines(spark, str(archive)))
    assert tables["sources"].count() == 2 and landed.newest_package(spark, str(tmp_path)).endswith("b1.zip")


@pytest.mark.parametrize(("statuses", "status"), [(("pass", "fail"), "partial"), (("pass", "blocked"), "blocked"), (("pass", "pending"), "blocked")])
def test_gates_end_a_run(spark, tmp_path, statuses, status):
    got = pipeline.run(spark, str(batch(tmp_path, statuses)), "b", "p", str(tmp_path / "b.zip"))
    assert got.status == status and got.package_path is None


def test_analysis_errors_make_it_partial(spark, tmp_path):
    got = pipeline.run(spark, str(batch(tmp_path)), "b", "p", str(tmp_path / "b.zip"), {"t": ["Brand"]}, Late())
    assert (got.status, got.analysis_status, got.package_verified) == ("partial", "completed_with_warnings", True)


def test_a_missing_answer_fails_the_run(spark, tmp_path):
    batch(tmp_path)
    (tmp_path / "q0_quick.json").unlink()
    got = pipeline.run(spark, str(tmp_path), "b", "p", str(tmp_path / "b.zip"))
    assert got.status == "failed" and "no answer file" in got.error_message


def test_an_archive_is_repaired(spark, tmp_path):
    folder = tmp_path / "batch"
    folder.mkdir()
    batch(folder)
    path = folder / "q0_quick.json"
    answer = json.loads(path.read_text())
    path.write_text(json.dumps(answer | {"answer": "当前访问人数过多，疯狂加服务器中，请稍后再试"}, ensure_ascii=False))
    pipeline.run(spark, str(folder), "b", "p", str(tmp_path / "b.zip"))
    repaired = tmp_path / "b_repaired.zip"
    assert pipeline.repair_archive(spark, tmp_path / "b.zip", repaired) == []
    tables = landed.package_tables(landed.read_package_lines(spark, str(repaired)))
    assert tables["answers"].count() == 1 and tables["sources"].count() == 1 and {r.task_status for r in tables["tasks"].collect()} == {"failed", "success"}
    assert landed.newest_package(spark, str(tmp_path)).endswith("b.zip")


def test_all_faults_are_told(spark, tmp_path, monkeypatch):
    archive = tmp_path / "b.zip"
    folder = tmp_path / "batch"
    folder.mkdir()
    assert pipeline.run(spark, str(batch(folder)), "b", "p", str(archive)).status == "completed"
    many = spark.range(250).selectExpr("12 AS check_no", "'unique task_id' AS check_name", "format_string('%03d', id) AS subject")
    monkeypatch.setattr(pipeline.package, "verify", lambda *tables: many)
    got = pipeline.verify(spark, archive)
    assert len(got) == 101 and got[99] == "unique task_id: 099" and got[-1].startswith("250 faults in all")
    assert [json.loads(line) for line in (tmp_path / "b.faults.jsonl").read_text().splitlines()] == [f"unique task_id: {i:03}" for i in range(250)]


def test_metrics_documents(spark, tmp_path):
    from citeloom.operators import citations, mention
    from citeloom.sinks import metrics

    rows = spark.createDataFrame([("q", "quick", "pass", "Brand 好", 0, [(1, "T", "https://a.test")])], "question_id string, mode string, status string, answer string, item_pos bigint, sources array<struct<rank:int,title:string,url:string>>")
    found = pipeline.analyse(rows, {"z": ["Brand"], "a": ["x"]}, sentiment.LexiconClassifier(["好"], []))
    mentions = metrics.mention_metrics(found["mention_summary"])
    assert list(mentions) == ["a", "z"] and mentions["z"]["all"]["mention_rate"] == 1.0
    tone = metrics.sentiment_metrics(found["sentiment_summary"], ["z", "a"])
    assert list(tone) == ["z", "a"] and tone["z"]["question"]["positive_count"] == 1
    totals = citations.concentration(citations.source_ranks(found["occurrences"]), citations.source_order())
    hosts = citations.concentration(citations.host_ranks(found["occurrences"]), citations.host_order())
    sources = metrics.source_metrics(totals, hosts, found["source_top"], found["host_top"])
    assert sources["url_level"]["all"]["top"][0]["source_key"] == "https://a.test/" and sources["host_level"]["research"]["top"] == []
    metrics.write_metrics(mentions, tone, sources, tmp_path / "m.json")
    assert json.loads((tmp_path / "m.json").read_text())["mention"]["a"]["quick"]["valid_count"] == 1
    assert mention.build_targets({" a ": [" x ", "x"]}) == {"a": ["x"]}


def test_task_issues(spark):
    from citeloom.sinks.metrics import task_issues

    rows = [("a", "quick", "fail"), ("a", "quick", "pass"), ("b", "quick", "blocked"), ("c", "research", "fail"), ("d", "quick", "pending")]
    df = spark.createDataFrame([(*r, "E", "m") for r in rows], "question_id string, mode string, status string, error_type string, error_message string")
    assert {r.file_name for r in task_issues(df).collect()} == {"b_quick_blocked.json", "c_research_failed.json"}


def test_config():
    from citeloom.config import load_config

    assert load_config({}).retry_backoff_seconds == (3.0, 8.0) and load_config({"SENTIMENT_RETRY_BACKOFF_SECONDS": ""}).retry_backoff_seconds == ()
    got = load_config({"SENTIMENT_PROVIDER": "http", "SENTIMENT_MODEL": "m", "SENTIMENT_MAX_RETRIES": "0"})
    assert (got.classifier().model, got.max_retries) == ("m", 0)
    for bad in ({"SENTIMENT_MAX_RETRIES": "-1"}, {"SENTIMENT_REQUEST_TIMEOUT_SECONDS": "x"}, {"SENTIMENT_RETRY_BACKOFF_SECONDS": "a"}, {"SENTIMENT_RETRY_BACKOFF_SECONDS": "-1"}):
        with pytest.raises(ValueError):
            load_config(bad)


def test_a_changed_archive_is_found(spark, tmp_path):
    archive = tmp_path / "b.zip"
    folder = tmp_path / "batch"
    folder.mkdir()
    pipeline.run(spark, str(batch(folder)), "b", "p", str(archive))
    content = tmp_path / "b"
    (content / "tasks.jsonl").write_text("", encoding="utf-8")
    assert landed.check_archive(sink.export_archive(content, archive).read_bytes()) == ["checksum of tasks.jsonl", "task_count"]
    assert landed.check_archive(b"x") == ["it is no ZIP archive"]
    with zipfile.ZipFile(archive, "w") as z:
        z.writestr("a", "b")
    assert landed.check_archive(archive.read_bytes())[0].startswith("members missing")


def test_task_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('﻿question_id,question,mode,more\n q1 ,"a\nb ""c""",quick,x\nq2,d,research,\n', encoding="utf-8")
    rows = landed.read_tasks(spark, str(path)).orderBy("item_pos").collect()
    assert [(r.question_id, r.question, r["mode"]) for r in rows] == [("q1", 'a\nb "c"', "quick"), ("q2", "d", "research")]
    path.write_text("question_id,mode\nq,quick\n", encoding="utf-8")
    with pytest.raises(ValueError, match="question"):
        landed.read_tasks(spark, str(path))
    path.write_text("question_id,question,mode\nq,x,quick\nq,y,quick\n", encoding="utf-8")
    with pytest.raises(ValueError, match="duplicate_key"):
        landed.read_tasks(spark, str(path))
    path.write_text("question_id,question,mode\n", encoding="utf-8")
    with pytest.raises(ValueError, match="no rows"):
        landed.read_tasks(spark, str(path))


def test_json_lines(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('﻿{"question_id": "a", "mode": "quick"}\n\n{"question_id": "b"}\n', encoding="utf-8")
    assert [r.question_id for r in landed.read_json_lines(spark, str(path), schemas.TASK).collect()] == ["a", "b"]
    path.write_text("{oops\n", encoding="utf-8")
    with pytest.raises(Exception, match="no JSON"):
        landed.read_json_lines(spark, str(path), schemas.TASK).collect()
    empty = spark.createDataFrame([], schemas.TASK)
    assert sink.write_json_lines(empty, tmp_path / "e.jsonl", ["question_id"]) == 0 and (tmp_path / "e.jsonl").read_bytes() == b""


def test_checksums(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"abc")
    got = sink.checksums(spark.read.format("binaryFile").load(str(tmp_path / "a.txt"))).first()
    assert got.file_name == "a.txt" and got.sha256 == sink.sha256_file(tmp_path / "a.txt")


def test_stream_upsert_and_resume(spark, tmp_path):
    landing, table, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "k string, v int, t timestamp_ntz"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"k":"a","v":1,"t":"2026-01-01T00:00:00"}\n{"k":"b","v":1,"t":"2026-01-01T00:00:00"}\n')
    ingest.upsert_stream(ingest.landed_stream(spark, landing, schema), table, checkpoint, ["k"], ["t"])
    (tmp_path / "in" / "2.json").write_text('{"k":"a","v":2,"t":"2026-01-02T00:00:00"}\n')
    ingest.upsert_stream(ingest.landed_stream(spark, landing, schema, 1), table, checkpoint, ["k"], ["t"])
    got = {r.k: r.v for r in ingest.read_upserted(spark, table, ["k"], ["t"]).collect()}
    assert got == {"a": 2, "b": 1}


def test_stream_first_deliveries_and_windows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text("".join(f'{{"k":"{k}","t":"2026-01-01T0{h}:00:00"}}\n' for k, h in (("a", 1), ("a", 1), ("b", 2))))
    stream = ingest.landed_stream(spark, str(tmp_path / "in"), "k string, t timestamp")
    for name, df, mode in (("first", ingest.first_deliveries(stream, ["k"], "t"), "append"), ("counts", ingest.windowed_counts(stream, "t", ["k"]), "complete")):
        df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    assert spark.table("first").count() == 2 and spark.table("counts").agg({"row_count": "sum"}).first()[0] == 3


def test_cli_rejects_bad_arguments(capsys):
    assert pipeline.main(["run"]) == 3
    assert pipeline.main(["run", "x", "--target", "t"]) == 3
