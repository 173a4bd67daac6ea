"""Metrics as JSON documents.

Summaries have one row per target (or source) and scope, a number that does not grow with the
answers, so they are put together on the driver; details stay tables.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.sinks.package import write_json

NAMES = {"all_answers": "all", "question_level": "question"}


def mention_metrics(summary: DataFrame) -> dict:
    """target -> scope -> counts and rate; targets in order of their ids."""
    out: dict = {}
    for r in summary.orderBy("target_id", "scope").collect():
        out.setdefault(r.target_id, {})[NAMES.get(r.scope, r.scope)] = {k: r[k] for k in ("valid_count", "mentioned_count", "mention_rate")}
    return out


def sentiment_metrics(summary: DataFrame, targets: list[str]) -> dict:
    """target -> scope -> counts and rates; targets in the order they were given."""
    keys = [c for c in summary.columns if c not in ("target_id", "scope")]
    rows = {(r.target_id, r.scope): {k: r[k] for k in keys} for r in summary.collect()}
    scopes = sorted({s for _, s in rows})
    return {t: {NAMES.get(s, s): rows[t, s] for s in scopes if (t, s) in rows} for t in targets}


def source_metrics(sources: DataFrame, hosts: DataFrame, source_top: DataFrame, host_top: DataFrame) -> dict:
    """url_level and host_level -> scope -> totals and the top list, ordered by place."""

    def level(totals: DataFrame, best: DataFrame) -> dict:
        lists: dict = {}
        for r in best.orderBy("scope", "place").collect():
            lists.setdefault(r.scope, []).append({k: v for k, v in r.asDict().items() if k not in ("scope", "place")})
        return {r.scope: {**{k: v for k, v in r.asDict().items() if k != "scope"},
            "top": lists.get(r.scope, [])} for r in totals.orderBy("scope").collect()}

    return {"url_level": level(sources, source_top), "host_level": level(hosts, host_top)}


def write_metrics(mention: dict, sentiment: dict, sources: dict, path: str | Path) -> None:
    write_json({"mention": mention, "sentiment": sentiment, "sources": sources}, path)


def task_issues(results: DataFrame) -> DataFrame:
    """(question_id, mode, status, error_type, error_message, file_name) of tasks that did not pass; tasks that passed since have none."""
    passed = results.where("status = 'pass'").select("question_id", "mode").distinct()
    open_ones = results.where(F.col("status").isin("fail", "blocked")).join(passed, ["question_id", "mode"], "left_anti")
    name = F.concat_ws("_", "question_id", "mode", F.when(F.col("status") == "blocked", "blocked").otherwise("failed"))
    return open_ones.select("question_id", "mode", "status", "error_type", "error_message",
        F.concat(name, F.lit(".json")).alias("file_name"))
