"""Batch runs: status counts and gates, resume, merge of incremental runs, stop after a block."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citeloom import constants as C
from citeloom.functions import text


def task_violations(tasks: DataFrame) -> DataFrame:
    """(question_id, mode, violation) of task rows that break the rules of a task table.

    blank_question_id, blank_question, bad_mode (modes are not trimmed) and duplicate_key.
    """
    rows = tasks.select(text.strip(F.col("question_id")).alias("question_id"), text.strip(F.col("question")).alias("question"), "mode")
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    found = F.filter(
        F.array(
            F.when(blank("question_id"), "blank_question_id"), F.when(blank("question"), "blank_question"),
            F.when(~F.coalesce(F.col("mode").isin(*C.MODES), F.lit(False)), "bad_mode")
        ),
        lambda v: v.isNotNull(),
    )
    single = rows.select("question_id", "mode", F.explode(found).alias("violation"))
    twice = rows.groupBy("question_id", "mode").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return single.unionByName(twice.select("question_id", "mode", F.lit("duplicate_key").alias("violation")))


def mode_counts(tasks: DataFrame, mode: str = "mode") -> DataFrame:
    return tasks.groupBy(mode).agg(F.count(F.lit(1)).alias("task_count"))


def status_counts(results: DataFrame, batch: Sequence[str] = (), planned: Column | None = None) -> DataFrame:
    """Counts by status per batch; pending is planned less executed and may be negative after a resume.

    ``results`` has a status of pass, fail, blocked or pending; ``planned`` defaults to all rows.
    """
    counted = results.groupBy(*batch).agg(
        *[F.count_if(F.col("status") == s).alias(f"{s}_count") for s in ("pass", "fail", "blocked")], F.count(F.lit(1)).alias("row_count")
    )
    out = counted.withColumn("planned_count", F.col("row_count") if planned is None else planned)
    out = out.withColumn("executed_count", F.col("pass_count") + F.col("fail_count") + F.col("blocked_count"))
    return out.withColumn("pending_count", F.col("planned_count") - F.col("executed_count")).drop("row_count")


def batch_status() -> Column:
    """The status a batch records for itself; pending rows don't count."""
    return F.when(F.col("blocked_count") > 0, "blocked").when(F.col("fail_count") > 0, "partial").otherwise("completed")


def gate_status() -> Column:
    """The status that decides what may follow a batch."""
    return F.when((F.col("blocked_count") > 0) | (F.col("pending_count") > 0), "blocked").when(F.col("fail_count") > 0,
        "partial").otherwise("completed")


def can_export() -> Column:
    return gate_status() == "completed"


def with_gates(counts: DataFrame) -> DataFrame:
    return counts.withColumns(
        {"batch_status": batch_status(), "gate_status": gate_status(), "can_export": can_export(),
        "completion_rate": text.ratio(F.col("pass_count"), F.col("planned_count"))}
    )


def pending_tasks(tasks: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Tasks to run on a resume: those without a passed row."""
    return tasks.join(done.where("status = 'pass'").select(*keys).distinct(), list(keys), "left_anti")


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str], order: str = "pos") -> DataFrame:
    """Existing rows with those of ``new`` in their place, then the rows that are new, in their order.

    Both have the same columns with ``order``, a place within their side; of rows of one key and
    side the last wins and the first one's place stays.
    """
    both = existing.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)))
    rest = [c for c in existing.columns if c not in (*keys, order)]
    merged = both.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct("_side", order)).alias("_row"), F.min(F.struct("_side", order)).alias("_place")
    )
    return merged.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest], F.col("_place._side").alias("added"),
        F.col(f"_place.{order}").alias(order))


def latest(rows: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The row of the greatest version per key; a max per key that combines before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*version, *[c for c in rest if c not in version])).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in rows.columns])


def until_first_blocked(results: DataFrame, batch: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows that run before a batch stops: up to and with its first blocked one.

    The first blocked place is an aggregate per batch, so no batch is windowed as a whole.
    """
    place = F.struct(*order)
    first = results.where("status = 'blocked'").groupBy(*batch).agg(F.min(place).alias("_stop"))
    return results.join(first, list(batch), "left").where(F.col("_stop").isNull() | (place <= F.col("_stop"))).drop("_stop")


#: Outcomes of a task by its attempts, a letter each: Q quota, B busy, R refusal, O an answer. One retry follows a busy service and one a refusal.
_BEFORE = "^B?(?:RB?)?"
OUTCOMES = (
    ("pass", f"{_BEFORE}O", None, "", None), ("blocked", f"{_BEFORE}Q", C.QUOTA_ERROR, "_blocked", "the account's quota is exhausted"),
    ("blocked", "^B?RB?R", C.REFUSAL_ERROR, "_blocked", "the refusal persisted after a retry"), ("fail", "^(?:B?R)?BB", C.BUSY_ERROR, "_failed", "the service stayed busy after a retry"),
)


def attempt_outcomes(attempts: DataFrame, order: str = "attempt") -> DataFrame:
    """Task results (question_id, mode, question, status, output_path, error_type, error_message, answer) of the attempts at each task.

    ``attempts`` has question_id, mode, question, answer and an order. What an attempt brought becomes
    a letter, and the letters in their order say what became of the task; attempts beyond the
    deciding one don't count. A task whose attempts decide nothing is pending, with neither path nor
    error. A task's attempts are few.
    """
    answer = F.col("answer")
    letter = F.when(text.is_quota_exhausted(answer), "Q").when(text.is_busy(answer), "B").when(text.is_refusal(answer), "R").otherwise("O")
    tried = attempts.withColumn("_letter", letter).groupBy("question_id", "mode").agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("_at"), "_letter", "question", "answer"))).alias("_tries")
    )
    letters = F.array_join(F.col("_tries._letter"), "")

    def decided(at: int) -> Column:
        out = F.when(F.lit(False), F.lit(None).cast("string"))
        for outcome in OUTCOMES:
            out = out.when(letters.rlike(outcome[1]), F.lit(outcome[at]).cast("string"))
        return out

    status = F.coalesce(decided(0), F.lit("pending"))
    path = F.when(status != "pending", F.concat(F.concat_ws("_", "question_id", "mode"), decided(3), F.lit(".json")))
    passing = F.get(F.col("_tries.answer"), F.length(F.regexp_extract(letters, OUTCOMES[0][1], 0)) - 1)
    return tried.select(
        "question_id", "mode", F.get(F.col("_tries.question"), F.lit(0)).alias("question"), status.alias("status"), path.alias("output_path"), decided(2).alias("error_type"),
        decided(4).alias("error_message"), F.when(status == "pass", passing).alias("answer"),
    )
