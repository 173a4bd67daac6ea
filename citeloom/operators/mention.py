"""Brand mentions per answer and their rates per scope."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom import constants as C
from citeloom.functions import text

Targets = dict[str, list[str]]


def build_targets(targets: Targets) -> Targets:
    """Checked targets: trimmed ids, aliases trimmed and each once; blank ids or none left are errors."""
    out: Targets = {}
    for raw, aliases in targets.items():
        target, kept = raw.strip(), list(dict.fromkeys(a.strip() for a in aliases if a.strip()))
        if not target or not kept or target in out:
            raise ValueError(f"target {raw!r} needs an id of its own and an alias")
        out[target] = kept
    if not out:
        raise ValueError("there is no target")
    return out


def mention_detail(items: DataFrame, targets: Targets) -> DataFrame:
    """(question_id, mode, item_pos, target_id, mention_count, mentioned) of each valid answer and target.

    Targets are parameters: their patterns are literals of one projection over a single scan, and
    the rows per target come from an array, not from a join.
    """
    targets = build_targets(targets)
    valid = items.where(text.is_valid_answer(F.col("status"), F.col("answer"))).withColumn("_text", text.normalize(F.col("answer")))
    counts = F.array(*[F.struct(F.lit(t).alias("target_id"), text.mention_count(F.col("_text"), a).alias("mention_count")) for t,
        a in targets.items()])
    return valid.select("question_id", "mode", "item_pos", F.inline(counts)).withColumn("mentioned", F.col("mention_count") > 0)


def scope_frame(df: DataFrame, targets: Targets, scopes: tuple[str, ...]) -> DataFrame:
    """All (target_id, scope) pairs, a table of parameters."""
    return df.sparkSession.createDataFrame([(t, s) for t in build_targets(targets) for s in scopes], "target_id string, scope string")


def mention_summary(detail: DataFrame, targets: Targets) -> DataFrame:
    """(target_id, scope, valid_count, mentioned_count, mention_rate) for quick, research, all_answers and question_level.

    Scopes without answers appear with zeros.
    """
    answers = detail.withColumn("scope", F.explode(F.array("mode", F.lit("all_answers")))).groupBy("target_id", "scope").agg(
        F.count(F.lit(1)).alias("valid_count"), F.count_if("mentioned").alias("mentioned_count")
    )
    by_question = detail.where(F.col("question_id").isNotNull()).groupBy("target_id",
        "question_id").agg(F.bool_or("mentioned").alias("mentioned"))
    questions = by_question.groupBy("target_id").agg(
        F.lit("question_level").alias("scope"), F.count(F.lit(1)).alias("valid_count"), F.count_if("mentioned").alias("mentioned_count")
    )
    found = answers.unionByName(questions)
    frame = scope_frame(detail, targets, (*C.MODES, "all_answers", "question_level"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    out = frame.join(found, ["target_id", "scope"], "left").select("target_id", "scope", zero("valid_count"), zero("mentioned_count"))
    return out.withColumn("mention_rate", text.ratio(F.col("mentioned_count"), F.col("valid_count")))
