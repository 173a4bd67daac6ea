"""Mixing sources to target weights (problem 8).

A plan names sources, the share of tokens each is to hold and how often a document may be used.
Every source first gets the whole copies that are certain; what is left of its target is drawn by
Pareto order sampling: documents are ranked by random odds divided by inclusion odds, and the
first of them are taken until the tokens are reached. The random number of a document is a hash of
its id and a seed, so a lost task draws the same sample again.

No source is ordered as a whole: ranks are counted into ranges, whole ranges are taken by their
token sums, and only the range in which the target is reached is ordered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citeloom.llm.tokens import TOKENIZERS, token_count
from citeloom.session import cut_lineage

#: Documents that a range of ranks holds on average, and the most ranges of a source.
RANGE_DOCUMENTS, MOST_RANGES = 256, 65_536


def sized_documents(documents: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """(doc_id, source, n_tokens, weight), written once to the shared checkpoint folder.

    The weight is 1 / the number of documents of the source with the same text, so repeated texts
    share the chance of one. Documents without a token, an id or a source are left out; repeated
    rows of an id count once (the least of them, if they differ).
    """
    rows = documents.select(
        "doc_id", "source", token_count("text", tokenizers).alias("n_tokens"), F.xxhash64("text").alias("text_hash")
    ).where("doc_id IS NOT NULL AND source IS NOT NULL")
    once = rows.groupBy("doc_id").agg(F.min(F.struct("source", "n_tokens", "text_hash")).alias("d")).select("doc_id",
        "d.*").where("n_tokens > 0")
    once = cut_lineage(once)
    texts = once.groupBy("source", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    return once.join(texts, ["source", "text_hash"]).select("doc_id", "source", "n_tokens", (F.lit(1.0) / F.col("n")).alias("weight"))


def source_needs(sized: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """What each (plan_id, source) is to give: one small row per target.

    A plan's total is ``total_tokens`` or, by default, the tokens of its sources' documents used
    once. ``whole`` copies of every document are certain and ``rest`` tokens are to be drawn.
    Targets repeated for a source add up, under the greatest max_repeats; null shares and repeats
    count as 0.
    """
    plan = targets.where("plan_id IS NOT NULL AND source IS NOT NULL").groupBy("plan_id", "source").agg(
        F.sum(F.coalesce("target_share", F.lit(0.0))).alias("target_share"),
        F.max(F.coalesce(F.greatest(F.col("max_repeats"), F.lit(0)), F.lit(0))).cast("bigint").alias("max_repeats"),
    )
    size = sized.groupBy("source").agg(
        F.sum("n_tokens").alias("held"), F.sum(F.col("n_tokens") * F.col("weight")).alias("weighted"), F.count(F.lit(1)).alias("documents")
    )
    held = F.coalesce("held", F.lit(0))
    total = F.sum("held").over(Window.partitionBy("plan_id")) if total_tokens is None else F.lit(int(total_tokens))
    # The plan table is a parameter of a few rows; the join's other side has one row per source.
    needs = (
        plan.join(size, "source", "left")
        .withColumns({"held": held, "documents": F.coalesce("documents", F.lit(0))})
        .withColumn("plan_tokens", total)
        .withColumn("wanted", F.col("target_share") * F.col("plan_tokens"))
        .withColumn("given", F.least(F.col("wanted"), (F.col("max_repeats") * F.col("held")).cast("double")))
        .withColumn("whole", F.coalesce(F.floor(F.try_divide(F.col("given"), F.col("held"))), F.lit(0)))
    )
    return needs.withColumn("rest", F.round(F.col("given") - F.col("whole") * F.col("held")).cast("bigint"))


def draw_rates(sized: DataFrame, needs: DataFrame) -> DataFrame:
    """(plan_id, source, per_weight): the rate whose product with a document's weight is its chance, at most 1, so that chances add up to ``rest`` tokens.

    Documents of the greatest weights are certain where the rate would pass 1, and what they free is
    spread over the others. One row per source and weight, a weight being 1 / the copies of a text.
    """
    by_weight = sized.groupBy("source", "weight").agg(F.sum("n_tokens").alias("tokens"))
    rows = by_weight.join(F.broadcast(needs.where("rest > 0").select("plan_id", "source", "rest")), "source")
    down = Window.partitionBy("plan_id", "source").orderBy(F.desc("weight"))
    certain = F.coalesce(F.sum("tokens").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum(F.col("tokens") * F.col("weight")).over(down.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rated = rows.withColumn("rate", (F.col("rest") - certain) / left)
    # A rate too high for any weight means that all documents are certain.
    fits = F.when(F.col("rate") * F.col("weight") <= 1, F.struct(-F.col("weight"), "rate"))
    return rated.groupBy("plan_id", "source").agg(F.coalesce(F.min(fits)["rate"], F.lit(1.0) / F.min("weight")).alias("per_weight"))


def mix(sized: DataFrame, needs: DataFrame, seed: int = 1) -> DataFrame:
    """(plan_id, source, doc_id, n_tokens, copies) of each document that a plan uses.

    A document that would overshoot the target is passed over for those after it in its range that
    fit. Targets without documents give no rows, as do empty tables.
    """
    small = needs.join(draw_rates(sized, needs), ["plan_id", "source"], "left").select("plan_id", "source", "whole", "rest", "per_weight",
        F.least(F.greatest(F.floor(F.col("documents") / RANGE_DOCUMENTS), F.lit(1)),
        F.lit(MOST_RANGES)).alias("ranges")).where("whole > 0 OR rest > 0")
    rows = sized.join(F.broadcast(small), "source")  # one row per target of the plans, whatever the data
    chance = F.least(F.col("per_weight") * F.col("weight"), F.lit(1 - 1e-9))
    luck = (F.pmod(F.xxhash64("doc_id", "plan_id", F.lit(seed)), F.lit(2**52)) + 0.5) / float(2**52)
    rows = rows.withColumn("q", F.when(chance > 0, (luck / (1 - luck)) * ((1 - chance) / chance)))
    rows = rows.withColumn("bucket", F.floor(F.col("q") / (1 + F.col("q")) * F.col("ranges")))
    drawn = rows.where("rest > 0")
    sums = drawn.groupBy("plan_id", "source", "bucket").agg(F.sum("n_tokens").alias("in_bucket"), F.max("rest").alias("goal"))
    running = F.sum("in_bucket").over(Window.partitionBy("plan_id", "source").orderBy("bucket"))
    edge = (
        sums.withColumn("upto", running)
        .where("upto >= goal")
        .groupBy("plan_id", "source")
        .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("in_bucket")).alias("before"))).alias("edge"))
    )
    placed = rows.join(F.broadcast(edge), ["plan_id", "source"], "left")  # at most one row per target
    inside = F.coalesce((F.col("rest") > 0) & (F.col("bucket") < F.col("edge.bucket")), F.lit(False))
    at_edge = F.coalesce((F.col("rest") > 0) & (F.col("bucket") == F.col("edge.bucket")), F.lit(False))
    target = Window.partitionBy("plan_id", "source")
    order = target.orderBy("q", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.col("edge.before")
    upto = before + F.sum("n_tokens").over(order)
    first = placed.where(at_edge).withColumn("upto", upto).withColumn("fits", F.col("upto") <= F.col("rest"))
    gap = F.col("rest") - F.coalesce(F.max(F.when(F.col("fits"), F.col("upto"))).over(target), before)
    second = first.withColumn("gap", gap).withColumn("left", ~F.col("fits") & (F.col("n_tokens") <= F.col("gap")))
    filled = F.sum(F.when(F.col("left"), F.col("n_tokens")).otherwise(0)).over(order)
    cut = second.withColumn("filled", filled).withColumn(
        "extra", (F.col("fits") | (F.col("left") & (F.col("filled") - F.col("n_tokens") / 2 <= F.col("gap")))).cast("bigint")
    )
    out = ["plan_id", "source", "doc_id", "n_tokens"]
    sure = placed.where(~at_edge).select(*out, (F.col("whole") + inside.cast("bigint")).alias("copies"))
    return sure.unionByName(cut.select(*out, (F.col("whole") + F.col("extra")).alias("copies"))).where("copies > 0")


def mix_shares(mixed: DataFrame, needs: DataFrame) -> DataFrame:
    """Shares reached, one row per (plan_id, source).

    ``share`` is of the tokens that the plan reached, ``share_of_plan`` of those it was to have;
    ``in_reach`` says whether max_repeats allows the target at that size.
    """
    got = mixed.groupBy("plan_id", "source").agg(
        F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.max("copies").alias("most_copies"),
        F.count(F.lit(1)).alias("documents_used")
    )
    tokens = F.coalesce("tokens", F.lit(0))
    reached = F.sum(tokens).over(Window.partitionBy("plan_id"))
    return needs.join(got, ["plan_id", "source"], "left").select(
        "plan_id", "source", "target_share", "max_repeats", "documents", F.col("held").alias("tokens_held"),
        F.coalesce("documents_used", F.lit(0)).alias("documents_used"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
        tokens.alias("tokens"),
        F.coalesce(F.try_divide(tokens, reached), F.lit(0.0)).alias("share"),
        F.coalesce(F.try_divide(tokens, F.col("plan_tokens")), F.lit(0.0)).alias("share_of_plan"),
        (F.col("wanted") <= F.col("max_repeats") * F.col("held")).alias("in_reach"),
    )
