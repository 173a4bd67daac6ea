"""The metric cube of a batch, long and pivoted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def target_metrics(mention: DataFrame, sentiment: DataFrame) -> DataFrame:
    """One row per target with mention, non-negative and negative rates in four scopes.

    Both summaries must have the same targets; a target that only one has is an error.
    """
    both = mention.select("target_id", "scope", "mention_rate").join(
        sentiment.select("target_id", "scope", "non_negative_rate", "negative_rate"), ["target_id", "scope"], "full_outer"
    )
    one_sided = F.col("mention_rate").isNull() | F.col("negative_rate").isNull()
    sure = both.withColumn("mention_rate", F.when(one_sided, F.raise_error(F.concat(F.lit("summaries differ in target "),
        F.col("target_id"))).cast("double")).otherwise(F.col("mention_rate")))
    scopes = ["quick", "research", "all_answers", "question_level"]
    return sure.groupBy("target_id").pivot("scope", scopes).agg(
        *[F.first(c).alias(c) for c in ("mention_rate", "non_negative_rate", "negative_rate")]
    )


def source_metrics(sources: DataFrame, hosts: DataFrame, batch: Sequence[str] = ()) -> DataFrame:
    """(batch, scope, total_occurrences, unique_sources, source_top_share, unique_hosts, host_top_share) from two concentrations; ``batch`` are the columns that tell batches apart."""
    left = sources.select(*batch, "scope", "total_occurrences", F.col("unique_keys").alias("unique_sources"),
        F.col("top_share").alias("source_top_share"))
    right = hosts.select(*batch, "scope", F.col("unique_keys").alias("unique_hosts"), F.col("top_share").alias("host_top_share"))
    return left.join(right, [*batch, "scope"])
