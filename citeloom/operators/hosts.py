"""Per-key results where a handful of keys hold most records (problem 6).

Value-frequency compression: rows are grouped by key *and* value first, which spreads a hot key
over its values, and only the weighted values (value, frequency) are grouped by key. Distinct
counts, modes and percentiles follow exactly from weighted values, so no task ever holds a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Scopes of a host rank and the modes each covers.
SCOPES = {"quick": ("quick",), "research": ("research",), "all": ("quick", "research")}


def weighted_values(df: DataFrame, keys: Sequence[str], value: str | Column, name: str = "value") -> DataFrame:
    """(keys, value, frequency): one row per key and value; null values are kept as a value."""
    value = F.col(value) if isinstance(value, str) else value
    return (
        df.select(*[F.col(k) for k in keys], value.alias(name))
        .groupBy(*keys, name)
        .agg(F.count(F.lit(1)).alias("frequency"))
    )


#: Range of values whose frequencies one window sums up.
WIDTH = 1024


def weighted_summary(
    weighted: DataFrame, keys: Sequence[str], value: str = "value", percentiles: Sequence[float] = (0.5, 0.9)
) -> DataFrame:
    """Exact count, distinct count, mode and percentiles per key from weighted numeric values.

    Null values count as rows but are no value. The mode is the most frequent value, the smallest
    of them on a tie; percentiles interpolate. A key with null values only gets null statistics.
    A percentile is where running sums of frequencies pass its place: they run within ranges of
    ``WIDTH`` values, and over the ranges, so no task buffers the values of a key.
    """
    v = F.col(value)
    totals = weighted.groupBy(*keys).agg(
        F.sum("frequency").alias("row_count"),
        F.count(value).alias("distinct_count"),
        F.min_by(value, F.when(v.isNotNull(), F.struct(-F.col("frequency"), v))).alias("mode_value"),
        F.sum(F.when(v.isNotNull(), F.col("frequency"))).alias("_known"),
    )
    if not percentiles:
        return totals.drop("_known")
    known = weighted.where(v.isNotNull()).withColumn("_range", F.floor(v / WIDTH))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = known.groupBy(*keys, "_range").agg(F.sum("frequency").alias("_sum"))
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = known.withColumn("_inside", F.sum("frequency").over(inside))

    def joined(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
        """A join in which null keys are equal."""
        named = right.select(*[F.col(k).alias(f"_on_{k}") for k in on], *[c for c in right.columns if c not in on])
        return left.join(named, [F.col(k).eqNullSafe(F.col(f"_on_{k}")) for k in on], how).drop(*[f"_on_{k}" for k in on])

    placed = joined(joined(running, ranges, [*keys, "_range"], "inner"), totals.select(*keys, "_known"), keys, "inner")
    upto, picks = F.col("_before") + F.col("_inside"), []
    for i, p in enumerate(percentiles):
        place = (F.col("_known") - 1) * F.lit(float(p))
        for name, index in (("low", F.floor(place)), ("high", F.ceil(place))):
            picks.append(F.min(F.when(upto > index, v)).alias(f"_{name}{i}"))
    picked = placed.groupBy(*keys).agg(*picks)
    out = joined(totals, picked, keys, "left")
    columns = []
    for i, p in enumerate(percentiles):
        place = (F.col("_known") - 1) * F.lit(float(p))
        low, high = F.col(f"_low{i}").cast("double"), F.col(f"_high{i}").cast("double")
        between = (F.ceil(place) - place) * low + (place - F.floor(place)) * high
        columns.append(F.when(F.floor(place) == F.ceil(place), low).otherwise(between).alias(f"p{round(p * 100):02d}"))
    return out.select(*keys, "row_count", "distinct_count", "mode_value", *columns)


def host_counts(occurrences: DataFrame) -> DataFrame:
    """occurrence_count and question_count of each (wave_id, scope, host).

    An occurrence counts once per (wave_id, question_id, mode, source_key); question_count is the
    number of distinct question_id (null is no question). Hosts are the values of ``domain``; null
    and empty ones don't count, nor do rows of other modes. Redelivered, late and repeated rows
    fall together in the first grouping. An empty input gives no rows; other columns are ignored.
    """
    rows = occurrences.where(
        F.col("domain").isNotNull() & (F.col("domain") != "") & F.col("mode").isin("quick", "research")
    ).select("wave_id", F.col("domain").alias("host"), "question_id", "mode", "source_key")
    once = rows.distinct()
    by_question = once.groupBy("wave_id", "host", "question_id").agg(
        *[F.count_if(F.col("mode").isin(*modes)).alias(f"n_{scope}") for scope, modes in SCOPES.items()]
    )
    asked = F.col("question_id").isNotNull()
    by_host = by_question.groupBy("wave_id", "host").agg(
        *[F.sum(f"n_{scope}").alias(f"n_{scope}") for scope in SCOPES],
        *[F.count_if(asked & (F.col(f"n_{scope}") > 0)).alias(f"q_{scope}") for scope in SCOPES],
    )
    per_scope = F.array(
        *[
            F.struct(F.lit(s).alias("scope"), F.col(f"n_{s}").alias("occurrence_count"), F.col(f"q_{s}").alias("question_count"))
            for s in SCOPES
        ]
    )
    return (
        by_host.select("wave_id", "host", F.inline(per_scope))
        .where("occurrence_count > 0")
        .select("wave_id", "scope", "host", "occurrence_count", "question_count")
    )


def host_disagreements(occurrences: DataFrame, reported: DataFrame) -> DataFrame:
    """(wave_id, scope, host) whose reported counts differ from those of the occurrences.

    A difference is another occurrence_count or question_count (null included), a host without a
    reported row, or a reported row without occurrences. A host that is reported twice with
    different counts disagrees; repeated equal rows count once. Reported null or empty hosts are
    left out, as hosts are there.
    """
    claims = reported.where(F.col("host").isNotNull() & (F.col("host") != "")).select(
        "wave_id", "scope", "host",
        F.struct(
            F.lit(True).alias("there"),
            F.col("occurrence_count").cast("bigint").alias("n"),
            F.col("question_count").cast("bigint").alias("q"),
        ).alias("claim"),
    )
    found = host_counts(occurrences).select(
        "wave_id", "scope", "host",
        F.struct(
            F.lit(True).alias("there"), F.col("occurrence_count").alias("n"), F.col("question_count").alias("q")
        ).alias("fact"),
    )
    both = claims.select("*", F.lit(None).cast(found.schema["fact"].dataType).alias("fact")).unionByName(
        found.select("*", F.lit(None).cast(claims.schema["claim"].dataType).alias("claim"))
    )
    # One row per key is enough: a key has one fact, and its claims agree when the least equals the greatest.
    return (
        both.groupBy("wave_id", "scope", "host")
        .agg(F.min("claim").alias("low"), F.max("claim").alias("high"), F.max("fact").alias("fact"))
        .where(~(F.col("low").eqNullSafe(F.col("fact")) & F.col("high").eqNullSafe(F.col("fact"))))
        .select("wave_id", "scope", "host")
    )
