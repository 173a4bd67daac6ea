"""The N best rows of every group (problem 3).

Pass 1 finds lower bounds: wherever a partition holds N items of a group, the N-th best of them
bounds the group's true N-th best, and the best bound of all partitions holds for the group.
Pass 2 keeps the rows that reach their group's bound and ranks these survivors. Only bounds that
pay are used, those of the groups that hold most rows beyond N; they are few by a fixed number,
so they are broadcast and nothing is shuffled before the rows are filtered. What the other groups
hold beyond N combines per task (partial aggregation and ``WindowGroupLimit``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

#: Bounds that are broadcast at most (some 10 MB): those of the groups with most rows.
BROADCAST_ROWS = 100_000
_LAST = 2**63 - 1


def local_bounds(items: DataFrame, groups: Sequence[str], n: int) -> DataFrame:
    """(groups, score, ord, item, held): the n-th best distinct item that a partition holds of a group, and how many rows.

    ``items`` has the columns ``groups``, ``score`` (higher is better), ``ord`` (lower is better)
    and ``item`` (lower in byte order is better). Of a group a partition keeps about twice n items
    before it drops all but the best n, so each row is sorted a few times at most, and a partition
    of small groups is kept as it is. Groups that fill no n items in it have no bound.
    """
    names = list(groups)

    def best(part: pd.DataFrame) -> pd.DataFrame:
        # Python orders strings by code point, which is UTF-8's byte order.
        part = part.sort_values(["score", "ord", "item"], ascending=[False, True, True], kind="stable")
        part = part.drop_duplicates([*names, "item"])  # an item counts by its best row
        return part.groupby(names, dropna=False, sort=False).head(n)

    def bounds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, sizes, waiting, rows = None, None, [], 0

        def merge() -> None:
            nonlocal held, sizes, waiting, rows
            fresh = pd.concat(waiting, ignore_index=True)
            counted = fresh.groupby(names, sort=False).size()
            sizes = counted if sizes is None else sizes.add(counted, fill_value=0)
            held = best(fresh if held is None else pd.concat([held, fresh], ignore_index=True))
            waiting, rows = [], 0

        for batch in batches:
            waiting.append(batch)
            rows += len(batch)
            # Waiting for as many rows as are held keeps the sorting linear but for a logarithm.
            if rows >= max(50_000, 0 if held is None else len(held)):
                merge()
        if waiting:
            merge()
        if held is not None and len(held):
            place = held.groupby(names, dropna=False, sort=False).cumcount()
            out = held[place == n - 1]
            yield out.merge(sizes.rename("held").reset_index(), on=names, how="left").astype({"held": "int64"})

    return items.mapInPandas(bounds, StructType([*items.schema.fields, StructField("held", LongType())]))


def top_n(
    rows: DataFrame, groups: Sequence[str], score: str | Column, order: str | Column, item: str | Column, n: int = 10
) -> DataFrame:
    """(groups, item, score, ord, place): the n first items of each group.

    Items come by higher score, then lower order (null last), then lower item in byte order; an
    item that stands in several rows counts by its best row. Rows with a null score or a null
    group are left out, as are null items. Empty groups ('') stay: what a group is, the caller
    says. An empty table gives no rows; other columns are ignored.
    """
    col = lambda c: F.col(c) if isinstance(c, str) else c
    names = [f"g{i}" for i in range(len(groups))]
    items = rows.select(
        *[F.col(g).cast("string").alias(a) for g, a in zip(groups, names, strict=True)],
        col(score).cast("bigint").alias("score"),
        F.coalesce(col(order).cast("bigint"), F.lit(_LAST)).alias("ord"),
        col(item).cast("string").alias("item"),
    )
    for c in [*names, "score", "item"]:
        items = items.where(F.col(c).isNotNull())
    schema = StructType([StructField(g, StringType()) for g in names] + [StructField("score", LongType()), StructField("ord", LongType()),
        StructField("item", StringType())])
    items = items.to(schema)

    reach = F.struct(-F.col("score"), F.col("ord"), F.col("item"))  # the smaller, the better
    # More than n rows are what a bound can filter; the bounds of the largest groups are kept, with ties by name.
    bound = (
        local_bounds(items, names, n).groupBy(*names)
        .agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("ord").alias("o"), F.col("item").alias("i"))).alias("bound"),
        F.sum("held").alias("held"))
        .where(F.col("held") > n).orderBy(F.desc("held"), *names).limit(BROADCAST_ROWS).drop("held")
    )
    survivors = items.join(F.broadcast(bound), names, "left").where(F.col("bound").isNull() | (reach <= F.col("bound")))
    best = survivors.groupBy(*names, "item").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("ord").alias("o"))).alias("b"))
    window = Window.partitionBy(*names).orderBy("b.s", "b.o", "item")
    return (
        best.withColumn("place", F.row_number().over(window))
        .where(F.col("place") <= n)
        .select(
            *[F.col(a).alias(g) for g, a in zip(groups, names, strict=True)],
            F.col("item"),
            (-F.col("b.s")).alias("score"),
            F.when(F.col("b.o") != _LAST, F.col("b.o")).alias("ord"),
            "place",
        )
    )
