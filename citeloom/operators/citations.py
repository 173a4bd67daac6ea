"""Citations: occurrences, first-seen deduplication, source and host ranks per scope."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citeloom import constants as C
from citeloom.functions import text, urls


def occurrences(items: DataFrame) -> DataFrame:
    """One row per citation of a valid answer.

    ``items`` has question_id, mode, status, answer, sources and item_pos (the place of the task in
    its batch). Citations without a key (blank url) are dropped; ordinals keep the landed order.
    """
    valid = items.where(text.is_valid_answer(F.col("status"), F.col("answer")))
    rows = valid.select("question_id", "mode", "item_pos", F.posexplode("sources").alias("source_pos", "s"))
    url = text.strip(F.col("s.url"))
    return rows.select(
        "question_id", "mode", urls.canonical_url(url).alias("source_key"), urls.domain(url).alias("domain"),
        text.strip(F.col("s.title")).alias("title"), url.alias("url"),
        F.col("s.rank").alias("rank"), "item_pos", "source_pos",
    ).where(F.coalesce(F.col("source_key"), F.lit("")) != "")


#: The order in which occurrences were seen.
SEEN = ("item_pos", "source_pos")


def first_seen(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = SEEN) -> DataFrame:
    """The first row per key, by an aggregate that combines before the shuffle (no sort of a key's rows)."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order, *[c for c in rest if c not in order])).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in rows.columns])


def dedup(rows: DataFrame, batch: Sequence[str] = ()) -> DataFrame:
    """The first occurrence of each (question_id, mode, source_key)."""
    return first_seen(rows, [*batch, "question_id", "mode", "source_key"])


def scoped(rows: DataFrame) -> DataFrame:
    """Each row once per scope it belongs to: its mode and all."""
    return rows.withColumn("scope", F.explode(F.array("mode", F.lit("all"))))


#: Answers whose counts one window sums up.
BLOCK = 65_536


def _seen_orders(deduped: DataFrame, batch: Sequence[str]) -> DataFrame:
    """``deduped`` with its 1-based place in its mode (``seen_mode``) and in all rows (``seen_all``).

    ``item_pos`` stands for one answer. Rows are numbered in their answer, answers by sums within
    blocks of ``item_pos``, and blocks by the sums of the blocks before them, so no task sorts a
    whole scope.
    """
    answer = [*batch, "item_pos"]
    placed = deduped.withColumn("_in", F.row_number().over(Window.partitionBy(*answer).orderBy("source_pos", "source_key")))
    answers = deduped.groupBy(*answer, "mode").agg(F.count(F.lit(1)).alias("_n")).withColumn("_block", F.floor(F.col("item_pos") / BLOCK))

    def before(name: str, keys: list[str]) -> DataFrame:
        upto = lambda order, *by: Window.partitionBy(*keys, *by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        blocks = answers.groupBy(*keys, "_block").agg(F.sum("_n").alias("_b")).withColumn("_blocks",
            F.coalesce(F.sum("_b").over(upto("_block")), F.lit(0))).drop("_b")
        inner = answers.withColumn("_answers", F.coalesce(F.sum("_n").over(upto("item_pos", "_block")), F.lit(0)))
        matched = [inner[k].eqNullSafe(blocks[k]) for k in [*keys, "_block"]]
        return inner.join(blocks, matched).select(*[inner[k] for k in answer], (F.col("_blocks") + F.col("_answers")).alias(name))

    placed = placed.join(before("_mode", [*batch, "mode"]), answer).join(before("_all", list(batch)), answer)
    return placed.withColumns({"seen_mode": F.col("_mode") + F.col("_in"), "seen_all": F.col("_all") + F.col("_in")}).drop("_in", "_mode",
        "_all")


def source_ranks(deduped: DataFrame, batch: Sequence[str] = ()) -> DataFrame:
    """One row per (scope, source_key): counts, mean rank, first-seen order, share, and the first row's names.

    ``deduped`` comes from ``dedup``. A question cited in both modes counts once under all. Keys are
    grouped by question first, so that a hot key is spread; all scopes come of the same rows.
    """
    rows = _seen_orders(deduped, batch)
    inside = {s: F.lit(True) if s == "all" else F.col("mode") == s for s in C.SCOPES}
    seen = {s: F.col("seen_all" if s == "all" else "seen_mode") for s in C.SCOPES}
    by_question = rows.groupBy(*batch, "source_key", "question_id").agg(
        *[F.count_if(c).alias(f"n_{s}") for s, c in inside.items()],
        *[F.sum(F.when(c, F.col("rank"))).alias(f"rank_{s}") for s, c in inside.items()],
        *[F.count(F.when(c, F.col("rank"))).alias(f"ranked_{s}") for s, c in inside.items()],
        *[F.min(F.when(c, F.struct(seen[s].alias("seen"), "domain", "title", "url"))).alias(f"first_{s}") for s, c in inside.items()],
    )
    total = lambda c: F.sum(c).alias(c)
    by_key = by_question.groupBy(*batch, "source_key").agg(
        *[total(f"{c}_{s}") for s in C.SCOPES for c in ("n", "rank", "ranked")],
        *[F.count_if((F.col(f"n_{s}") > 0) & F.col("question_id").isNotNull()).alias(f"q_{s}") for s in C.SCOPES],
        *[F.min(f"first_{s}").alias(f"first_{s}") for s in C.SCOPES],
    )
    per_scope = F.array(
        *[
            F.struct(
                F.lit(s).alias("scope"), F.col(f"first_{s}").alias("first"), F.col(f"n_{s}").alias("occurrence_count"),
                F.col(f"q_{s}").alias("question_count"),
                F.try_divide(F.col(f"rank_{s}"), F.col(f"ranked_{s}")).alias("average_order"),
            )
            for s in C.SCOPES
        ]
    )
    ranks = by_key.select(*batch, "source_key", F.inline(per_scope)).where("occurrence_count > 0")
    keys = [*batch, "scope"]
    totals = scoped(deduped.select(*batch, "mode")).groupBy(*keys).agg(F.count(F.lit(1)).alias("_total"))
    return ranks.join(totals, keys).select(
        *keys, "source_key", "first.domain", "first.title", "first.url", "occurrence_count", "question_count", "average_order",
        F.col("first.seen").alias("first_seen_order"), (F.col("occurrence_count") / F.col("_total")).alias("share")
    )


def source_order() -> list[Column]:
    return [F.desc("occurrence_count"), F.desc("question_count"), F.asc("average_order"), F.asc("first_seen_order"), F.asc("source_key")]


def host_ranks(deduped: DataFrame, batch: Sequence[str] = ()) -> DataFrame:
    """One row per (scope, host); the share is of all occurrences, those without a host included."""
    keys = [*batch, "scope"]
    # By question first, so that a hot host is spread over its questions.
    by_question = deduped.groupBy(*batch, "domain", "question_id").agg(
        F.count_if(F.col("mode") == "quick").alias("quick"), F.count_if(F.col("mode") == "research").alias("research"),
        F.count(F.lit(1)).alias("all")
    )
    by_host = by_question.groupBy(*batch, "domain").agg(*[F.sum(s).alias(f"n_{s}") for s in C.SCOPES],
        *[F.count_if((F.col(s) > 0) & F.col("question_id").isNotNull()).alias(f"q_{s}") for s in C.SCOPES])
    per_scope = F.array(*[F.struct(F.lit(s).alias("scope"), F.col(f"n_{s}").alias("occurrence_count"),
        F.col(f"q_{s}").alias("question_count")) for s in C.SCOPES])
    hosts = by_host.select(*batch, F.col("domain").alias("host"), F.inline(per_scope)).where("occurrence_count > 0")
    totals = hosts.groupBy(*keys).agg(F.sum("occurrence_count").alias("_total"))
    named = hosts.where((F.col("host") != "") & F.col("host").isNotNull())
    return named.join(totals, keys).select(*keys, "host", "occurrence_count", "question_count",
        (F.col("occurrence_count") / F.col("_total")).alias("share"))


def host_order() -> list[Column]:
    return [F.desc("occurrence_count"), F.desc("question_count"), F.asc("host")]


def top(ranks: DataFrame, order: Sequence[Column], batch: Sequence[str] = (), limit: int = C.TOP_LIMIT) -> DataFrame:
    """The first rows of each scope with their place; Spark cuts to ``limit`` per task before the shuffle."""
    window = Window.partitionBy(*batch, "scope").orderBy(*order)
    return ranks.withColumn("place", F.row_number().over(window)).where(F.col("place") <= limit)


def concentration(ranks: DataFrame, order: Sequence[Column], batch: Sequence[str] = (), total: DataFrame | None = None,
    limit: int = C.TOP_LIMIT) -> DataFrame:
    """Totals per scope and what its top holds; every scope appears, with zeros where it has no rows."""
    keys = [*batch, "scope"]
    summed = ranks.groupBy(*keys).agg(F.sum("occurrence_count").alias("total_occurrences"), F.count(F.lit(1)).alias("unique_keys"))
    if total is not None:
        summed = summed.drop("total_occurrences").join(total, keys)
    best = top(ranks, order, batch, limit).groupBy(*keys).agg(F.sum("occurrence_count").alias("top_occurrences"))
    joined = summed.join(best, keys, "left")
    if not batch:
        static = ranks.sparkSession.createDataFrame([(s,) for s in C.SCOPES], "scope string")
        joined = static.join(joined, keys, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    out = joined.select(*keys, zero("total_occurrences"), zero("unique_keys"), zero("top_occurrences"))
    return out.withColumns(
        {"top_share": text.ratio(F.col("top_occurrences"), F.col("total_occurrences")),
        "outside_top": F.col("total_occurrences") - F.col("top_occurrences")}
    )


def duplicate_flags(rows: DataFrame, answer: str, url: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with is_duplicate_in_answer: not the first of its url in its answer. An answer's citations are few."""
    place = F.row_number().over(Window.partitionBy(answer, url).orderBy(*order))
    return rows.withColumn("is_duplicate_in_answer", place > 1)


def rerank(rows: DataFrame, answer: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with rank 1..n in each answer."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(answer).orderBy(*order)))


def quick_cards(cards: DataFrame, request: Column | None = None) -> DataFrame:
    """Sources of quick cards: A9 rows with answer, req_id, refer_num, title, url, card_pos.

    Cards of other requests, without title or url, and repeated urls are dropped; rank is refer_num
    or else the running place, and rows come in rank order by ``source_pos``.
    """
    known = cards if request is None else cards.where(F.col("req_id") == request)
    known = known.where((text.strip(F.col("title")) != "") & (text.strip(F.col("url")) != ""))
    first = first_seen(known, ["answer", "url"], ["card_pos"])
    placed = first.withColumn("place", F.row_number().over(Window.partitionBy("answer").orderBy("card_pos")))
    ranked = placed.withColumn("rank", F.coalesce(F.col("refer_num").try_cast("int"), F.col("place")))
    return ranked.withColumn("source_pos", F.row_number().over(Window.partitionBy("answer").orderBy("rank", "place"))).select("answer",
        "rank", "title", "url", "source_pos")


def research_links(links: DataFrame) -> DataFrame:
    """Sources of research links: answer, href, title, link_pos.

    Blank addresses and links without a title are dropped first, then repeated addresses (the first
    titled one stays), so a link without title takes no address away.
    """
    trimmed = links.select("answer", text.strip(F.col("href")).alias("url"), text.strip(F.col("title")).alias("title"),
        "link_pos").where(F.col("url").rlike("^https?:"))
    named = trimmed.where(F.coalesce(F.col("title"), F.lit("")) != "")
    return rerank(first_seen(named, ["answer", "url"], ["link_pos"]), "answer", ["link_pos"]).select("answer", "rank", "title", "url")
