"""Queries of problem 6."""

from __future__ import annotations

from pyspark.sql import functions as F

from citeloom.operators import hosts
from citeloom.plans.registry import Registry
from citeloom.sources.tables import table

registry = Registry()

COUNTS_SQL = """
WITH once AS (
  SELECT DISTINCT wave_id, domain AS host, question_id, mode, source_key FROM source_occurrences
  WHERE domain IS NOT NULL AND domain <> '' AND mode IN ('quick', 'research')),
scoped AS (SELECT wave_id, mode AS scope, host, question_id FROM once
  UNION ALL SELECT wave_id, 'all', host, question_id FROM once)
SELECT wave_id, scope, host, count(*)::BIGINT AS occurrence_count, count(DISTINCT question_id)::BIGINT AS question_count
FROM scoped GROUP BY wave_id, scope, host
"""


@registry.add(
    "p6_found",
    f"""
WITH fact AS ({COUNTS_SQL}),
claim AS (SELECT DISTINCT wave_id, scope, host, occurrence_count, question_count, TRUE AS there FROM host_rank_items
  WHERE host IS NOT NULL AND host <> '')
SELECT DISTINCT coalesce(f.wave_id, c.wave_id) AS wave_id, coalesce(f.scope, c.scope) AS scope, coalesce(f.host, c.host) AS host
FROM fact f FULL JOIN claim c ON f.wave_id = c.wave_id AND f.scope = c.scope AND f.host = c.host
WHERE f.host IS NULL OR c.host IS NULL OR f.occurrence_count IS DISTINCT FROM c.occurrence_count
   OR f.question_count IS DISTINCT FROM c.question_count
""",
)
def p6_found(spark, d):
    return hosts.host_disagreements(table(spark, d, "source_occurrences"), table(spark, d, "host_rank_items"))


@registry.add("p6_host_counts", COUNTS_SQL)
def p6_host_counts(spark, d):
    return hosts.host_counts(table(spark, d, "source_occurrences"))


@registry.add(
    "p6_host_rank_stats",
    """
SELECT wave_id, domain AS host, count(*)::BIGINT AS row_count, count(DISTINCT "rank")::BIGINT AS distinct_count,
  (SELECT min(r) FROM (SELECT "rank" AS r, count(*) AS n, max(count(*)) OVER () AS top FROM source_occurrences s
     WHERE s.wave_id IS NOT DISTINCT FROM o.wave_id AND s.domain = o.domain AND "rank" IS NOT NULL GROUP BY "rank") WHERE n = top) AS mode_value,
  quantile_cont("rank", 0.5) AS p50, quantile_cont("rank", 0.9) AS p90
FROM source_occurrences o WHERE domain IS NOT NULL AND domain <> '' GROUP BY wave_id, domain
""",
)
def p6_host_rank_stats(spark, d):
    rows = table(spark, d, "source_occurrences").where((F.col("domain") != "")).withColumnRenamed("domain", "host")
    weighted = hosts.weighted_values(rows, ["wave_id", "host"], "rank")
    return hosts.weighted_summary(weighted, ["wave_id", "host"])
