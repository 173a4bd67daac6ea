"""Queries over cited sources. A wave of ``source_occurrences`` is a batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from citeloom import constants as C
from citeloom.functions import text, urls
from citeloom.operators import citations as op
from citeloom.operators import metrics, runs
from citeloom.plans.packages import NEST, package_source_rows
from citeloom.plans.registry import Registry
from citeloom.session import cut_lineage
from citeloom.sources.tables import table

registry = Registry()
WAVE = ["wave_id"]


def landed(spark, d):
    """Each occurrence once, in its latest delivery."""
    rows = table(spark, d, "source_occurrences").select(
        "occurrence_id", "wave_id", "question_id", "mode", "source_key", "domain", "title", "url", "rank", "item_pos", "source_pos",
        "landed_at"
    )
    return runs.latest(rows, ["occurrence_id"], ["landed_at"]).drop("occurrence_id", "landed_at")


def deduped(spark, d):
    return op.dedup(landed(spark, d), WAVE)


def kept(spark, d):
    """``deduped``, written once to the shared folder: ranks read it for rows and for the places of answers."""
    return cut_lineage(deduped(spark, d))


LANDED = """
WITH landed AS (SELECT occurrence_id, wave_id, question_id, mode, source_key, domain, title, url, "rank", item_pos, source_pos FROM source_occurrences
  QUALIFY row_number() OVER (PARTITION BY occurrence_id ORDER BY landed_at DESC, wave_id DESC, question_id DESC, mode DESC, source_key DESC, domain DESC NULLS LAST, title DESC NULLS LAST, url DESC, "rank" DESC) = 1),
one AS (SELECT * EXCLUDE (occurrence_id) FROM landed QUALIFY row_number() OVER (PARTITION BY wave_id, question_id, mode, source_key
  ORDER BY item_pos, source_pos, domain NULLS FIRST, title NULLS FIRST, url NULLS FIRST, "rank" NULLS FIRST) = 1),
scoped AS (SELECT *, mode AS scope FROM one UNION ALL SELECT *, 'all' FROM one),
seen AS (SELECT *, row_number() OVER (PARTITION BY wave_id, scope ORDER BY item_pos, source_pos, source_key) AS seen FROM scoped),
ranks AS (SELECT wave_id, scope, source_key, count(*) AS occurrence_count, count(DISTINCT question_id) AS question_count, sum("rank")::DOUBLE / count("rank") AS average_order,
  min(seen) AS first_seen_order, arg_min(struct_pack(domain := domain, title := title, url := url), seen) AS f, count(*)::DOUBLE / (SELECT count(*) FROM scoped s WHERE s.wave_id = seen.wave_id AND s.scope = seen.scope) AS share
  FROM seen GROUP BY wave_id, scope, source_key),
placed AS (SELECT *, row_number() OVER (PARTITION BY wave_id, scope ORDER BY occurrence_count DESC, question_count DESC, average_order, first_seen_order, source_key) AS place FROM ranks),
hosts AS (SELECT wave_id, scope, domain AS host, count(*) AS occurrence_count, count(DISTINCT question_id) AS question_count,
  count(*)::DOUBLE / (SELECT count(*) FROM scoped s WHERE s.wave_id = scoped.wave_id AND s.scope = scoped.scope) AS share
  FROM scoped WHERE domain <> '' GROUP BY wave_id, scope, domain),
host_placed AS (SELECT *, row_number() OVER (PARTITION BY wave_id, scope ORDER BY occurrence_count DESC, question_count DESC, host) AS place FROM hosts)
"""


@registry.add("cite_dedup",
    LANDED + "SELECT wave_id, question_id, mode, source_key, domain, title, url, \"rank\", item_pos, source_pos FROM one")
def cite_dedup(spark, d):
    return deduped(spark, d)


_RANK_COLUMNS = "wave_id, scope, source_key, f.domain AS domain, f.title AS title, f.url AS url, occurrence_count::BIGINT AS occurrence_count, question_count::BIGINT AS question_count, average_order, first_seen_order::BIGINT AS first_seen_order, share"


@registry.add("cite_rank_all", LANDED + f"SELECT {_RANK_COLUMNS} FROM ranks")
def cite_rank_all(spark, d):
    return op.source_ranks(kept(spark, d), WAVE)


@registry.add("cite_top10_by_scope", LANDED + f"SELECT {_RANK_COLUMNS}, place::INTEGER AS place FROM placed WHERE place <= 10")
def cite_top10_by_scope(spark, d):
    return op.top(op.source_ranks(kept(spark, d), WAVE), op.source_order(), WAVE)


@registry.add(
    "cite_concentration",
    LANDED
    + """SELECT wave_id, scope, sum(occurrence_count)::BIGINT AS total_occurrences, count(*)::BIGINT AS unique_keys, (sum(occurrence_count) FILTER (place <= 10))::BIGINT AS top_occurrences,
  (sum(occurrence_count) FILTER (place <= 10))::DOUBLE / sum(occurrence_count)::DOUBLE AS top_share, (sum(occurrence_count) FILTER (place > 10))::BIGINT AS outside_top FROM placed GROUP BY wave_id, scope""",
)
def cite_concentration(spark, d):
    return op.concentration(op.source_ranks(kept(spark, d), WAVE), op.source_order(), WAVE)


_HOST_COLUMNS = "wave_id, scope, host, occurrence_count::BIGINT AS occurrence_count, question_count::BIGINT AS question_count, share"


@registry.add("host_rank", LANDED + f"SELECT {_HOST_COLUMNS} FROM hosts")
def host_rank(spark, d):
    return op.host_ranks(deduped(spark, d), WAVE)


@registry.add("host_top10", LANDED + f"SELECT {_HOST_COLUMNS}, place::INTEGER AS place FROM host_placed WHERE place <= 10")
def host_top10(spark, d):
    return op.top(op.host_ranks(deduped(spark, d), WAVE), op.host_order(), WAVE)


def _host_concentration(rows):
    total = op.scoped(rows).groupBy("wave_id", "scope").agg(F.count(F.lit(1)).alias("total_occurrences"))
    return op.concentration(op.host_ranks(rows, WAVE), op.host_order(), WAVE, total)


@registry.add(
    "host_concentration",
    LANDED
    + """, totals AS (SELECT wave_id, scope, count(*) AS n FROM scoped GROUP BY wave_id, scope)
SELECT wave_id, scope, n::BIGINT AS total_occurrences, count(*)::BIGINT AS unique_keys, (sum(occurrence_count) FILTER (place <= 10))::BIGINT AS top_occurrences,
  (sum(occurrence_count) FILTER (place <= 10))::DOUBLE / n::DOUBLE AS top_share, (n - sum(occurrence_count) FILTER (place <= 10))::BIGINT AS outside_top
FROM host_placed JOIN totals USING (wave_id, scope) GROUP BY wave_id, scope, n""",
)
def host_concentration(spark, d):
    return _host_concentration(deduped(spark, d))


@registry.add(
    "cite_raw_and_valid_counts",
    LANDED
    + """SELECT wave_id, mode, (SELECT count(*) FROM landed l WHERE l.wave_id = one.wave_id AND l.mode = one.mode)::BIGINT AS raw_count, count(*)::BIGINT AS valid_count FROM one GROUP BY wave_id, mode""",
)
def cite_raw_and_valid_counts(spark, d):
    # One aggregate per answer and key: its rows are the raw ones, itself the valid one.
    keys = landed(spark, d).groupBy("wave_id", "question_id", "mode", "source_key").agg(F.count(F.lit(1)).alias("n"))
    return keys.groupBy("wave_id", "mode").agg(F.sum("n").alias("raw_count"), F.count(F.lit(1)).alias("valid_count"))


def _citations(spark, d):
    return table(spark, d, "qwen_sources").select("source_row_id", F.col("turn_id").alias("answer_id"), "rank", "title",
        text.strip(F.col("url")).alias("url"))


_SPACES = r"[\s\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x1c-\x1f]+"
_CITED = rf"""WITH cited AS (SELECT source_row_id, turn_id AS answer_id, "rank", title, regexp_replace(url, '^{_SPACES}|{_SPACES}$', '', 'g') AS url FROM qwen_sources)
"""


@registry.add(
    "cite_duplicate_flag",
    _CITED + """SELECT source_row_id, answer_id, url, row_number() OVER (PARTITION BY answer_id, url ORDER BY "rank", source_row_id) > 1 AS is_duplicate_in_answer FROM cited""",
)
def cite_duplicate_flag(spark, d):
    flagged = op.duplicate_flags(_citations(spark, d), "answer_id", "url", ["rank", "source_row_id"])
    return flagged.select("source_row_id", "answer_id", "url", "is_duplicate_in_answer")


@registry.add(
    "cite_rerank",
    _CITED + """SELECT answer_id, url, row_number() OVER (PARTITION BY answer_id ORDER BY r, i)::INTEGER AS "rank" FROM (
  SELECT answer_id, url, arg_min("rank", ("rank", source_row_id)) AS r, arg_min(source_row_id, ("rank", source_row_id)) AS i FROM cited GROUP BY answer_id, url)""",
)
def cite_rerank(spark, d):
    first = op.first_seen(_citations(spark, d), ["answer_id", "url"], ["rank", "source_row_id"])
    return op.rerank(first, "answer_id", ["rank", "source_row_id"]).select("answer_id", "url", "rank")


@registry.add(
    "cite_quick_cards",
    rf"""WITH cards AS (SELECT turn_id AS answer, title, url, source_row_id AS card_pos, CASE WHEN "rank" % 3 <> 0 THEN "rank" END AS refer_num FROM qwen_sources
  WHERE source_row_id % 5 <> 2 AND regexp_replace(title, '{_SPACES}', '', 'g') <> '' AND regexp_replace(url, '{_SPACES}', '', 'g') <> ''),
one AS (SELECT * FROM cards QUALIFY row_number() OVER (PARTITION BY answer, url ORDER BY card_pos) = 1),
placed AS (SELECT *, row_number() OVER (PARTITION BY answer ORDER BY card_pos) AS place FROM one),
ranked AS (SELECT *, coalesce(refer_num, place)::INTEGER AS r FROM placed)
SELECT answer, r AS "rank", title, url, row_number() OVER (PARTITION BY answer ORDER BY r, place)::INTEGER AS source_pos FROM ranked""",
)
def cite_quick_cards(spark, d):
    """Cards of one request; every fifth is another's."""
    cards = table(spark, d, "qwen_sources").select(
        F.col("turn_id").alias("answer"), F.when(F.col("source_row_id") % 5 == 2, "r2").otherwise("r1").alias("req_id"),
        F.when(F.col("rank") % 3 != 0, F.col("rank").cast("string")).alias("refer_num"), "title", "url",
        F.col("source_row_id").alias("card_pos")
    )
    return op.quick_cards(cards, F.lit("r1"))


@registry.add(
    "cite_research_links",
    _CITED + rf"""SELECT answer, row_number() OVER (PARTITION BY answer ORDER BY p)::INTEGER AS "rank", title, url FROM (
  SELECT answer_id AS answer, url, min(source_row_id) AS p, arg_min(t, source_row_id) AS title FROM (SELECT *, regexp_replace(title, '^{_SPACES}|{_SPACES}$', '', 'g') AS t FROM cited)
  WHERE regexp_matches(url, '^https?:') AND t <> '' GROUP BY answer_id, url)""",
)
def cite_research_links(spark, d):
    links = table(spark, d, "qwen_sources").select(F.col("turn_id").alias("answer"), F.col("url").alias("href"), "title",
        F.col("source_row_id").alias("link_pos"))
    return op.research_links(links)


_KEYS = r"""WITH u AS (SELECT DISTINCT url FROM source_occurrences WHERE url IS NOT NULL),
p AS (SELECT url, lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) AS scheme, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)) AS host, regexp_extract(url, '^[A-Za-z]+://[^/?#]*?(?::(\d+))?(?:[/?#]|$)', 1) AS port,
  regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS q FROM u),
keyed AS (SELECT url, scheme || '://' || host || CASE WHEN port = '' OR (scheme = 'http' AND port = '80') OR (scheme = 'https' AND port = '443') THEN '' ELSE ':' || port END
  || CASE WHEN path = '' THEN '/' ELSE path END
  || CASE WHEN len(list_filter(string_split(q, '&'), lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(spm|utm_[a-z]*)=?'))) = 0 THEN '' ELSE '?' || array_to_string(list_sort(list_filter(string_split(q, '&'), lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(spm|utm_[a-z]*)=?'))), '&') END AS canonical FROM p)
"""


@registry.add(
    "url_canonical",
    _KEYS + "SELECT url, canonical FROM keyed",
)
def url_canonical(spark, d):
    return table(spark, d, "source_occurrences").where(F.col("url").isNotNull()).select("url").distinct().withColumn("canonical",
        urls.canonical_url(F.col("url")))


@registry.add(
    "url_key_agreement",
    _KEYS + "SELECT mode, count(*)::BIGINT AS row_count, (count(*) FILTER (canonical = source_key))::BIGINT AS same_key, count(DISTINCT canonical)::BIGINT AS keys FROM source_occurrences JOIN keyed USING (url) GROUP BY mode",
)
def url_key_agreement(spark, d):
    """Keys rebuilt from urls against the landed ones."""
    rows = table(spark, d, "source_occurrences").where(F.col("url").isNotNull()).select("mode", "source_key",
        urls.canonical_url(F.col("url")).alias("key"))
    by_key = rows.groupBy("mode", "key").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("key") == F.col("source_key")).alias("same"))
    return by_key.groupBy("mode").agg(F.sum("n").alias("row_count"), F.sum("same").alias("same_key"), F.count(F.lit(1)).alias("keys"))


@registry.add(
    "url_domain",
    r"SELECT DISTINCT url, regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)), '^www\.', '') AS domain FROM source_occurrences WHERE url IS NOT NULL",
)
def url_domain(spark, d):
    return table(spark, d, "source_occurrences").where(F.col("url").isNotNull()).select("url").distinct().withColumn("domain",
        urls.domain(F.col("url")))


@registry.add(
    "url_site_name",
    r"""SELECT DISTINCT source_row_id, nullif(regexp_replace(lower(regexp_extract(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '([^@]*)$', 1)), '(:.*)|^www\.', '', 'g'), '') AS site FROM qwen_sources""",
)
def url_site_name(spark, d):
    return table(spark, d, "qwen_sources").select("source_row_id", urls.site_name(F.col("url")).alias("site")).distinct()


@registry.add(
    "metrics_sources",
    LANDED
    + """, s AS (SELECT wave_id, scope, sum(occurrence_count) AS n, count(*) AS k, sum(occurrence_count) FILTER (place <= 10) AS t FROM placed GROUP BY wave_id, scope),
h AS (SELECT wave_id, scope, count(*) AS k, sum(occurrence_count) FILTER (place <= 10) AS t FROM host_placed GROUP BY wave_id, scope)
SELECT wave_id, scope, s.n::BIGINT AS total_occurrences, s.k::BIGINT AS unique_sources, s.t::DOUBLE / s.n::DOUBLE AS source_top_share, h.k::BIGINT AS unique_hosts, h.t::DOUBLE / s.n::DOUBLE AS host_top_share
FROM s JOIN h USING (wave_id, scope)""",
)
def metrics_sources(spark, d):
    """The source metrics of every wave."""
    rows = kept(spark, d)
    sources = op.concentration(op.source_ranks(rows, WAVE), op.source_order(), WAVE)
    return metrics.source_metrics(sources, _host_concentration(rows), WAVE)


_HOST = r"regexp_replace(lower(regexp_extract(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '([^@]*)$', 1)), ':[0-9]*$|^www\.', '', 'g')"


@registry.add(
    "cite_occurrences",
    NEST + rf""", o AS (SELECT question_id, mode, turn_id AS item_pos, (row_number() OVER (PARTITION BY turn_id ORDER BY r, source_row_id) - 1)::INTEGER AS source_pos,
  regexp_replace(title, '^{_SPACES}|{_SPACES}$', '', 'g') AS title, url, r AS "rank" FROM s WHERE url <> '')
SELECT question_id, mode, item_pos, source_pos, title, url, "rank", {_HOST} AS domain FROM o
WHERE (question_id, mode) IN (SELECT question_id, mode FROM a WHERE regexp_replace(answer, '{_SPACES}', '', 'g') NOT IN ('', '{C.REFUSAL_SENTENCES[0]}'))""",
)
def cite_occurrences(spark, d):
    """Occurrences of the nested citations of valid answers; the keys of odd urls are checked by brute force in tests."""
    items = package_source_rows(spark, d).withColumns({"status": F.lit("pass"), "item_pos": F.col("turn_id")})
    return op.occurrences(items).drop("source_key")
