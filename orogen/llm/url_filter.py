"""Temporal list join: every capture is judged by the list entries active when it was fetched.

Dated additions and removals of a pattern (a host or a parent domain) become disjoint
validity intervals; an as-of join by pattern and time finds those that hold. Built of
DataFrame functions only. Captures are first reduced to distinct (host, time), so a host with
a third of all captures costs one row for each time; skewed joins are left to Spark to split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import read

#: Fixed value: scheme, optional user, host.
HOST = "^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host(url: F.Column) -> F.Column:
    """The lower-case host of a URL, without a final dot; '' if it has none, null for null."""
    return F.regexp_replace(F.regexp_extract(F.lower(url), HOST, 1), "[.]$", "")


def validity(entries: DataFrame) -> DataFrame:
    """Rows (pattern, since, until): disjoint intervals [since, until) in which a pattern is listed.

    ``entries``: pattern, at, action ('add' or 'remove'). Repeats change nothing, an addition
    wins over a removal of the same time, ``until`` is null while the entry is still
    active. Entries with a null pattern, time or action, or another action, are ignored.
    """
    dated = entries.select(F.lower("pattern").alias("pattern"), "at", (F.col("action") == "add").alias("add"), "action")
    dated = dated.where("pattern is not null and at is not null and action in ('add', 'remove')").groupBy("pattern", "at").agg(F.bool_or("add").alias("add"))
    by = Window.partitionBy("pattern").orderBy("at")
    turns = dated.withColumn("before", F.lag("add").over(by)).where("add <> coalesce(before, false)")
    return turns.withColumn("until", F.lead("at").over(by)).where("add").select("pattern", F.col("at").alias("since"), "until")


def listed(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "fetched_at") -> DataFrame:
    """``captures`` with host, listed (boolean), list_pattern and listed_since.

    A pattern covers its host and the hosts below it; of several active patterns the
    longest is given. A capture without host or time is not listed. Repeated captures each
    keep their row; columns named like those added are replaced.
    """
    captures = captures.drop("host", "listed", "list_pattern", "listed_since").withColumn("host", host(F.col(url)))
    met = captures.select("host", F.col(at).alias("__at")).where("host <> '' and __at is not null").distinct()
    parts = F.split("host", "[.]")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    asked = met.select("host", "__at", F.explode(above).alias("pattern"))
    active = asked.join(validity(entries), "pattern").where("since <= __at and (until is null or __at < until)")
    best = active.groupBy("host", "__at").agg(F.max(F.struct(F.length("pattern").alias("n"), "pattern", "since")).alias("best"))
    verdict = best.select(F.col("host").alias("__host"), "__at", F.col("best.pattern").alias("list_pattern"), F.col("best.since").alias("listed_since"))
    out = captures.join(verdict, (F.col("host") == F.col("__host")) & (F.col(at) == F.col("__at")), "left")
    return out.withColumn("listed", F.col("list_pattern").isNotNull()).drop("__host", "__at")


def _entries(pages: DataFrame) -> DataFrame:
    """The query's list: a fourth of the hosts and of the two-label domains, added, removed and some added again."""
    hosts = pages.select(host(F.col("url")).alias("host")).where("host <> ''").distinct()
    names = hosts.select(F.col("host").alias("pattern")).union(hosts.select(F.substring_index("host", ".", -2))).distinct()
    k = F.conv(F.substring(F.md5("pattern"), 1, 6), 16, 10).cast("int")
    chosen = names.withColumn("k", k).where("k % 4 = 0").withColumn("day", F.expr("k % 300"))
    start = "date_add(date'2024-01-01', {})"
    return chosen.select("pattern", F.expr(start.format("day")).alias("at"), F.lit("add").alias("action")).union(
        chosen.select("pattern", F.expr(start.format("day + 1 + k % 61")), F.lit("remove"))
    ).union(chosen.where("k % 3 = 0").select("pattern", F.expr(start.format("day + 70 + k % 7")), F.lit("add")))


def op8_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.expr("date_add(date'2024-01-01', cast(page_id % 366 as int))"))
    return listed(captures, _entries(pages))


ORACLE = f"""
    WITH captures AS (
        SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS fetched_at,
            regexp_replace(regexp_extract(lower(url), '{HOST}', 1), '[.]$', '') AS host
        FROM pages),
    names AS (
        SELECT host AS pattern FROM captures WHERE host <> ''
        UNION SELECT array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') FROM captures WHERE host <> ''),
    chosen AS (
        SELECT pattern, k, k % 300 AS d FROM (SELECT pattern, CAST('0x' || substr(md5(pattern), 1, 6) AS INTEGER) AS k FROM names) WHERE k % 4 = 0),
    dated AS (
        SELECT pattern, DATE '2024-01-01' + d AS on_day, true AS listing FROM chosen
        UNION ALL SELECT pattern, DATE '2024-01-01' + (d + 1 + k % 61), false FROM chosen
        UNION ALL SELECT pattern, DATE '2024-01-01' + (d + 70 + k % 7), true FROM chosen WHERE k % 3 = 0),
    once AS (SELECT pattern, on_day, bool_or(listing) AS listing FROM dated GROUP BY pattern, on_day),
    turns AS (SELECT * FROM (SELECT *, lag(listing) OVER (PARTITION BY pattern ORDER BY on_day) AS before FROM once) WHERE listing <> coalesce(before, false)),
    spans AS (SELECT * FROM (SELECT pattern, on_day AS since, lead(on_day) OVER (PARTITION BY pattern ORDER BY on_day) AS until, listing FROM turns) WHERE listing),
    hits AS (
        SELECT c.page_id, s.pattern, s.since, row_number() OVER (PARTITION BY c.page_id ORDER BY length(s.pattern) DESC, s.pattern DESC, s.since DESC) AS n
        FROM captures c JOIN spans s ON (c.host = s.pattern OR ends_with(c.host, '.' || s.pattern))
            AND s.since <= c.fetched_at AND (s.until IS NULL OR c.fetched_at < s.until))
    SELECT c.page_id, c.url, c.fetched_at, c.host, h.pattern IS NOT NULL AS listed, h.pattern AS list_pattern, h.since AS listed_since
    FROM captures c LEFT JOIN hits h ON c.page_id = h.page_id AND h.n = 1
"""
