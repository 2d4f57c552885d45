"""Selections: best per group, cascades, reasons, scans, folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import extension, last_part, like_glob, url_host, url_path, url_scheme
from ..operators.joins import upsert
from ..operators.ranking import best_per_group, cascade, greedy_budget, islands, score_classes
from ..tables import read


def best_lines(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    rest = [F.col(c).asc() for c in lines.columns if c not in ("l_orderkey", "l_extendedprice")]
    return best_per_group(lines, ["l_orderkey"], [F.col("l_extendedprice").desc(), *rest])


def cascade_filters(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    known = docs.join(read(spark, sf_dir, "labels"), "doc_id", "left")
    prefer = [F.coalesce("quality", F.lit(-1)), -F.coalesce("toxic", F.lit(0)), F.col("n_chars"), -F.col("doc_id")]
    return cascade(known, ["lang", "source"], prefer).select("lang", "source", "doc_id", "n_chars")


def reject_reason(spark, sf_dir):
    url = F.col("url")
    reason = (
        F.when(~url_scheme(url).isin("http", "https"), "scheme").when(url.contains("?"), "query").when(url.contains("#"), "fragment")
        .when(~like_glob(url_host(url), "*.example.*"), "host").otherwise("accepted")
    )
    return read(spark, sf_dir, "pages").groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def url_parts(spark, sf_dir):
    url = F.col("url")
    return read(spark, sf_dir, "pages").select(
        "page_id", url_scheme(url).alias("scheme"), url_host(url).alias("host"), url_path(url).alias("path"),
        last_part(url_path(url)).alias("file"), extension(url_path(url)).alias("ext"),
    )


def scan_prefix(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    return part.where(F.col("p_brand").startswith("Brand#1") & (F.col("p_size") >= 10)).select("p_partkey", "p_brand", "p_size")


def upsert_merge(spark, sf_dir):
    base = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    changed = base.where("c_custkey % 7 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 100)
    added = base.where("c_custkey % 11 = 0").select((F.col("c_custkey") + 1_000_000_000).alias("c_custkey"), "c_name", "c_acctbal")
    return upsert(base, changed.union(added), ["c_custkey"]).withColumn("c_acctbal", F.round("c_acctbal", 2))


def point_lookup(spark, sf_dir):
    keys = read(spark, sf_dir, "nation").select((F.col("n_nationkey") * 3 + 1).cast("long").alias("c_custkey"))
    return read(spark, sf_dir, "customer").join(F.broadcast(keys), "c_custkey").select("c_custkey", "c_name")  # 25 nations


def budget_parts(spark, sf_dir):
    return greedy_budget(read(spark, sf_dir, "part"), [], ["p_partkey"], "p_size", 2010, ["p_partkey", "p_size"])


def limited_suppliers(spark, sf_dir):
    counts = read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    rows = read(spark, sf_dir, "supplier").join(counts, F.col("s_suppkey") == F.col("l_suppkey")).select("s_nationkey", "s_suppkey", "n")
    return greedy_budget(rows, ["s_nationkey"], ["s_suppkey"], "n", 1500, ["s_suppkey", "n"])


def supplier_classes(spark, sf_dir):
    return score_classes(read(spark, sf_dir, "supplier"), ["s_nationkey"], "s_acctbal", "s_suppkey", 1000.0)


def active_runs(spark, sf_dir):
    days = read(spark, sf_dir, "events").select("user_id", F.dayofmonth("ts").cast("int").alias("day"))
    return islands(days, ["user_id"], "day")


def coalesced_messages(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    newest = best_per_group(events, ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id").desc()])
    return best_per_group(newest, ["event_type"], [F.col("value").desc(), F.col("event_id")], 20).select("event_id", "user_id", "event_type", "value")


def voxel_top(spark, sf_dir):
    cells = [F.floor(F.col("embedding")[i].cast("double") * 4).cast("int").alias(f"c{i}") for i in range(3)]
    points = read(spark, sf_dir, "embeddings").select("vec_id", *cells)
    return best_per_group(points, ["c0", "c1", "c2"], [F.col("vec_id").asc()], 2)


QUERIES = {
    "best_per_group": best_lines, "cascade_filters": cascade_filters, "reject_reason": reject_reason, "url_parts": url_parts, "scan_prefix": scan_prefix,
    "upsert_merge": upsert_merge, "point_lookup": point_lookup, "greedy_budget": budget_parts, "greedy_limits": limited_suppliers,
    "score_classes": supplier_classes, "islands": active_runs, "coalesce_msgs": coalesced_messages, "voxel_topk": voxel_top,
}

ORACLES = {
    "best_per_group": """
        SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC,
            l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""",
    "cascade_filters": """
        WITH k AS (SELECT d.doc_id, lang, source, n_chars, coalesce(quality, -1) q, -coalesce(toxic, 0) t FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
        a AS (SELECT * FROM k QUALIFY q = max(q) OVER (PARTITION BY lang, source)),
        b AS (SELECT * FROM a QUALIFY t = max(t) OVER (PARTITION BY lang, source)),
        c AS (SELECT * FROM b QUALIFY n_chars = max(n_chars) OVER (PARTITION BY lang, source)),
        d AS (SELECT * FROM c QUALIFY doc_id = min(doc_id) OVER (PARTITION BY lang, source))
        SELECT lang, source, doc_id, n_chars FROM d""",
    "reject_reason": """
        SELECT CASE WHEN lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) NOT IN ('http', 'https') THEN 'scheme'
            WHEN contains(url, '?') THEN 'query' WHEN contains(url, '#') THEN 'fragment'
            WHEN NOT regexp_matches(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^[^/]*[.]example[.][^/]*$') THEN 'host'
            ELSE 'accepted' END AS reason, count(*) AS n FROM pages GROUP BY 1""",
    "url_parts": """
        SELECT page_id, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme,
            lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host, path,
            regexp_extract(path, '([^/]*)$', 1) AS file, lower(regexp_extract(path, '([.][^./]+)$', 1)) AS ext
        FROM (SELECT *, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path FROM pages)""",
    "scan_prefix": "SELECT p_partkey, p_brand, p_size FROM part WHERE starts_with(p_brand, 'Brand#1') AND p_size >= 10",
    "upsert_merge": """
        SELECT c_custkey, c_name, round(CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 100 ELSE c_acctbal END, 2) AS c_acctbal FROM customer
        UNION ALL SELECT c_custkey + 1000000000, c_name, round(c_acctbal, 2) FROM customer WHERE c_custkey % 11 = 0""",
    "point_lookup": "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT n_nationkey * 3 + 1 FROM nation)",
    "greedy_budget": """
        WITH RECURSIVE r AS (SELECT p_partkey, p_size, row_number() OVER (ORDER BY p_partkey) AS i FROM part),
        w AS (SELECT 0 AS i, 0 AS total, false AS kept UNION ALL
            SELECT r.i, CASE WHEN total + p_size <= 2010 THEN total + p_size ELSE total END, total + p_size <= 2010 FROM w JOIN r ON r.i = w.i + 1)
        SELECT CAST(row_number() OVER (ORDER BY r.i) - 1 AS INTEGER) AS pos, p_partkey, p_size FROM w JOIN r ON r.i = w.i WHERE kept""",
    "greedy_limits": """
        WITH RECURSIVE c AS (SELECT s_nationkey, s_suppkey, n, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS i
            FROM supplier JOIN (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1) ON s_suppkey = l_suppkey),
        w AS (SELECT DISTINCT s_nationkey, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS total, false AS kept FROM c UNION ALL
            SELECT c.s_nationkey, c.i, CASE WHEN total + n <= 1500 THEN total + n ELSE total END, total + n <= 1500 FROM w JOIN c ON c.s_nationkey = w.s_nationkey AND c.i = w.i + 1)
        SELECT s_nationkey, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY c.i) - 1 AS INTEGER) AS pos, s_suppkey, n
        FROM w JOIN c USING (s_nationkey, i) WHERE kept""",
    "score_classes": """
        WITH RECURSIVE c AS (SELECT s_nationkey, s_suppkey, s_acctbal, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS i FROM supplier),
        w AS (SELECT s_nationkey, i, s_acctbal AS head, 0 AS cls FROM c WHERE i = 1 UNION ALL
            SELECT c.s_nationkey, c.i, CASE WHEN head - s_acctbal > 1000 THEN s_acctbal ELSE head END, CASE WHEN head - s_acctbal > 1000 THEN cls + 1 ELSE cls END
            FROM w JOIN c ON c.s_nationkey = w.s_nationkey AND c.i = w.i + 1)
        SELECT s_nationkey, s_suppkey, cls AS score_class FROM w JOIN c USING (s_nationkey, i)""",
    "islands": """
        SELECT user_id, min(day) AS first, max(day) AS last, count(*) AS n FROM (
            SELECT user_id, day, day - row_number() OVER (PARTITION BY user_id ORDER BY day) AS run
            FROM (SELECT DISTINCT user_id, CAST(extract(day FROM ts) AS INTEGER) AS day FROM events)) GROUP BY user_id, run""",
    "coalesce_msgs": """
        SELECT event_id, user_id, event_type, value FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)
        QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) <= 20""",
    "voxel_topk": """
        SELECT vec_id, c0, c1, c2 FROM (SELECT vec_id, CAST(floor(CAST(embedding[1] AS DOUBLE) * 4) AS INTEGER) AS c0,
            CAST(floor(CAST(embedding[2] AS DOUBLE) * 4) AS INTEGER) AS c1, CAST(floor(CAST(embedding[3] AS DOUBLE) * 4) AS INTEGER) AS c2 FROM embeddings)
        QUALIFY row_number() OVER (PARTITION BY c0, c1, c2 ORDER BY vec_id) <= 2""",
}
