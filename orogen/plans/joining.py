"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.joins import asof_previous, nearest, nearest_value, ordered_pairs, range_join, sign_code
from ..tables import read


def semi_join(spark, sf_dir):
    big = read(spark, sf_dir, "orders").where("o_totalprice > 400000")
    customers = read(spark, sf_dir, "customer")
    return customers.join(big, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


def anti_join(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang")
    return docs.join(read(spark, sf_dir, "labels"), "doc_id", "left_anti")


def pair_theta(spark, sf_dir):
    nations = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return ordered_pairs(nations, "n_nationkey", F.col("a_n_regionkey") == F.col("b_n_regionkey"))


def interval_join(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    spans = read(spark, sf_dir, "events").where("event_type = 'purchase'")
    spans = spans.select(F.col("event_id").alias("span_id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("lo"))
    spans = spans.withColumn("hi", F.col("lo") + 3_600_000_000)
    met = range_join(events, spans, F.col("t"), F.col("lo"), F.col("hi"), 3_600_000_000)
    return met.groupBy("span_id").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))


def asof_prev(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    found = asof_previous(events, ["user_id"], "ts", F.when(F.col("event_type") == "purchase", F.col("value")), F.expr("ts - interval 7 days"), "last_purchase")
    return found.where("event_type = 'click'").select("event_id", "last_purchase")


def knn_ratio(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings")
    best = nearest(vectors, vectors, "vec_id", "embedding", "label", 2)
    pair = best.groupBy("q_id").agg(F.min_by("b_id", "rank").alias("match_id"), F.min("dist").alias("d1"), F.max("dist").alias("d2"), F.count(F.lit(1)).alias("n"))
    return pair.where("n = 2 and d1 <= 0.9 * d2").select("q_id", "match_id", F.round("d1", 6).alias("d1"))


#: Fixed planes: sign patterns of period 2, 4, 8 and 16.
PLANES = [[1.0 if (i >> p) & 1 else -1.0 for i in range(64)] for p in range(4)]


def lsh_candidates(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings").withColumn("code", sign_code(F.col("embedding"), PLANES))
    return vectors.groupBy("label", "code").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least_id"))


def set_ops(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    suppliers = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"))
    few = suppliers.where("nation % 3 <> 0")
    kinds = [("union", customers.union(suppliers).distinct()), ("intersect", customers.intersect(few)), ("except", customers.exceptAll(few).distinct().subtract(few))]
    out = None
    for kind, df in kinds:
        part = df.select(F.lit(kind).alias("kind"), "nation")
        out = part if out is None else out.union(part)
    return out


def backproject_rank(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", (F.col("o_custkey") % 25).alias("nation"))
    suppliers = read(spark, sf_dir, "supplier").where("s_acctbal > 0").select("s_suppkey", "s_acctbal", F.col("s_nationkey").cast("long").alias("nation"))
    found = nearest_value(orders, suppliers, ["nation"], F.col("o_totalprice") / 100, F.col("s_acctbal"), "s_suppkey", 100)
    return found.groupBy("o_orderkey").agg(F.min("best")["id"].alias("best_supplier"), F.sum("passing").alias("passing"))


QUERIES = {
    "semi_join": semi_join, "anti_join": anti_join, "pair_theta": pair_theta, "range_join": interval_join, "asof_prev": asof_prev, "knn_ratio": knn_ratio,
    "lsh_candidates": lsh_candidates, "set_ops": set_ops, "backproject_rank": backproject_rank,
}

_PLANE_SQL = " + ".join(
    "CASE WHEN list_sum(list_transform(range(1, 65), lambda i: CAST(embedding[i] AS DOUBLE) * (CASE WHEN ((i - 1) >> {p}) & 1 = 1 THEN 1.0 ELSE -1.0 END))) > 0 THEN {v} ELSE 0 END".format(p=p, v=1 << p) for p in range(4)
)
_L2 = "sqrt(list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: (CAST(a.embedding[i] AS DOUBLE) - CAST(b.embedding[i] AS DOUBLE)) * (CAST(a.embedding[i] AS DOUBLE) - CAST(b.embedding[i] AS DOUBLE)))))"

ORACLES = {
    "semi_join": "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)",
    "anti_join": "SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "pair_theta": """SELECT a.n_nationkey AS a_n_nationkey, a.n_regionkey AS a_n_regionkey, b.n_nationkey AS b_n_nationkey, b.n_regionkey AS b_n_regionkey
        FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey AND a.n_regionkey = b.n_regionkey""",
    "range_join": """SELECT s.event_id AS span_id, count(*) AS n, min(e.event_id) AS first_event FROM events e JOIN events s
        ON s.event_type = 'purchase' AND e.ts BETWEEN s.ts AND s.ts + INTERVAL 1 HOUR GROUP BY 1""",
    "asof_prev": """SELECT event_id, (CASE WHEN p.ts >= e.ts - INTERVAL 7 DAY THEN p.value END) AS last_purchase
        FROM (SELECT * FROM events WHERE event_type = 'click') e ASOF LEFT JOIN (SELECT ts, user_id, value FROM events WHERE event_type = 'purchase') p ON e.user_id = p.user_id AND e.ts > p.ts""",
    "knn_ratio": f"""WITH r AS (SELECT a.vec_id AS q_id, b.vec_id AS b_id, {_L2} AS dist FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id),
        t AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY dist, b_id) AS rank FROM r QUALIFY rank <= 2)
        SELECT q_id, arg_min(b_id, rank) AS match_id, round(min(dist), 6) AS d1 FROM t GROUP BY q_id HAVING count(*) = 2 AND min(dist) <= 0.9 * max(dist)""",
    "lsh_candidates": f"SELECT label, code, count(*) AS n, min(vec_id) AS least_id FROM (SELECT vec_id, label, CAST({_PLANE_SQL} AS INTEGER) AS code FROM embeddings) GROUP BY 1, 2",
    "set_ops": """WITH f AS (SELECT s_nationkey AS nation FROM supplier WHERE s_nationkey % 3 <> 0)
        SELECT 'union' AS kind, nation FROM (SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier)
        UNION ALL SELECT 'intersect', nation FROM (SELECT c_nationkey AS nation FROM customer INTERSECT SELECT nation FROM f)
        UNION ALL SELECT 'except', nation FROM (SELECT c_nationkey AS nation FROM customer EXCEPT SELECT nation FROM f)""",
    "backproject_rank": """SELECT o_orderkey, arg_min(s_suppkey, {'g': abs(o_totalprice / 100 - s_acctbal), 's': s_suppkey}) AS best_supplier, count(*) AS passing
        FROM orders JOIN supplier ON o_custkey % 25 = s_nationkey AND s_acctbal > 0 GROUP BY 1""",
}
