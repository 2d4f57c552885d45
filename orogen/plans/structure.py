"""Hierarchies, graphs, trees and identifiers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.text import geocode, hamming, sha_prefix, version_number
from ..operators.graph import components, hierarchy, quadtree
from ..tables import read


def _tree(spark, sf_dir):
    """Regions, nations and customers as one forest of string ids."""
    regions = read(spark, sf_dir, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent"))
    nations = read(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.concat(F.lit("r"), "n_regionkey").alias("parent"))
    customers = read(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.concat(F.lit("n"), "c_nationkey").alias("parent"))
    return regions.union(nations).union(customers)


def hierarchy_path(spark, sf_dir):
    return hierarchy(_tree(spark, sf_dir), "id", "parent", 4).select("node", F.array_join("path", "/").alias("path"), "depth", "root")


def lca(spark, sf_dir):
    """The deepest common ancestor of every customer and the next one."""
    paths = hierarchy(_tree(spark, sf_dir), "id", "parent", 4).select("node", "path")
    keys = read(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("a"), F.concat(F.lit("c"), (F.col("c_custkey") + 1).cast("string")).alias("b"))
    met = keys.join(paths.toDF("a", "pa"), "a").join(paths.toDF("b", "pb"), "b")
    common = F.filter("pa", lambda x: F.array_contains("pb", x))
    return met.select("a", "b", F.try_element_at(common, F.lit(-1)).alias("lca"))


def _edges(spark, sf_dir):
    """Each order and its customer's next one: a path for each customer."""
    following = F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderdate", F.col("o_orderkey") % 7, "o_orderkey"))
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("a"), F.coalesce(following, "o_orderkey").alias("b"))


def part_components(spark, sf_dir):
    return components(_edges(spark, sf_dir), "a", "b")


def _points():
    return F.col("embedding")[0].cast("double") / 2 + 0.5, F.col("embedding")[1].cast("double") / 2 + 0.5


def quadtree_nodes(spark, sf_dir):
    x, y = _points()
    nodes = quadtree(read(spark, sf_dir, "embeddings"), x, y, 40, 6)
    return nodes.select("level", "code", "n", "is_leaf", *[F.round(c, 6).alias(c) for c in ("min_x", "max_x", "min_y", "max_y")])


def bounds_rollup(spark, sf_dir):
    """Leaf bounds rolled up to the level-1 cells above them."""
    x, y = _points()
    leaves = quadtree(read(spark, sf_dir, "embeddings"), x, y, 40, 6).where("is_leaf and level >= 1")
    top = leaves.withColumn("top", F.expr("shiftright(code, 2 * (level - 1))"))
    return top.groupBy("top").agg(F.sum("n").alias("n"), F.round(F.min("min_x"), 6).alias("min_x"), F.round(F.max("max_x"), 6).alias("max_x"), F.count(F.lit(1)).alias("leaves"))


def topo_levels(spark, sf_dir):
    """Rounds after which each inner node of the quadtree can be built: one more than its highest child."""
    x, y = _points()
    nodes = quadtree(read(spark, sf_dir, "embeddings"), x, y, 40, 6)
    leaves = nodes.where("is_leaf").select(F.col("level").alias("leaf_level"), "code")
    above = leaves.select("leaf_level", F.explode(F.sequence(F.lit(0), "leaf_level")).alias("level"), "code")
    height = above.withColumn("code", F.expr("shiftright(code, 2 * (leaf_level - level))")).groupBy("level", "code").agg(F.max(F.col("leaf_level") - F.col("level")).alias("ready"))
    return height.groupBy("ready").agg(F.count(F.lit(1)).alias("n"))


def dedupe_rotation(spark, sf_dir):
    """Triangles up to rotation: each starts at its least corner."""
    lines = read(spark, sf_dir, "lineitem")
    p, s, o = (F.col("l_partkey") % 9), (F.col("l_suppkey") % 9), (F.col("l_orderkey") % 9)
    tri = lines.select(p.alias("p"), s.alias("s"), o.alias("o")).where("p <> s and s <> o and o <> p")
    rot = F.expr("case when p < s and p < o then struct(p as p0, s as p1, o as p2) when s < p and s < o then struct(s as p0, o as p1, p as p2) else struct(o as p0, p as p1, s as p2) end")
    return tri.select(rot.alias("t")).select("t.*").distinct()


def hamming_pairs(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("event_id", "user_id")
    return events.groupBy(hamming(F.col("event_id"), F.col("user_id")).cast("int").alias("bits")).agg(F.count(F.lit(1)).alias("n"))


def sha_ids(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", sha_prefix(F.col("p_name")).alias("id"))


def geo_encode(spark, sf_dir):
    lon, lat = F.col("embedding")[0].cast("double") * 180, F.col("embedding")[1].cast("double") * 90
    return read(spark, sf_dir, "embeddings").select("vec_id", geocode(lon, lat, 6).alias("cell"))


def version_values(spark, sf_dir):
    text = F.upper(F.substring(F.md5("p_name"), 1, 2))
    return read(spark, sf_dir, "part").select("p_partkey", version_number(text).alias("version"))


QUERIES = {
    "hierarchy_path": hierarchy_path, "lca": lca, "components": part_components, "quadtree": quadtree_nodes, "bounds_rollup": bounds_rollup, "topo_levels": topo_levels,
    "dedupe_rotation": dedupe_rotation, "hamming": hamming_pairs, "sha_prefix": sha_ids, "geo_encode": geo_encode, "version_number": version_values,
}

_TREE = """t AS (SELECT 'r' || r_regionkey AS id, NULL AS parent FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation
    UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer),
    w AS (SELECT id AS node, [id] AS path, id AS root FROM t WHERE parent IS NULL UNION ALL SELECT t.id, list_append(path, t.id), root FROM w JOIN t ON t.parent = w.node)"""
_BITS = " + ".join(f"((((cx >> {b}) & 1) << {2 * b}) + (((cy >> {b}) & 1) << {2 * b + 1}))" for b in range(6))
_QUAD = f"""p AS (SELECT CAST(embedding[1] AS DOUBLE) / 2 + 0.5 AS x, CAST(embedding[2] AS DOUBLE) / 2 + 0.5 AS y FROM embeddings),
    c AS (SELECT x, y, level, CAST(greatest(0, least((1 << level) - 1, floor(x * (1 << level)))) AS BIGINT) AS cx, CAST(greatest(0, least((1 << level) - 1, floor(y * (1 << level)))) AS BIGINT) AS cy
        FROM p, (SELECT CAST(unnest(range(7)) AS INTEGER) AS level)),
    k AS (SELECT level, {_BITS} AS code, count(*) AS n, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y FROM c GROUP BY 1, 2),
    q AS (SELECT k.*, k.n <= 40 OR k.level = 6 AS is_leaf FROM k LEFT JOIN k u ON u.level = k.level - 1 AND u.code = k.code >> 2 WHERE k.level = 0 OR u.n > 40)"""

ORACLES = {
    "hierarchy_path": f"WITH RECURSIVE {_TREE} SELECT node, array_to_string(path, '/') AS path, CAST(len(path) - 1 AS INTEGER) AS depth, root FROM w",
    "lca": f"""WITH RECURSIVE {_TREE} SELECT 'c' || c_custkey AS a, b.node AS b, list_filter(a.path, lambda x: list_contains(b.path, x))[-1] AS lca
        FROM customer JOIN w a ON a.node = 'c' || c_custkey JOIN w b ON b.node = 'c' || (c_custkey + 1)""",
    "components": "SELECT o_orderkey AS node, min(o_orderkey) OVER (PARTITION BY o_custkey) AS component FROM orders",
    "quadtree": f"WITH {_QUAD} SELECT level, code, n, is_leaf, round(min_x, 6) AS min_x, round(max_x, 6) AS max_x, round(min_y, 6) AS min_y, round(max_y, 6) AS max_y FROM q",
    "bounds_rollup": f"""WITH {_QUAD} SELECT code >> (2 * (level - 1)) AS top, CAST(sum(n) AS BIGINT) AS n, round(min(min_x), 6) AS min_x, round(max(max_x), 6) AS max_x, count(*) AS leaves
        FROM q WHERE is_leaf AND level >= 1 GROUP BY 1""",
    "topo_levels": f"""WITH RECURSIVE {_QUAD}, h AS (SELECT level, code, 0 AS ready FROM q WHERE is_leaf UNION SELECT level - 1, code >> 2, ready + 1 FROM h WHERE level > 0)
        SELECT ready, count(*) AS n FROM (SELECT level, code, max(ready) AS ready FROM h GROUP BY 1, 2) GROUP BY 1""",
    "dedupe_rotation": """SELECT DISTINCT CASE WHEN p < s AND p < o THEN p WHEN s < p AND s < o THEN s ELSE o END AS p0, CASE WHEN p < s AND p < o THEN s WHEN s < p AND s < o THEN o ELSE p END AS p1,
        CASE WHEN p < s AND p < o THEN o WHEN s < p AND s < o THEN p ELSE s END AS p2
        FROM (SELECT l_partkey % 9 AS p, l_suppkey % 9 AS s, l_orderkey % 9 AS o FROM lineitem) WHERE p <> s AND s <> o AND o <> p""",
    "hamming": "SELECT CAST(bit_count(xor(event_id, user_id)) AS INTEGER) AS bits, count(*) AS n FROM events GROUP BY 1",
    "sha_prefix": "SELECT p_partkey, substr(sha256(p_name), 1, 40) AS id FROM part",
    "geo_encode": """SELECT vec_id, CAST(list_sum(list_transform(range(6), lambda i: (((cx >> i) & 1) << (2 * i + 1)) + (((cy >> i) & 1) << (2 * i)))) AS BIGINT) AS cell FROM (
        SELECT vec_id, CAST(greatest(0, least(63, floor((CAST(embedding[1] AS DOUBLE) * 180 + 180) / 360 * 64))) AS BIGINT) AS cx,
            CAST(greatest(0, least(63, floor((CAST(embedding[2] AS DOUBLE) * 90 + 90) / 180 * 64))) AS BIGINT) AS cy FROM embeddings)""",
    "version_number": """SELECT p_partkey, CAST((CASE WHEN a <= '9' THEN ascii(a) - 48 ELSE ascii(a) - 55 END) * 10 + (CASE WHEN b <= '9' THEN ascii(b) - 48 ELSE ascii(b) - 55 END) AS BIGINT) AS version
        FROM (SELECT p_partkey, upper(substr(md5(p_name), 1, 1)) AS a, upper(substr(md5(p_name), 2, 1)) AS b FROM part)""",
}
