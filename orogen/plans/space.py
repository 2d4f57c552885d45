"""Spatial queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import spatial
from ..tables import read


def _points(spark, sf_dir):
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), *[(F.col("embedding")[i].cast("double") * 10).alias(c) for i, c in enumerate("xyz")])


def _boxes(spark, sf_dir):
    size = 0.2 + F.col("id") % 5 * 0.1
    return _points(spark, sf_dir).select("id", *[e.alias(f"{m}{a}") for a in "xyz" for m, e in (("min", F.col(a) - size), ("max", F.col(a) + size))])


def box_join(spark, sf_dir):
    return spatial.box_join(_boxes(spark, sf_dir), _boxes(spark, sf_dir), 1.0).where("left_id < right_id")


def radius_join(spark, sf_dir):
    near = spatial.within(_points(spark, sf_dir), _points(spark, sf_dir), 0.6).where("left_id < right_id")
    return near.select("left_id", "right_id", F.round("dist", 6).alias("dist"))


def leaf_groups(spark, sf_dir):
    pairs = spatial.box_join(_boxes(spark, sf_dir), _boxes(spark, sf_dir), 1.0)
    groups = spatial.dependency_groups(pairs, "left_id", "right_id", 4)
    return groups.select("left_id", F.array_join("deps", ",").alias("deps"), F.col("part").cast("long").alias("part"), "n")


def point_density(spark, sf_dir):
    out = spatial.density(_points(spark, sf_dir), 1.0, 4)
    return out.select("id", "neighbours", F.round("mean_dist", 6).alias("mean_dist"))


def hausdorff(spark, sf_dir):
    points = _points(spark, sf_dir)
    out = spatial.hausdorff(points.where("id % 2 = 0"), points.where("id % 2 = 1"), 2.0)
    return out.select(F.round("distance", 6).alias("distance"), "unmatched")


QUERIES = {"box_join": box_join, "radius_join": radius_join, "leaf_groups": leaf_groups, "point_density": point_density, "hausdorff": hausdorff}

_P = "p AS (SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) * 10 AS x, CAST(embedding[2] AS DOUBLE) * 10 AS y, CAST(embedding[3] AS DOUBLE) * 10 AS z, 0.2 + vec_id % 5 * 0.1 AS s FROM embeddings)"
_MEET = " AND ".join(f"a.{c} - a.s <= b.{c} + b.s AND b.{c} - b.s <= a.{c} + a.s" for c in "xyz")
_D = "sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z))"

ORACLES = {
    "box_join": f"WITH {_P} SELECT a.id AS left_id, b.id AS right_id FROM p a JOIN p b ON a.id < b.id AND {_MEET}",
    "radius_join": f"WITH {_P} SELECT a.id AS left_id, b.id AS right_id, round({_D}, 6) AS dist FROM p a JOIN p b ON a.id < b.id AND {_D} <= 0.6",
    "leaf_groups": f"""WITH {_P}, s AS (SELECT a.id AS left_id, array_to_string(list_sort(list(DISTINCT b.id)), ',') AS deps FROM p a JOIN p b ON {_MEET} GROUP BY 1),
        g AS (SELECT *, (row_number() OVER (PARTITION BY deps ORDER BY left_id) - 1) // 4 AS part FROM s) SELECT left_id, deps, part, count(*) OVER (PARTITION BY deps, part) AS n FROM g""",
    "point_density": f"""WITH {_P}, d AS (SELECT a.id, b.id AS other, {_D} AS dist FROM p a JOIN p b ON a.id <> b.id AND {_D} <= 1.0),
        k AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY dist, other) <= 4) SELECT id, count(*) AS neighbours, round(avg(dist), 6) AS mean_dist FROM k GROUP BY 1""",
    "hausdorff": f"""WITH {_P}, m AS (SELECT a.id, min({_D}) AS d FROM p a JOIN p b ON b.id % 2 = 1 WHERE a.id % 2 = 0 GROUP BY 1)
        SELECT round(max(CASE WHEN d <= 2 THEN d END), 6) AS distance, count(*) FILTER (d > 2) AS unmatched FROM m""",
}
