"""Raster, mesh, camera and colour queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as g
from ..operators import mesh, raster
from ..tables import read


def _vec(i):
    return g.vec(*[F.col("embedding")[i + k].cast("double") for k in range(3)])


def triangle_measures(spark, sf_dir):
    a, b, c = _vec(0), _vec(3), _vec(6)
    n = g.triangle_normal(a, b, c)
    return read(spark, sf_dir, "embeddings").select("vec_id", F.round(g.triangle_area(a, b, c), 6).alias("area"), F.round(n["z"], 6).alias("nz"))


def box_tests(spark, sf_dir):
    unit = g.box(g.vec(-0.1, -0.1, -0.1), g.vec(0.1, 0.1, 0.1))
    p = _vec(0)
    return read(spark, sf_dir, "embeddings").select("vec_id", g.box_contains(unit, p).alias("inside"), F.round(g.box_distance_squared(unit, p), 6).alias("d2"))


def camera_project(spark, sf_dir):
    c, a, h, v = g.vec(0, 0, -2), g.vec(0, 0, 1), g.vec(500, 0, 320), g.vec(0, 500, 240)
    px = g.cahv_project(_vec(0), c, a, h, v)
    return read(spark, sf_dir, "embeddings").select("vec_id", F.round(px["col"], 4).alias("col"), F.round(px["row"], 4).alias("row"), F.round(px["depth"], 6).alias("depth"))


def colour_spaces(spark, sf_dir):
    r, gr, b = (g.clamp(F.col("embedding")[i].cast("double") * 2 + 0.5, 0.0, 1.0) for i in range(3))
    hsv = g.rgb_to_hsv(r, gr, b)
    return read(spark, sf_dir, "embeddings").select(
        "vec_id", F.round(hsv["h"], 4).alias("h"), F.round(hsv["s"], 6).alias("s"), F.round(hsv["v"], 6).alias("v"), F.round(g.luminance(g.srgb_to_linear(r), g.srgb_to_linear(gr), g.srgb_to_linear(b)), 6).alias("y")
    )


def _image(spark, sf_dir):
    """One raster: events by day and hour, mean value."""
    return read(spark, sf_dir, "events").groupBy(F.lit("e").alias("img"), (F.dayofmonth("ts") - 1).alias("row"), F.hour("ts").alias("col"), F.lit(0).alias("band")).agg(F.avg("value").alias("val"))


def raster_rotate(spark, sf_dir):
    out = raster.rotate_clockwise(raster.crop(_image(spark, sf_dir), 4, 6, 10, 12), 10)
    return out.select("row", "col", F.round("val", 6).alias("val"))


def raster_box_blur(spark, sf_dir):
    return raster.box_blur(_image(spark, sf_dir), 2).select("row", "col", F.round("val", 5).alias("val"))


def raster_resize(spark, sf_dir):
    return raster.resize_nearest(_image(spark, sf_dir), 31, 24, 10, 36).select("row", "col", F.round("val", 6).alias("val"))


def raster_std_stretch(spark, sf_dir):
    return raster.std_stretch(_image(spark, sf_dir), 2.0).select("row", "col", F.round("val", 6).alias("val"))


def _faces(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    cols = [(F.col(c) % m).cast("int").alias(p) for c, m, p in (("l_partkey", 40, "p0"), ("l_suppkey", 40, "p1"), ("l_linenumber", 7, "p2"))]
    return lines.select(F.lit("m").alias("mesh"), F.hash("l_orderkey", "l_linenumber").alias("fid"), *cols)


def mesh_perimeter(spark, sf_dir):
    faces = mesh.dedupe_faces(mesh.drop_degenerate(_faces(spark, sf_dir)))
    return mesh.perimeter_edges(faces).select("a", "b")


def mesh_clean(spark, sf_dir):
    faces = mesh.dedupe_faces(mesh.drop_degenerate(_faces(spark, sf_dir)))
    return faces.select("p0", "p1", "p2")


def height_map(spark, sf_dir):
    points = read(spark, sf_dir, "embeddings").select(*[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate("xyz")])
    return mesh.mean_heights(points, 0.1).select("row", "col", F.round("z", 6).alias("z"), "n")


QUERIES = {
    "triangle_measures": triangle_measures, "box_tests": box_tests, "camera_project": camera_project, "colour_spaces": colour_spaces, "raster_rotate": raster_rotate,
    "raster_box_blur": raster_box_blur, "raster_resize": raster_resize, "raster_std_stretch": raster_std_stretch, "mesh_perimeter": mesh_perimeter, "mesh_clean": mesh_clean, "height_map": height_map,
}

_E = "(SELECT vec_id, {} FROM embeddings)".format(", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS e{i}" for i in range(1, 10)))
_IMG = "i AS (SELECT CAST(extract(day FROM ts) AS INTEGER) - 1 AS row, CAST(extract(hour FROM ts) AS INTEGER) AS col, avg(value) AS val FROM events GROUP BY 1, 2)"
_TRI = "t AS (SELECT CAST(l_partkey % 40 AS INTEGER) AS p, CAST(l_suppkey % 40 AS INTEGER) AS s, CAST(l_linenumber % 7 AS INTEGER) AS o FROM lineitem)"
_FACES = f"""{_TRI}, f AS (SELECT DISTINCT CASE WHEN p < s AND p < o THEN p WHEN s < p AND s < o THEN s ELSE o END AS p0, CASE WHEN p < s AND p < o THEN s WHEN s < p AND s < o THEN o ELSE p END AS p1,
    CASE WHEN p < s AND p < o THEN o WHEN s < p AND s < o THEN p ELSE s END AS p2 FROM t WHERE p <> s AND s <> o AND o <> p)"""
_LIN = "(CASE WHEN {0} <= 0.04045 THEN {0} / 12.92 ELSE pow(({0} + 0.055) / 1.055, 2.4) END)"

ORACLES = {
    "triangle_measures": f"""WITH v AS (SELECT vec_id, (e5 - e2) * (e9 - e3) - (e6 - e3) * (e8 - e2) AS x, (e6 - e3) * (e7 - e1) - (e4 - e1) * (e9 - e3) AS y, (e4 - e1) * (e8 - e2) - (e5 - e2) * (e7 - e1) AS z FROM {_E})
        SELECT vec_id, round(sqrt(x * x + y * y + z * z) / 2, 6) AS area, round(z / sqrt(x * x + y * y + z * z), 6) AS nz FROM v""",
    "box_tests": f"""SELECT vec_id, e1 BETWEEN -0.1 AND 0.1 AND e2 BETWEEN -0.1 AND 0.1 AND e3 BETWEEN -0.1 AND 0.1 AS inside,
        round(pow(greatest(abs(e1) - 0.1, 0), 2) + pow(greatest(abs(e2) - 0.1, 0), 2) + pow(greatest(abs(e3) - 0.1, 0), 2), 6) AS d2 FROM {_E}""",
    "camera_project": f"SELECT vec_id, round((500 * e1 + 320 * (e3 + 2)) / (e3 + 2), 4) AS col, round((500 * e2 + 240 * (e3 + 2)) / (e3 + 2), 4) AS row, round(e3 + 2, 6) AS depth FROM {_E}",
    "colour_spaces": f"""WITH c AS (SELECT vec_id, greatest(0, least(1, e1 * 2 + 0.5)) AS r, greatest(0, least(1, e2 * 2 + 0.5)) AS g, greatest(0, least(1, e3 * 2 + 0.5)) AS b FROM {_E}),
        m AS (SELECT *, greatest(r, g, b) AS top, greatest(r, g, b) - least(r, g, b) AS span FROM c)
        SELECT vec_id, round(CASE WHEN span = 0 THEN 0 WHEN top = r THEN 60 * (CASE WHEN g < b THEN (g - b) / span + 6 ELSE (g - b) / span END) WHEN top = g THEN 60 * ((b - r) / span + 2) ELSE 60 * ((r - g) / span + 4) END, 4) AS h,
        round(CASE WHEN top = 0 THEN 0 ELSE span / top END, 6) AS s, round(top, 6) AS v, round(0.2126 * {_LIN.format('r')} + 0.7152 * {_LIN.format('g')} + 0.0722 * {_LIN.format('b')}, 6) AS y FROM m""",
    "raster_rotate": f"WITH {_IMG} SELECT col - 6 AS row, 9 - (row - 4) AS col, round(val, 6) AS val FROM i WHERE row BETWEEN 4 AND 13 AND col BETWEEN 6 AND 17",
    "raster_box_blur": f"""WITH {_IMG}, h AS (SELECT row, col, avg(val) OVER (PARTITION BY row ORDER BY col RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS val FROM i)
        SELECT row, col, round(avg(val) OVER (PARTITION BY col ORDER BY row RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING), 5) AS val FROM h""",
    "raster_resize": f"""WITH {_IMG} SELECT r.t AS row, c.t AS col, round(val, 6) AS val FROM (SELECT unnest(range(10)) AS t) r, (SELECT unnest(range(36)) AS t) c, i
        WHERE i.row = r.t * 31 // 10 AND i.col = c.t * 24 // 36""",
    "raster_std_stretch": f"""WITH {_IMG}, s AS (SELECT avg(val) AS m, stddev_pop(val) AS d FROM i)
        SELECT row, col, round(greatest(0, least(1, (val - m) / (d * 4) + 0.5)), 6) AS val FROM i, s""",
    "mesh_perimeter": f"""WITH {_FACES}, e AS (SELECT p0 AS a, p1 AS b FROM f UNION SELECT p1, p2 FROM f UNION SELECT p2, p0 FROM f)
        SELECT a, b FROM e WHERE NOT EXISTS (SELECT 1 FROM e r WHERE r.a = e.b AND r.b = e.a)""",
    "mesh_clean": f"WITH {_FACES} SELECT p0, p1, p2 FROM f",
    "height_map": f"SELECT CAST(floor(e2 / 0.1) AS BIGINT) AS row, CAST(floor(e1 / 0.1) AS BIGINT) AS col, round(avg(e3), 6) AS z, count(*) AS n FROM {_E} GROUP BY 1, 2",
}
