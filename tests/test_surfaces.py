"""Heights, texels, rays, outlines, matches and raster operators against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orogen.cli import height_mesh
from orogen.functions import geometry as g
from orogen.operators import matching, raster, surfaces

VERTEX = "mesh string, vid long, x double, y double, z double, nx double, ny double, nz double, u double, v double"


def tables(spark, v, f, name="m"):
    vertices = spark.createDataFrame([(name, i, *row) for i, row in enumerate(v.tolist())], VERTEX)
    return vertices, spark.createDataFrame([(name, i, *row) for i, row in enumerate(f.tolist())], "mesh string, fid long, p0 long, p1 long, p2 long")


def image(spark, a, name="i"):
    return spark.createDataFrame([(name, r, c, 0, float(v)) for r, line in enumerate(a) for c, v in enumerate(line)], "img string, row int, col int, band int, val double")


def test_heights(spark):
    a = np.fromfunction(lambda r, c: 0.5 * r - 0.25 * c, (4, 5))
    points = surfaces.dem_normals(surfaces.dem_points(image(spark, a), 2.0, 4, 5))
    got = {(r["row"], r["col"]): (r["x"], r["y"], r["nx"], r["ny"], r["nz"]) for r in points.collect()}
    plane = np.array([0.125, 0.25, 1.0]) / np.linalg.norm([0.125, 0.25, 1.0])
    assert got[0, 0][:2] == (-4.0, 3.0) and all(np.allclose(v[2:], plane) for v in got.values())
    alone = surfaces.dem_normals(surfaces.dem_points(image(spark, [[1.0]]), 2.0, 1, 1)).first()
    assert alone["nx"] is None
    asked = spark.createDataFrame([(1, 0.0, 0.0), (2, 50.0, 0.0), (3, 2.0, 2.0)], "id int, row double, col double")
    heights = {r["id"]: r["height"] for r in surfaces.window_mean(image(spark, a), asked, 1, missing=0.0).collect()}
    near = a[:2, :2]
    assert heights[1] == pytest.approx(near[near != 0].mean()) and heights[2] is None and heights[3] == pytest.approx(a[1:4, 1:4][a[1:4, 1:4] != 0].mean())
    ball = points.withColumns({f"n{c}": F.col(c) / 5 for c in "xyz"})  # a sphere of radius 5 has curvature 1 / 5
    assert all(r["curvature"] is None or abs(r["curvature"] - 0.2) < 1e-9 for r in surfaces.grid_curvatures(ball).collect())
    level = spark.range(1).select(*[surfaces.tilt(F.lit(0.0), F.lit(0.6), F.lit(-0.8), m) for m in ("acos", "abs", "level")]).first()
    assert np.allclose(list(level), [np.arccos(0.8) / (np.pi / 2), 0.2, 0.6])


def test_texels_and_rays(spark):
    rng = np.random.default_rng(1)
    v, f = height_mesh(rng.uniform(0, 2, (6, 6)), 1.0)
    vertices, faces = tables(spark, v, f)
    rows = surfaces.texels(vertices, faces, 8, 8).collect()
    assert len(rows) == 64
    for r in rows:
        assert r["x"] == pytest.approx(((r["col"] + 0.5) / 8 - 0.5) * 5) and r["y"] == pytest.approx((0.5 - (r["row"] + 0.5) / 8) * 5) and 0 <= r["z"] <= 2
    origin = np.column_stack([rng.uniform(-2, 2, (30, 2)), np.full(30, 9.0)])
    aim = np.column_stack([rng.uniform(-0.3, 0.3, (30, 2)), np.full(30, -1.0)])
    aim /= np.linalg.norm(aim, axis=1, keepdims=True)
    rays = spark.createDataFrame([(i, *o, *d, 8.0) for i, (o, d) in enumerate(zip(origin.tolist(), aim.tolist(), strict=True))], "ray int, ox double, oy double, oz double, dx double, dy double, dz double, length double")
    got = {r["ray"]: (r["fid"], r["distance"]) for r in surfaces.raycast(rays, vertices, faces, 1.0, 12.0).collect()}
    want = {}
    for i, (o, d) in enumerate(zip(origin, aim, strict=True)):
        for k, tri in enumerate(f):
            a, b, c = v[tri, :3]
            m = np.column_stack([b - a, c - a, -d])
            s, t, far = np.linalg.solve(m, o - a)
            if s >= 0 and t >= 0 and s + t <= 1 and 0 <= far <= 12 and far < want.get(i, (0, 99))[1]:
                want[i] = (k, far)
    assert set(got) == set(want) and all(got[i][1] == pytest.approx(want[i][1]) for i in want)
    hidden = {r["ray"] for r in surfaces.occluded(rays, vertices, faces, 1.0, 12.0).collect()}
    assert hidden == {i for i, (_, far) in want.items() if far < 8 - 1e-3}


def test_outlines(spark):
    v, f = height_mesh(np.zeros((4, 4)), 1.0)
    f = f[[i for i in range(len(f)) if not set(f[i].tolist()) & {5}]]  # without the faces about one inner corner
    vertices, faces = tables(spark, v, f)
    rings = surfaces.boundary_rings(faces).orderBy("ring").collect()
    assert sum(r["size"] for r in rings) == len({(a, b) for t in f.tolist() for a, b in zip(t, t[1:] + t[:1], strict=True)} - {(b, a) for t in f.tolist() for a, b in zip(t, t[1:] + t[:1], strict=True)})
    assert rings[0]["size"] >= rings[-1]["size"] and rings[0]["vids"][0] == min(rings[0]["vids"])
    v2, f2 = surfaces.skirt(vertices, faces, -2.0)
    n = sum(r["size"] for r in rings)
    assert f2.count() == len(f) + 2 * n and {r["z"] for r in v2.collect()} == {0.0, -2.0}
    closed = surfaces.boundary_rings(f2).collect()  # only the lower rim is open now
    low = {r["vid"] for r in v2.where("z < 0").collect()}
    assert sum(r["size"] for r in closed) == n and all(set(r["vids"]) <= low for r in closed)
    one, faces_one = surfaces.merged(vertices.unionByName(tables(spark, v, f, "n")[0]), faces.unionByName(tables(spark, v, f, "n")[1]), "all")
    assert one.select("vid").distinct().count() == 2 * len(v) and faces_one.agg(F.max("p2")).first()[0] < 2 * len(v) and faces_one.select("fid").distinct().count() == 2 * len(f)
    source = vertices.withColumn("u", F.lit(7.0))
    assert surfaces.copied_attributes(vertices, source.where("x < 0"), ["x", "y"], ["u"]).where("u = 7").count() == vertices.where("x < 0").count()
    shades = {r["shade"] for r in surfaces.elevation_colours(vertices).collect()}
    assert shades == {0.5}


def test_names_and_urls(spark):
    tiles = spark.createDataFrame([("012",), ("03",)], "tile string")
    got = {r["tile"]: (r["parent"], r["given"]) for r in surfaces.connected_by_name(tiles, 9).collect()}
    assert got == {"0": ("root", False), "01": ("0", False), "012": ("01", True), "03": ("0", True)}
    with pytest.raises(ValueError):
        surfaces.connected_by_name(tiles, 2)
    nodes = spark.createDataFrame([("a", None, ["a"]), ("b", "a", ["a", "b"]), ("c", "b", ["a", "b", "c"]), ("d", "a", ["a", "d"])], "node string, parent string, path array<string>")
    assert sorted(r["node"] for r in surfaces.inner_nodes(nodes).collect()) == ["a", "b"] and [r["node"] for r in surfaces.depth_first(nodes).collect()] == list("abcd")
    urls = spark.createDataFrame([(1, "x/P1_a.iv"), (0, "y/P1_b.iv"), (2, "x/P2_a.iv"), (3, "none")], "at int, url string")
    assert {r["id"]: r["url"] for r in surfaces.first_seen(urls, "(P\\d)", "at").collect()} == {"P1": "y/P1_b.iv", "P2": "x/P2_a.iv"}
    files = spark.createDataFrame([("a.png",), ("a.IMG",), ("a.x",), ("b.x",)], "url string")
    assert {r["base"]: (r["url"], r["others"]) for r in surfaces.preferred_extensions(files, ["img", "png"]).collect()} == {"a": ("a.IMG", ["a.png", "a.x"]), "b": ("b.x", [])}
    grid = surfaces.flat_tiles(spark, (0.0, 0.0), (5.0, 2.0), 2.0).collect()
    assert len(grid) == 3 and max(r["x1"] for r in grid) == 5.0 and {r["y1"] for r in grid} == {2.0}


def test_matches(spark):
    rng = np.random.default_rng(3)
    m = rng.uniform(0, 100, (40, 2))
    turn = np.array([[np.cos(0.4), -np.sin(0.4)], [np.sin(0.4), np.cos(0.4)]])
    f = m @ turn.T + [5, -3]
    f[:8] += rng.uniform(20, 60, (8, 2))
    rows = [("p", i, *a, *b) for i, (a, b) in enumerate(zip(m.tolist(), f.tolist(), strict=True))]
    df = spark.createDataFrame(rows, matching.MATCH)
    for tries in (200, 5000):
        assert sorted(r["match"] for r in matching.MATCH_FILTERS["ransac"](df, 0.5, tries).collect()) == list(range(8, 40))
    kept = {r["match"] for r in matching.MATCH_FILTERS["gtm"](df).collect()}
    assert kept <= set(range(8, 40)) and len(kept) >= 16
    assert matching.ransac_matches(df.limit(1), 1.0).count() == 0
    lengths = spark.createDataFrame([("p", i, 10.0 + i % 3) for i in range(9)] + [("p", 9, 99.0)], "pair string, match int, length double")
    assert matching.usual_lengths(lengths, 3.0).count() == 9
    edges = spark.createDataFrame([("a", "b", 5, np.pi / 2, 1.0, 0.0), ("b", "c", 5, 0.0, 1.0, 0.0), ("d", "c", 1, 0.0, 0.0, 2.0), ("a", "d", 9, 0.0, 7.0, 7.0), ("x", "y", 1, 0.0, 0.0, 0.0)], "a string, b string, n int, angle double, x double, y double")
    got = {r["node"]: (r["steps"], round(r["angle"], 6), round(r["x"], 6), round(r["y"], 6)) for r in matching.pose_tree(edges, "a").collect()}
    assert got["b"] == (1, 1.570796, 1.0, 0.0) and got["d"] == (1, 0.0, 7.0, 7.0) and got["c"] == (2, 1.570796, 1.0, 1.0) and set(got) == set("abcd")
    back = {r["node"]: (round(r["x"], 6), round(r["y"], 6)) for r in matching.pose_tree(edges, "b").collect()}
    assert back["a"] == (0.0, 1.0)


def test_rasters(spark):
    rng = np.random.default_rng(4)
    a = rng.uniform(0, 9, (5, 6))
    px = image(spark, a)
    points = spark.createDataFrame([("i", 1, 2.0, 3.0), ("i", 2, 1.5, 2.25), ("i", 3, 0.2, 4.9)], "img string, id int, row double, col double")
    got = {r["id"]: r["val"] for r in raster.sample_bicubic(px, points, 5, 6).collect()}

    def cubic(p, t):
        return p[1] + 0.5 * t * (p[2] - p[0] + t * (2 * p[0] - 5 * p[1] + 4 * p[2] - p[3] + t * (3 * (p[1] - p[2]) + p[3] - p[0])))

    for i, y, x in ((1, 2.0, 3.0), (2, 1.5, 2.25), (3, 0.2, 4.9)):
        r, c = int(y), int(x)
        square = [[a[min(max(r + i, 0), 4), min(max(c + j, 0), 5)] for j in (-1, 0, 1, 2)] for i in (-1, 0, 1, 2)]
        assert got[i] == pytest.approx(cubic([cubic(line, x - c) for line in square], y - r))
    unit = [r["val"] for r in raster.normalize(px).collect()]
    assert min(unit) == 0 and max(unit) == 1
    assert raster.trim(px, (F.col("row") > 1) & (F.col("col").between(2, 3))).agg(F.max("row"), F.max("col")).first()[:] == (2, 1)
    whole = raster.densify(px.where("row <> col"), 5, 6, -1.0)
    assert whole.count() == 30 and whole.where("val = -1").count() == 5
    bytes_ = px.withColumn("val", F.round("val"))
    back = raster.convert_range(raster.convert_range(bytes_, "uint8"), "uint8", False)
    assert back.join(bytes_.withColumnRenamed("val", "w"), ["img", "row", "col", "band"]).where("val <> w").count() == 0
    stats = lambda m, d: spark.createDataFrame([("i", m, d)], "img string, median double, mad double")
    moved = raster.match_luminance(px, stats(4.0, 2.0), stats(10.0, 1.0), 0.5).where("row = 0 and col = 0").first()["val"]
    assert moved == pytest.approx(7 + (a[0, 0] - 4) / 2 * 1.5)
    rgb = spark.createDataFrame(rng.uniform(0, 1, (30, 3)).tolist(), "r double, g double, b double")
    lab = rgb.withColumn("l", g.rgb_to_lab(F.col("r"), F.col("g"), F.col("b")))
    for r in lab.withColumn("back", g.lab_to_rgb(F.col("l.l"), F.col("l.a"), F.col("l.b"))).collect():
        assert np.allclose(list(r["back"]), [r["r"], r["g"], r["b"]], atol=1e-4)
