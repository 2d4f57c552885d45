"""Matrices, frames, cameras, planes and masks against numpy and by round trips."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orogen.functions import geometry as g
from orogen.operators import cameras, fitting, frames, masks, mesh


def turn(rng):
    q = rng.standard_normal(4)
    q /= np.linalg.norm(q)
    return q * np.sign(q[3])


def test_matrices(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(20):
        q, t, s = turn(rng), rng.standard_normal(3), rng.uniform(0.5, 2, 3)
        rows.append((i, dict(zip("xyzw", q.tolist(), strict=True)), dict(zip("xyz", t.tolist(), strict=True)), s.tolist()))
    df = spark.createDataFrame(rows, "id int, q struct<x double, y double, z double, w double>, t struct<x double, y double, z double>, s array<double>")
    m = frames.from_quaternion(F.col("q"), F.col("t"))
    df = df.withColumn("m", m).withColumn("scaled", frames.product(F.array(*[F.col("s")[i // 5] if i in (0, 5, 10) else F.lit(frames.IDENTITY[i]) for i in range(16)]), F.col("m")))
    out = frames.inverse(df, "scaled").withColumns({"back": frames.rigid_inverse(F.col("m")), "q2": frames.to_quaternion(F.col("m")), "parts": frames.decompose(F.col("scaled")), "p": frames.transform(F.col("m"), F.lit(1.0), F.lit(2.0), F.lit(3.0)), "r": g.rotate(F.col("q"), g.vec(1, 2, 3))})
    for r in out.collect():
        a = np.array(r["m"]).reshape(4, 4)
        assert np.allclose(np.array(r["back"]).reshape(4, 4) @ a, np.eye(4)) and np.allclose(np.array(r["inverse"]).reshape(4, 4) @ np.array(r["scaled"]).reshape(4, 4), np.eye(4))
        assert np.allclose(list(r["q2"]), list(r["q"])) and np.allclose(list(r["parts"]["scale"]), r["s"]) and np.allclose(list(r["parts"]["rotation"]), list(r["q"])) and np.allclose(list(r["parts"]["translation"]), list(r["t"]))
        assert np.allclose(list(r["p"]), (np.array([1, 2, 3, 1]) @ a)[:3]) and np.allclose(np.array(list(r["p"])) - list(r["t"]), list(r["r"]))
    half = spark.createDataFrame([(list(map(float, (1, 0, 0, 0, 0, -1, 0, 0, 0, 0, -1, 0, 0, 0, 0, 1))),), ([0.0] * 16,)], "m array<double>")
    assert [tuple(r[0]) for r in half.limit(1).select(frames.to_quaternion(F.col("m"))).collect()] == [(1.0, 0.0, 0.0, 0.0)]
    assert frames.inverse(half, "m").collect()[1]["inverse"] is None


def test_frames_and_priors(spark):
    step = list(map(float, (1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0, 1, 2, 3, 1)))
    df = spark.createDataFrame([(f"f{i}", f"f{i - 1}" if i else None, step) for i in range(9)] + [("a", "gone", step)], "frame string, parent string, matrix array<double>")
    got = {r["frame"]: (r["root"], r["steps"], r["matrix"][12:15]) for r in frames.to_root(df, 8).collect()}
    assert got == {f"f{i}": ("f0", i, [i * 1.0, i * 2.0, i * 3.0]) for i in range(9)} | {"a": ("gone", 1, [1.0, 2.0, 3.0])}
    with pytest.raises(Exception, match="longer than 4 steps"):
        frames.to_root(df, 4).collect()
    prior = spark.createDataFrame([("x", 2, "b", step), ("x", 1, "a", step)], "frame string, place int, source string, matrix array<double>")
    r = frames.chained_priors(prior).first()
    assert r["sources"] == ["a", "b"] and r["matrix"][12:15] == [2.0, 4.0, 6.0]


@pytest.mark.parametrize("lens", [{}, {"o": [0, 0.02, 0.9998], "r": [0.001, -0.05, 0.01]}, {"o": [0, 0.02, 0.9998], "r": [0.001, -0.05, 0.01], "e": [0.01, 0.002, 0.0005], "linearity": 1.0}, {"o": [0, 0, 1], "r": [0, -0.01, 0.001], "e": [0.01, 0.002, 0.0005], "linearity": 0.0}])
def test_cameras(spark, lens):
    if "o" in lens:
        lens = lens | {"o": (np.array(lens["o"]) / np.linalg.norm(lens["o"])).tolist()}
    camera = cameras.Camera([0.1, 0.2, -2], [0, 0, 1], [500, 0, 320], [0, 500, 240], **lens)
    points = np.random.default_rng(2).uniform(-1, 1, (50, 3)).tolist()
    df = cameras.unproject(cameras.project(spark.createDataFrame(points, "x double, y double, z double"), camera), camera)
    for r in df.collect():
        away = np.array([r["x"] - r["ox"], r["y"] - r["oy"], r["z"] - r["oz"]])
        assert np.allclose(away, r["range"] * np.array([r["dx"], r["dy"], r["dz"]]), atol=1e-7)
    flat = cameras.Orthographic([1, 2, 3], [0.5, 0, 0], [0, 0.25, 0], [0, 0, 1])
    r = cameras.project(spark.createDataFrame([(2.0, 3.0, 10.0)], "x double, y double, z double"), flat).first()
    assert (r["pixel_col"], r["pixel_row"], r["range"]) == (2.0, 4.0, 7.0)


def test_closest_point_and_angles(spark):
    rng = np.random.default_rng(3)
    rows = [(i, *rng.uniform(-1, 1, 12).tolist()) for i in range(60)] + [(60, *([0.5] * 9), 1.0, 2.0, 3.0)]
    names = [f"c{i}" for i in range(12)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{n} double" for n in names))
    a, b, c, p = (g.vec(*[F.col(names[3 * k + j]) for j in range(3)]) for k in range(4))
    grid = [(u, v) for u in np.linspace(0, 1, 161) for v in np.linspace(0, 1 - u, 161)]
    for r in df.select("*", g.closest_on_triangle(p, a, b, c).alias("q")).collect():
        t, at = np.array([r[n] for n in names[:9]]).reshape(3, 3), np.array([r[n] for n in names[9:]])
        best = min(np.linalg.norm(t[0] + u * (t[1] - t[0]) + v * (t[2] - t[0]) - at) for u, v in grid)
        own = np.linalg.norm(np.array(list(r["q"])) - at)
        assert best - 0.03 < own <= best + 1e-9
    q = spark.createDataFrame([({"x": 0.0, "y": float(np.sin(0.3)), "z": 0.0, "w": float(np.cos(0.3))},)], "q struct<x double, y double, z double, w double>")
    assert np.allclose(list(q.select(g.yaw_pitch_roll(F.col("q"))).first()[0]), [0.6, 0, 0])
    rgb = spark.createDataFrame(rng.uniform(0, 1, (40, 3)).tolist(), "r double, g double, b double")
    hsv = rgb.withColumn("h", g.rgb_to_hsv(F.col("r"), F.col("g"), F.col("b")))
    for r in hsv.withColumn("back", g.hsv_to_rgb(F.col("h.h"), F.col("h.s"), F.col("h.v"))).collect():
        assert np.allclose(list(r["back"]), [r["r"], r["g"], r["b"]])


def test_fits(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((80, 3))
    q, _ = np.linalg.qr(rng.standard_normal((3, 3)))
    q *= np.sign(np.linalg.det(q))
    y = 1.7 * x @ q.T + [1, 2, 3]
    df = spark.createDataFrame([(1, *a, *b) for a, b in zip(x.tolist(), y.tolist(), strict=True)], "k int, mx double, my double, mz double, fx double, fy double, fz double")
    r = fitting.similarity_3d(df, ["k"], scaled=True).first()
    assert np.allclose(np.array(r["rotation"]).reshape(3, 3), q) and np.isclose(r["scale"], 1.7) and np.allclose(r["translation"], [1, 2, 3]) and r["residual"] < 1e-6
    stats = fitting.mean_and_covariance(df, ["k"], ["mx", "my", "mz"])
    axes = fitting.principal_axes(stats, ["k"], 2).first()
    w, v = np.linalg.eigh(np.cov(x.T))
    assert np.allclose(axes["values"], w[::-1][:2]) and all(np.isclose(abs(np.dot(a, b)), 1) for a, b in zip(axes["axes"], v.T[::-1], strict=False))
    line = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (1, 1.0, 1.0, 1.0), (1, 2.0, 2.0, 2.0), (2, 0.0, 0.0, 1.0)], "k int, x double, y double, z double")
    assert all(r["nx"] is None for r in fitting.fit_planes(line, ["k"]).collect())


def test_meshes(spark):
    points = [("m", 1, 0.0, 0.0, 1.0), ("m", 2, 1.0, 0.0, -1.0), ("m", 3, 0.0, 1.0, -1.0), ("m", 4, 1.0005, 0.0, -1.0), ("m", 5, 1.0, 1.0, -1.0), ("m", 6, 9.0, 9.0, 0.0), ("m", 7, 9.1, 9.0, 0.0), ("m", 8, 9.0, 9.1, 0.0), ("m", 9, float("nan"), 0.0, 0.0)]
    vertices = spark.createDataFrame(points, "mesh string, vid int, x double, y double, z double")
    faces = spark.createDataFrame([("m", 1, 1, 2, 3), ("m", 2, 4, 5, 3), ("m", 3, 6, 7, 8), ("m", 4, 1, 2, 9), ("m", 5, 2, 4, 2)], "mesh string, fid int, p0 int, p1 int, p2 int")
    assert {r["fid"] for r in mesh.sound_faces(vertices, faces).collect()} == {1, 2, 3}
    v, f = mesh.merge_near_vertices(mesh.finite_points(vertices), mesh.sound_faces(vertices, faces), 0.01)
    assert {r["vid"] for r in v.collect()} == {1, 2, 3, 5, 6, 7, 8} and {(r["p0"], r["p1"], r["p2"]) for r in f.collect()} == {(1, 2, 3), (2, 5, 3), (6, 7, 8)}
    v2, f2 = mesh.drop_islands(v, f, 0.5)
    assert {r["vid"] for r in v2.collect()} == {1, 2, 3, 5} and f2.count() == 2
    assert mesh.drop_islands(v, f, 1.0, by_count=True)[0].count() == 4
    parts = mesh.split_by_plane(v, f, (0.0, 0.0, 1.0), 0.0).where("fid = 1").collect()
    assert sorted(r["side"] for r in parts) == [-1, -1, 1]
    rim = {(r["a"], r["b"]) for r in mesh.perimeter_edges(f).where("a < 6").collect()}
    assert rim == {(1, 2), (3, 1), (2, 5), (5, 3)}
    heights = {(r["row"], r["col"]): (round(r["height"], 6), r["n"]) for r in mesh.height_map(v, f, 0.5).where("row < 2").collect()}
    assert heights == {(0, 0): (0.0, 1), (0, 1): (1.0, 2), (1, 0): (1.0, 2), (1, 1): (1.0, 1)}


def test_masks(spark):
    picture = ["#####..#", "#...#.##", "#.#.#..#", "#...#...", "#####..."]
    px = spark.createDataFrame([("p", r, c, ch == "#") for r, line in enumerate(picture) for c, ch in enumerate(line)], "img string, row int, col int, valid boolean")
    assert masks.valid_counts(px).first()["valid"] == 21
    kept = {(r["row"], r["col"]) for r in masks.keep_largest_regions(px, 0.3).where("valid").collect()}
    assert len(kept) == 16 and (2, 2) not in kept and (0, 7) not in kept
    outer = {(r["row"], r["col"]) for r in masks.outer_regions(px).collect()}
    assert (1, 1) not in outer and (0, 5) in outer and len(outer) == sum(line[5:].count(".") for line in picture)
    sparse = masks.mask_sparse_outer_blocks(px, 1, 0.5)
    assert sparse.where("valid").count() == 21
    assert masks.box_radii(2.0) == [1, 1, 2] and sum(r * (r + 1) for r in masks.box_radii(5.0)) * 1.0 == pytest.approx(75, abs=8)
    assert masks.union_masks(px, px.withColumn("valid", F.col("row") > 0)).where("valid").count() == 15
    coloured = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert [tuple(r) for r in masks.replace_colour(coloured, [1, 3], [0.0, 0.0], ["a", "b"]).collect()] == [(1.0, 2.0), (0.0, 0.0)]
