"""Heights, textures, rays and outlines: grids of heights as relations, texels on triangles, boundary rings, skirts, flat tile grids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from .mesh import perimeter_edges, with_corners


def dem_points(px: DataFrame, cell: float, rows: int, cols: int) -> DataFrame:
    """Pixels (img, row, col, val) with x, y, z: the raster's centre at the origin, columns along x, rows against y."""
    return px.withColumns({"x": (F.col("col") - (cols - 1) / 2) * cell, "y": ((rows - 1) / 2 - F.col("row")) * cell, "z": F.col("val")})


def dem_normals(points: DataFrame) -> DataFrame:
    """``points`` of a grid with nx, ny, nz: the unit sum of the normals of the up to four triangles with neighbours; null without any."""
    steps = {"e": (0, 1), "n": (-1, 0), "w": (0, -1), "s": (1, 0)}
    here = points.select("img", "row", "col", F.struct("x", "y", "z").alias("p"))
    out = points
    for name, (dr, dc) in steps.items():
        near = here.select("img", (F.col("row") - dr).alias("row"), (F.col("col") - dc).alias("col"), F.col("p").alias(f"__{name}"))
        out = out.join(near, ["img", "row", "col"], "left")
    sums = []
    for i, (one, two) in enumerate((("e", "n"), ("n", "w"), ("w", "s"), ("s", "e"))):
        a, b = ({c: F.col(f"__{k}.{c}") - F.col(c) for c in "xyz"} for k in (one, two))
        out = out.withColumns({f"__{i}{c}": a[p] * b[q] - a[q] * b[p] for c, p, q in (("x", "y", "z"), ("y", "z", "x"), ("z", "x", "y"))})
        size = F.nullif(F.sqrt(sum((F.col(f"__{i}{c}") ** 2 for c in "xyz"), F.lit(0.0))), F.lit(0.0))
        out = out.withColumn(f"__{i}", size)
        sums.append({c: F.coalesce(F.col(f"__{i}{c}") / F.col(f"__{i}"), F.lit(0.0)) for c in "xyz"})
    out = out.withColumns({f"__t{c}": sum((s[c] for s in sums), F.lit(0.0)) for c in "xyz"})
    out = out.withColumn("__all", F.nullif(F.sqrt(sum((F.col(f"__t{c}") ** 2 for c in "xyz"), F.lit(0.0))), F.lit(0.0)))
    return out.select(*points.columns, *[(F.col(f"__t{c}") / F.col("__all")).alias(f"n{c}") for c in "xyz"])


def window_mean(px: DataFrame, points: DataFrame, radius: int = 2, missing: float | None = None) -> DataFrame:
    """Rows (id, height): plain mean of the pixels in the square about each point (id, row, col) that are there and not ``missing``; null without any."""
    asked = points.withColumn("__r", F.explode(F.sequence(F.round("row").cast("int") - radius, F.round("row").cast("int") + radius)))
    asked = asked.withColumn("__c", F.explode(F.sequence(F.round("col").cast("int") - radius, F.round("col").cast("int") + radius))).select("id", F.col("__r").alias("row"), F.col("__c").alias("col"))
    good = px if missing is None else px.where(F.col("val") != missing)
    means = asked.join(good.select("row", "col", "val"), ["row", "col"]).groupBy("id").agg(F.avg("val").alias("height"))
    return points.select("id").join(means, "id", "left")


def tilt(nx: Column, ny: Column, nz: Column, mode: str = "acos") -> Column:
    """Steepness of a unit normal from 0 (level) to 1 (upright): by angle, by cosine, or by the level part."""
    up = F.abs(nz)
    return {"acos": F.acos(F.least(up, F.lit(1.0))) / (F.pi() / 2), "abs": 1 - up, "level": F.sqrt(nx * nx + ny * ny)}[mode]


def elevations(px: DataFrame, up: tuple[float, float, float] = (0.0, 0.0, -1.0)) -> DataFrame:
    return px.withColumn("elevation", sum((F.col(c) * u for c, u in zip("xyz", up, strict=True)), F.lit(0.0)))


def grid_curvatures(points: DataFrame) -> DataFrame:
    """Grid points with normals get curvature, the mean of those towards the right and lower neighbours that are there."""
    here = points.select("img", "row", "col", F.struct("x", "y", "z").alias("p"), F.struct(*[F.col(f"n{c}").alias(c) for c in "xyz"]).alias("n"))
    out = points
    for name, dr, dc in (("r", 0, 1), ("d", 1, 0)):
        near = here.select("img", (F.col("row") - dr).alias("row"), (F.col("col") - dc).alias("col"), F.struct("p", "n").alias(f"__{name}"))
        out = out.join(near, ["img", "row", "col"], "left")
    p, n = g.vec(F.col("x"), F.col("y"), F.col("z")), g.vec(F.col("nx"), F.col("ny"), F.col("nz"))
    each = F.array_compact(F.array(*[g.curvature(p, F.col(f"__{k}.p"), n, F.col(f"__{k}.n")) for k in "rd"]))
    return out.withColumn("curvature", F.when(F.size(each) > 0, F.aggregate(each, F.lit(0.0), lambda s, v: s + v) / F.size(each))).drop("__r", "__d")


def texels(vertices: DataFrame, faces: DataFrame, width: int, height: int) -> DataFrame:
    """Rows (mesh, row, col, fid, x, y, z): the point on the surface at each texel's centre, of the face of least id that covers it.

    Texture places (u, v) run from the lower left; faces are dealt to the texels of their bounds.
    """
    at = vertices.select("mesh", "vid", F.struct("x", "y", "z", (F.col("u") * width).alias("u"), ((1 - F.col("v")) * height).alias("v")).alias("p"))
    for p, name in (("p0", "a"), ("p1", "b"), ("p2", "c")):
        faces = faces.join(at.withColumnsRenamed({"vid": p, "p": name}), ["mesh", p])
    for name, c, size in (("col", "u", width), ("row", "v", height)):
        lo = F.greatest(F.lit(0), F.ceil(F.least(*[F.col(f"{p}.{c}") for p in "abc"]) - 0.5))
        hi = F.least(F.lit(size - 1), F.floor(F.greatest(*[F.col(f"{p}.{c}") for p in "abc"]) - 0.5))
        faces = faces.withColumn(name, F.explode(F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))))
    x, y = F.col("col") + 0.5, F.col("row") + 0.5
    turn = lambda p, q, u, v: (F.col(f"{q}.u") - F.col(f"{p}.u")) * (v - F.col(f"{p}.v")) - (F.col(f"{q}.v") - F.col(f"{p}.v")) * (u - F.col(f"{p}.u"))
    whole = F.nullif(turn("a", "b", F.col("c.u"), F.col("c.v")), F.lit(0.0))
    shares = [turn(p, q, x, y) / whole for p, q in (("b", "c"), ("c", "a"), ("a", "b"))]
    inside = faces.where((shares[0] >= 0) & (shares[1] >= 0) & (shares[2] >= 0))
    place = F.struct(*[sum(s * F.col(f"{p}.{c}") for s, p in zip(shares, "abc", strict=True)).alias(c) for c in "xyz"])
    first = inside.groupBy("mesh", "row", "col").agg(F.min(F.struct("fid", place.alias("at"))).alias("t"))
    return first.select("mesh", "row", "col", "t.fid", "t.at.x", "t.at.y", "t.at.z")


def raycast(rays: DataFrame, vertices: DataFrame, faces: DataFrame, cell: float, most: float) -> DataFrame:
    """Rows (ray, mesh, fid, distance): the nearest face that each ray (ray, ox..oz origin, dx..dz unit direction) meets within ``most``.

    Faces are dealt to the cells of a grid that their bounds meet; a ray asks the cells along its
    way, sampled at half a cell and widened by one cell, so that no cell it crosses is missed.
    """
    at = with_corners(vertices, faces)
    for c in "xyz":
        lo, hi = F.least(*[F.col(f"{p}.{c}") for p in "abc"]), F.greatest(*[F.col(f"{p}.{c}") for p in "abc"])
        at = at.withColumn(f"c{c}", F.explode(F.sequence(F.floor(lo / cell), F.floor(hi / cell))))
    steps = F.sequence(F.lit(0), F.lit(int(most / cell * 2) + 1))
    around = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip("xyz", (i, j, k), strict=True)]) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)])
    way = rays.withColumn("__t", F.explode(steps)).withColumn("__t", F.col("__t") * (cell / 2))
    cells = way.select("ray", *[F.floor((F.col(f"o{c}") + F.col(f"d{c}") * F.col("__t")) / cell).alias(f"b{c}") for c in "xyz"]).distinct()
    cells = cells.withColumn("s", F.explode(around)).select("ray", *[(F.col(f"b{c}") + F.col(f"s.{c}")).alias(f"c{c}") for c in "xyz"]).distinct()
    met = cells.join(at, ["cx", "cy", "cz"]).select("ray", "mesh", "fid", "a", "b", "c").dropDuplicates(["ray", "mesh", "fid"]).join(rays, "ray")
    o, d = (g.vec(*[F.col(f"{n}{c}") for c in "xyz"]) for n in "od")
    hit = met.withColumn("distance", g.ray_triangle(o, d, F.col("a"), F.col("b"), F.col("c"))).where(F.col("distance") <= most)
    return hit.groupBy("ray").agg(F.min(F.struct("distance", "mesh", "fid")).alias("h")).select("ray", "h.mesh", "h.fid", "h.distance")


def occluded(rays: DataFrame, vertices: DataFrame, faces: DataFrame, cell: float, most: float, slack: float = 1e-3) -> DataFrame:
    """Rays (with ``length``, the way to their target) that meet a face before the target, less ``slack``."""
    hits = raycast(rays, vertices, faces, cell, most).select("ray", "distance")
    return rays.join(hits, "ray").where(F.col("distance") < F.col("length") - slack).select("ray", "distance")


def boundary_rings(faces: DataFrame) -> DataFrame:
    """Rows (mesh, ring, size, vids): closed outlines of a surface, longest first by ``ring`` from 0, each from its least vertex on.

    An outline is followed within its mesh; a mesh's outline is assumed to fit a task, as its file does.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for mesh, edges in zip(batch.column("mesh").to_pylist(), batch.column("edges").to_pylist(), strict=True):
                onward: dict[int, list[int]] = {}
                for e in sorted((e["a"], e["b"]) for e in edges):
                    onward.setdefault(e[0], []).append(e[1])
                rings = []
                for start in sorted(onward):
                    while onward[start]:
                        ring, here = [start], onward[start].pop(0)
                        while here != start and onward.get(here):
                            ring.append(here)
                            here = onward[here].pop(0)
                        if here == start:
                            rings.append(ring)
                rings.sort(key=lambda r: (-len(r), r))
                out += [(mesh, i, len(r), r) for i, r in enumerate(rings)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64())))], ["mesh", "ring", "size", "vids"])

    edges = perimeter_edges(faces).groupBy(F.col("mesh").cast("string").alias("mesh")).agg(F.collect_list(F.struct(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))).alias("edges"))
    return edges.mapInArrow(run, "mesh string, ring int, size int, vids array<bigint>")


def skirt(vertices: DataFrame, faces: DataFrame, depth: float, axis: str = "z") -> tuple[DataFrame, DataFrame]:
    """(vertices, faces) with a wall hung from the outline: its corners ``depth`` further along ``axis``, two faces for each edge."""
    rim = perimeter_edges(faces)
    top = vertices.groupBy("mesh").agg((F.max("vid") + 1).alias("__v"))
    ends = rim.select("mesh", F.col("a").alias("vid")).union(rim.select("mesh", "b")).distinct()
    place = F.row_number().over(Window.partitionBy("mesh").orderBy("vid")) - 1
    low = ends.join(top, "mesh").withColumn("new", F.col("__v") + place).select("mesh", "vid", "new")
    hung = vertices.join(low, ["mesh", "vid"]).withColumns({axis: F.col(axis) + depth, "vid": F.col("new")}).select(*vertices.columns)
    a, b = (low.withColumnsRenamed({"vid": n, "new": f"{n}2"}) for n in "ab")
    base = faces.groupBy("mesh").agg((F.max("fid") + 1).alias("__f"))
    walls = rim.join(a, ["mesh", "a"]).join(b, ["mesh", "b"]).join(base, "mesh").withColumn("__n", F.col("__f") + 2 * (F.row_number().over(Window.partitionBy("mesh").orderBy("a", "b")) - 1))
    pair = F.array(F.struct(F.col("__n").alias("fid"), F.col("b").alias("p0"), F.col("a").alias("p1"), F.col("a2").alias("p2")), F.struct((F.col("__n") + 1).alias("fid"), F.col("b").alias("p0"), F.col("a2").alias("p1"), F.col("b2").alias("p2")))
    walls = walls.select("mesh", F.explode(pair).alias("f")).select("mesh", "f.*")
    return vertices.unionByName(hung), faces.select("mesh", "fid", "p0", "p1", "p2").unionByName(walls)


def merged(meshes: DataFrame, faces: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """All meshes as one: vertices and faces numbered on, in the order of mesh and number."""
    sizes = meshes.groupBy("mesh").agg(F.max("vid").alias("n")).join(faces.groupBy("mesh").agg(F.max("fid").alias("m")), "mesh", "left")
    upto = Window.orderBy("mesh").rowsBetween(Window.unboundedPreceding, -1)  # a row for each mesh
    base = F.broadcast(sizes.select("mesh", F.coalesce(F.sum(F.col("n") + 1).over(upto), F.lit(0)).alias("__v"), F.coalesce(F.sum(F.coalesce("m", F.lit(-1)) + 1).over(upto), F.lit(0)).alias("__f")))
    v = meshes.join(base, "mesh").withColumns({"vid": F.col("vid") + F.col("__v"), "mesh": F.lit(name)}).drop("__v", "__f")
    f = faces.join(base, "mesh").withColumns({"fid": F.col("fid") + F.col("__f"), **{p: F.col(p) + F.col("__v") for p in ("p0", "p1", "p2")}, "mesh": F.lit(name)}).drop("__v", "__f")
    return v, f


def copied_attributes(target: DataFrame, source: DataFrame, on: list[str], attributes: list[str]) -> DataFrame:
    """``target`` vertices with attributes of the source vertex (least id) that agrees in ``on``; their own where there is none."""
    best = source.groupBy(*on).agg(F.min(F.struct("vid", *attributes)).alias("__s"))
    out = target.join(best, on, "left")
    return out.withColumns({a: F.coalesce(F.col(f"__s.{a}"), F.col(a)) if a in target.columns else F.col(f"__s.{a}") for a in attributes}).drop("__s")


def elevation_colours(vertices: DataFrame, up: tuple[float, float, float] = (0.0, 0.0, -1.0)) -> DataFrame:
    """Vertices with shade: their height from 0, the lowest of the mesh, to 1; one half where all are level."""
    high = elevations(vertices, up)
    span = high.groupBy("mesh").agg(F.min("elevation").alias("__l"), F.max("elevation").alias("__h"))
    share = (F.col("elevation") - F.col("__l")) / F.nullif(F.col("__h") - F.col("__l"), F.lit(0.0))
    return high.join(span, "mesh").withColumn("shade", F.coalesce(share, F.lit(0.5))).drop("elevation", "__l", "__h")


def normal_colours(nx: Column, ny: Column, nz: Column) -> Column:
    """struct<r, g, b>: parts of a unit normal from -1 to 1 as 0 to 1."""
    return F.struct(*[((v + 1) / 2).alias(c) for v, c in ((nx, "r"), (ny, "g"), (nz, "b"))])


def flat_tiles(spark, low: tuple[float, float], high: tuple[float, float], size: float) -> DataFrame:
    """Rows (tile, x0, y0, x1, y1) of a regular grid over a rectangle, the last row and column cut off at its end."""
    cols, rows = (max(1, int(np.ceil((h - l) / size - 1e-9))) for l, h in zip(low, high, strict=True))
    cells = spark.range(rows * cols).select((F.col("id") % cols).alias("c"), F.floor(F.col("id") / cols).alias("r"))
    edge = lambda name, k, i: F.least(F.lit(float(high[i])), low[i] + (F.col(name) + k) * size)
    return cells.select(F.concat_ws("_", F.lit("t"), "r", "c").alias("tile"), edge("c", 0, 0).alias("x0"), edge("r", 0, 1).alias("y0"), edge("c", 1, 0).alias("x1"), edge("r", 1, 1).alias("y1"))


def connected_by_name(tiles: DataFrame, levels: int) -> DataFrame:
    """Rows (tile, parent, given): a tile's parent is its name without the last character, ``root`` for one character; ancestors that are missing are added."""
    prefixes = F.transform(F.sequence(F.lit(1), F.least(F.length("tile"), F.lit(levels))), lambda n: F.substring("tile", F.lit(1), n))
    if tiles.where(F.length("tile") > levels).limit(1).count():
        raise ValueError(f"a name has more than {levels} characters")
    every = tiles.select(F.explode(prefixes).alias("tile"), F.col("tile").alias("of"))
    named = every.groupBy("tile").agg(F.bool_or(F.col("tile") == F.col("of")).alias("given"))
    return named.select("tile", F.when(F.length("tile") == 1, "root").otherwise(F.expr("left(tile, length(tile) - 1)")).alias("parent"), "given")


def inner_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes (node, parent) that are some node's parent."""
    return nodes.join(nodes.select(F.col("parent").alias("node")).where("node is not null").distinct(), "node", "left_semi")


def depth_first(paths: DataFrame) -> DataFrame:
    """Nodes with a ``path`` from the root (array) in the order of a depth-first walk, children by id."""
    return paths.orderBy("path")


def first_seen(urls: DataFrame, pattern: str, at: str) -> DataFrame:
    """Rows (id, url): of the urls whose ``pattern`` gives the same id, the first by ``at``; urls without an id are left out."""
    ident = F.regexp_extract("url", pattern, 1)
    return urls.withColumn("id", ident).where("id <> ''").groupBy("id").agg(F.min(F.struct(at, "url")).alias("u")).select("id", "u.url")


def preferred_extensions(urls: DataFrame, order: list[str]) -> DataFrame:
    """Rows (base, url, others): of files that differ in their extension the one named first in ``order``, and the other urls, sorted."""
    ext = F.lower(F.regexp_extract("url", "[.]([^./]+)$", 1))
    place = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), ext), F.lit(0)), F.lit(len(order) + 1))
    rows = urls.select(F.regexp_replace("url", "[.][^./]+$", "").alias("base"), "url", place.alias("place"))
    out = rows.groupBy("base").agg(F.min(F.struct("place", "url")).alias("b"), F.sort_array(F.collect_set("url")).alias("all"))
    return out.select("base", F.col("b.url").alias("url"), F.array_remove("all", F.col("b.url")).alias("others"))
