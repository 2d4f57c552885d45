"""Meshes as relations: vertices (mesh, vid, x, y, z) and faces (mesh, fid, p0, p1, p2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import add, cross, is_finite, length, part, scale, sub, triangle_area, vec
from .graph import components


def canonical(faces: DataFrame) -> DataFrame:
    """Faces rotated to begin at their least vertex; the winding stays."""
    p0, p1, p2 = F.col("p0"), F.col("p1"), F.col("p2")
    turned = F.when((p0 <= p1) & (p0 <= p2), F.struct(p0.alias("a"), p1.alias("b"), p2.alias("c"))).when(
        (p1 <= p0) & (p1 <= p2), F.struct(p1.alias("a"), p2.alias("b"), p0.alias("c"))
    ).otherwise(F.struct(p2.alias("a"), p0.alias("b"), p1.alias("c")))
    out = faces.withColumn("__t", turned)
    return out.withColumns({"p0": F.col("__t.a"), "p1": F.col("__t.b"), "p2": F.col("__t.c")}).drop("__t")


def drop_degenerate(faces: DataFrame) -> DataFrame:
    return faces.where("p0 <> p1 and p1 <> p2 and p2 <> p0")


def dedupe_faces(faces: DataFrame) -> DataFrame:
    """One face, of least id, for each set of faces equal up to rotation."""
    return canonical(faces).groupBy("mesh", "p0", "p1", "p2").agg(F.min("fid").alias("fid")).select("mesh", "fid", "p0", "p1", "p2")


def merge_equal_vertices(vertices: DataFrame, faces: DataFrame, attributes: list[str]) -> tuple[DataFrame, DataFrame]:
    """Vertices equal in ``attributes`` become the one of least id; faces are renumbered."""
    same = Window.partitionBy("mesh", *attributes)
    to = vertices.select("mesh", "vid", F.min("vid").over(same).alias("to"))
    for p in ("p0", "p1", "p2"):
        faces = faces.join(to.withColumnsRenamed({"vid": p, "to": "__to"}), ["mesh", p]).drop(p).withColumnRenamed("__to", p)
    kept = vertices.join(to.where("vid = to").select("mesh", "vid"), ["mesh", "vid"], "left_semi")
    return kept, faces.select("mesh", "fid", "p0", "p1", "p2")


def used_vertices(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    corners = faces.select("mesh", F.explode(F.array("p0", "p1", "p2")).alias("vid")).distinct()
    return vertices.join(corners, ["mesh", "vid"], "left_semi")


def with_corners(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """Faces with the positions a, b and c of their corners."""
    at = vertices.select("mesh", "vid", vec(F.col("x"), F.col("y"), F.col("z")).alias("p"))
    for p, name in (("p0", "a"), ("p1", "b"), ("p2", "c")):
        faces = faces.join(at.withColumnsRenamed({"vid": p, "p": name}), ["mesh", p])
    return faces


def surface(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """Rows (mesh, faces, area)."""
    area = triangle_area(F.col("a"), F.col("b"), F.col("c"))
    return with_corners(vertices, faces).groupBy("mesh").agg(F.count(F.lit(1)).alias("faces"), F.sum(area).alias("area"))


def vertex_normals(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """Vertices with nx, ny, nz: the unit sum of their faces' area-weighted normals; null without faces."""
    n = cross(sub(F.col("b"), F.col("a")), sub(F.col("c"), F.col("a")))
    each = with_corners(vertices, faces).withColumn("n", n).select("mesh", F.explode(F.array("p0", "p1", "p2")).alias("vid"), "n")
    total = each.groupBy("mesh", "vid").agg(*[F.sum(f"n.{c}").alias(f"s{c}") for c in "xyz"])
    size = F.nullif(length(vec(F.col("sx"), F.col("sy"), F.col("sz"))), F.lit(0.0))
    return vertices.join(total, ["mesh", "vid"], "left").withColumns({f"n{c}": F.col(f"s{c}") / size for c in "xyz"}).drop("sx", "sy", "sz")


def bounds(vertices: DataFrame) -> DataFrame:
    return vertices.groupBy("mesh").agg(*[f(c).alias(f"{n}{c}") for n, f in (("min", F.min), ("max", F.max)) for c in "xyz"])


def perimeter_edges(faces: DataFrame) -> DataFrame:
    """Directed edges (mesh, a, b) of faces that no face has the other way round."""
    sides = F.array(*[F.struct(F.col(p).alias("a"), F.col(q).alias("b")) for p, q in (("p0", "p1"), ("p1", "p2"), ("p2", "p0"))])
    edges = faces.select("mesh", F.explode(sides).alias("e")).select("mesh", "e.a", "e.b").distinct()
    pair = edges.groupBy("mesh", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    return pair.agg(F.count(F.lit(1)).alias("n"), F.min("a").alias("a"), F.min("b").alias("b")).where("n = 1").select("mesh", "a", "b")


def clip_to_box(vertices: DataFrame, faces: DataFrame, inside: Column) -> DataFrame:
    """Faces with at least one corner for which ``inside`` (of x, y, z) holds."""
    hit = vertices.where(inside).select("mesh", F.col("vid").alias("__v"))
    corners = faces.select("mesh", "fid", F.explode(F.array("p0", "p1", "p2")).alias("__v"))
    kept = corners.join(hit, ["mesh", "__v"]).select("mesh", "fid").distinct()
    return faces.join(kept, ["mesh", "fid"], "left_semi")


def _ok(*columns: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & is_finite(F.col(c))
    return out


def finite_points(vertices: DataFrame) -> DataFrame:
    return vertices.where(_ok("x", "y", "z"))


def sound_normals(vertices: DataFrame) -> DataFrame:
    """Vertices whose normal is finite and not zero."""
    return vertices.where(_ok("nx", "ny", "nz") & (F.col("nx") ** 2 + F.col("ny") ** 2 + F.col("nz") ** 2 > 1e-24))


def sound_faces(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """Faces of three different, known, finite corners that span an area."""
    at = with_corners(finite_points(vertices), drop_degenerate(faces))
    return at.where(triangle_area(F.col("a"), F.col("b"), F.col("c")) > 0).select("mesh", "fid", "p0", "p1", "p2")


def merge_near_vertices(vertices: DataFrame, faces: DataFrame, reach: float) -> tuple[DataFrame, DataFrame]:
    """Vertices at most ``reach`` apart, directly or through others, become the one of least id; faces that fold up go.

    Neighbours come from an equi-join on grid cells of size ``reach``; ``vid`` must be unique over all meshes.
    """
    cell = {c: F.floor(F.col(c) / reach) for c in "xyz"}
    own = vertices.select("mesh", "vid", "x", "y", "z", *[v.alias(f"c{c}") for c, v in cell.items()])
    step = F.array(*map(F.lit, (-1, 0, 1)))
    spread = own.select("mesh", F.col("vid").alias("other"), *[F.col(c).alias(f"o{c}") for c in "xyz"], *[F.col(f"c{c}") for c in "xyz"])
    for c in "xyz":
        spread = spread.withColumn("__s", F.explode(step)).withColumn(f"c{c}", F.col(f"c{c}") + F.col("__s")).drop("__s")
    near = own.join(spread, ["mesh", "cx", "cy", "cz"]).where("vid > other")
    near = near.where(sum(((F.col(c) - F.col(f"o{c}")) ** 2 for c in "xyz"), F.lit(0.0)) <= reach * reach)
    to = components(near, "vid", "other").select("node", "component").where("node <> component")
    for p in ("p0", "p1", "p2"):
        faces = faces.join(to.withColumnsRenamed({"node": p}), p, "left").withColumn(p, F.coalesce("component", p)).drop("component")
    gone = to.select(F.col("node").alias("vid"))
    return vertices.join(gone, "vid", "left_anti").select(*vertices.columns), drop_degenerate(faces.select("mesh", "fid", "p0", "p1", "p2"))


def islands(vertices: DataFrame, faces: DataFrame, by_count: bool = False) -> DataFrame:
    """Rows (mesh, vid, island, size): connected parts, named by their least vertex; size the diagonal of the bounds or the number of vertices."""
    sides = faces.select(F.explode(F.array(F.struct(F.col("p0").alias("a"), F.col("p1").alias("b")), F.struct(F.col("p1").alias("a"), F.col("p2").alias("b")))).alias("e")).select("e.a", "e.b")
    part = vertices.join(components(sides, "a", "b"), F.col("vid") == F.col("node"), "left").withColumn("island", F.coalesce("component", "vid"))
    diagonal = F.sqrt(sum(((F.max(c) - F.min(c)) ** 2 for c in "xyz"), F.lit(0.0)))
    size = part.groupBy("mesh", "island").agg((F.count(F.lit(1)).cast("double") if by_count else diagonal).alias("size"))
    return part.select("mesh", "vid", "island").join(size, ["mesh", "island"]).select("mesh", "vid", "island", "size")


def drop_islands(vertices: DataFrame, faces: DataFrame, ratio: float = 0.1, by_count: bool = False) -> tuple[DataFrame, DataFrame]:
    """Without the islands of under ``ratio`` times the greatest size of their mesh; from 1 on only the greatest stays, the first on ties."""
    parts = islands(vertices, faces, by_count)
    top = parts.groupBy("mesh").agg(F.max(F.struct("size", (-F.col("island")).alias("first"))).alias("t"))
    good = (F.col("island") == -F.col("t.first")) if ratio >= 1 else (F.col("size") >= F.col("t.size") * ratio)
    kept = parts.join(top, "mesh").where(good).select("mesh", "vid")
    corner = kept.withColumnRenamed("vid", "p0")
    return vertices.join(kept, ["mesh", "vid"], "left_semi"), faces.join(corner, ["mesh", "p0"], "left_semi").select("mesh", "fid", "p0", "p1", "p2")


def ranges(vertices: DataFrame, columns: list[str]) -> DataFrame:
    """Least and greatest of some attributes of each mesh: normals (nx, ny, nz), texture places (u, v)."""
    return vertices.groupBy("mesh").agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])


def texture_area(vertices: DataFrame, faces: DataFrame, width: float = 1.0, height: float = 1.0) -> DataFrame:
    """Rows (mesh, area): area of the faces in texture space (u, v), times a texture's pixels."""
    at = vertices.select("mesh", "vid", "u", "v")
    for i in range(3):
        faces = faces.join(at.withColumnsRenamed({"vid": f"p{i}", "u": f"u{i}", "v": f"v{i}"}), ["mesh", f"p{i}"])
    turn = (F.col("u1") - F.col("u0")) * (F.col("v2") - F.col("v0")) - (F.col("u2") - F.col("u0")) * (F.col("v1") - F.col("v0"))
    return faces.groupBy("mesh").agg((F.sum(F.abs(turn)) / 2 * width * height).alias("area"))


def extreme_corners(vertices: DataFrame) -> DataFrame:
    """Rows (mesh, quadrant 0 to 3, vid): in each quadrant about the centre of the bounds the vertex farthest along its diagonal, least id on ties."""
    b = vertices.groupBy("mesh").agg(*[((F.min(c) + F.max(c)) / 2).alias(f"c{c}") for c in "xy"])
    dx, dy = F.col("x") - F.col("cx"), F.col("y") - F.col("cy")
    quadrant = (dx >= 0).cast("int") + 2 * (dy >= 0).cast("int")
    far = F.max_by("vid", F.struct(F.abs(dx) + F.abs(dy), -F.col("vid")))
    return vertices.join(b, "mesh").groupBy("mesh", quadrant.alias("quadrant")).agg(far.alias("vid"))


def split_by_plane(vertices: DataFrame, faces: DataFrame, normal: tuple[float, float, float], offset: float) -> DataFrame:
    """Triangles (mesh, fid, side 1 or -1, part, ax ... cz) of all faces cut along the plane n . p = offset.

    Side 1 is where n . p > offset. A face that the plane crosses gives one triangle on the side
    of its single corner and two on the other; corners on the plane belong to either side.
    """
    at = with_corners(vertices, faces)
    d = {c: sum(F.col(c)[x] * n for x, n in zip("xyz", normal, strict=True)) - offset for c in "abc"}
    at = at.withColumns({f"d{c}": v for c, v in d.items()})
    point = lambda p: F.struct(*[part(p, x).alias(x) for x in "xyz"])
    above = sum((F.when(F.col(f"d{c}") > 0, 1).otherwise(0) for c in "abc"), F.lit(0))
    below = sum((F.when(F.col(f"d{c}") < 0, 1).otherwise(0) for c in "abc"), F.lit(0))
    tri = lambda side, *ps: F.struct(F.lit(side).alias("side"), *[point(p).alias(n) for p, n in zip(ps, "pqr", strict=True)])
    out = F.when(below == 0, F.array(tri(1, F.col("a"), F.col("b"), F.col("c")))).when(above == 0, F.array(tri(-1, F.col("a"), F.col("b"), F.col("c"))))
    for one, two, three in (("a", "b", "c"), ("b", "c", "a"), ("c", "a", "b")):
        d1, d2, d3 = (F.col(f"d{k}") for k in (one, two, three))
        p1, p2, p3 = (F.col(k) for k in (one, two, three))
        cut12, cut13 = (add(p1, scale(sub(p, p1), d1 / (d1 - d))) for p, d in ((p2, d2), (p3, d3)))
        for side in (1, -1):  # the single corner's side
            lone = (d1 * side > 0) & (d2 * side <= 0) & (d3 * side <= 0)
            through = (d2 == 0) | (d3 == 0)
            edge = F.when(d2 == 0, F.array(tri(side, p1, p2, cut13), tri(-side, p2, p3, cut13))).otherwise(F.array(tri(side, p1, cut12, p3), tri(-side, cut12, p2, p3)))
            full = F.array(tri(side, p1, cut12, cut13), tri(-side, cut12, p2, p3), tri(-side, cut12, p3, cut13))
            out = out.when(lone & through, edge).when(lone, full)
    parts = at.select("mesh", "fid", F.posexplode(out).alias("part", "t"))
    return parts.select("mesh", "fid", "t.side", "part", *[F.col(f"t.{n}.{x}").alias(f"{m}{x}") for n, m in zip("pqr", "abc", strict=True) for x in "xyz"])


def height_map(vertices: DataFrame, faces: DataFrame, cell: float) -> DataFrame:
    """Rows (mesh, row, col, height, n): at each cell's centre the greatest -z of the faces that cover it, and their number.

    z points down. Faces are dealt to the cells that their bounds meet; a face seen edge-on covers nothing.
    """
    at = with_corners(vertices, faces)
    low = lambda c: F.least(*[F.col(f"{p}.{c}") for p in "abc"])
    high = lambda c: F.greatest(*[F.col(f"{p}.{c}") for p in "abc"])
    span = lambda c: F.sequence(F.ceil(low(c) / cell - 0.5), F.floor(high(c) / cell - 0.5))
    some = lambda c: F.ceil(low(c) / cell - 0.5) <= F.floor(high(c) / cell - 0.5)
    at = at.where(some("x") & some("y")).withColumn("col", F.explode(span("x"))).withColumn("row", F.explode(span("y")))
    px, py = (F.col("col") + 0.5) * cell, (F.col("row") + 0.5) * cell
    turn = lambda p, q, x, y: (F.col(f"{q}.x") - F.col(f"{p}.x")) * (y - F.col(f"{p}.y")) - (F.col(f"{q}.y") - F.col(f"{p}.y")) * (x - F.col(f"{p}.x"))
    whole = turn("a", "b", F.col("c.x"), F.col("c.y"))
    shares = [turn(p, q, px, py) / F.nullif(whole, F.lit(0.0)) for p, q in (("b", "c"), ("c", "a"), ("a", "b"))]
    z = sum(s * F.col(f"{p}.z") for s, p in zip(shares, "abc", strict=True))
    covered = at.where((shares[0] >= 0) & (shares[1] >= 0) & (shares[2] >= 0))
    return covered.groupBy("mesh", "row", "col").agg((-F.min(z)).alias("height"), F.count(F.lit(1)).alias("n"))


def mean_heights(points: DataFrame, cell: float) -> DataFrame:
    """Rows (row, col, z, n): mean height of the points of each grid cell."""
    return points.groupBy(F.floor(F.col("y") / cell).alias("row"), F.floor(F.col("x") / cell).alias("col")).agg(F.avg("z").alias("z"), F.count(F.lit(1)).alias("n"))
