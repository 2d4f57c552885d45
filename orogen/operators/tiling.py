"""Tile trees: schemes that split boxes, criteria that ask for a split, and the tree of a set of triangles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..registry import Registry
from .graph import cut

Splitter = Callable[[Column, float], Column]

#: Splitters by name: (box, least extent) to an array of boxes; none or one box means that it does not split.
SCHEMES: Registry[Splitter] = Registry("tiling scheme")
#: Criteria by name: parameters to a Column over (n, area, box) that tells whether a tile should split.
CRITERIA: Registry[Callable[..., Column]] = Registry("split criterion")

_BOX = "array<struct<lo:struct<x:double,y:double,z:double>,hi:struct<x:double,y:double,z:double>>>"


def _extent(box: Column, axis: str) -> Column:
    return box["hi"][axis] - box["lo"][axis]


def _chosen(axis: Column, made: dict[str, Column]) -> Column:
    out = None
    for name, value in made.items():
        out = F.when(axis == name, value) if out is None else out.when(axis == name, value)
    return out


@SCHEMES.register("Bin")
def halves(box: Column, least: float) -> Column:
    """Two halves of the longest axis; none below twice the least extent."""
    made = _chosen(g.box_longest_axis(box), {a: g.box_halves(box, a) for a in "xyz"})
    longest = F.greatest(*[_extent(box, a) for a in "xyz"])
    return F.when((longest < 2 * least) & F.lit(least > 0), F.array().cast(_BOX)).otherwise(made)


def _quarters(box: Column, least: float, axis: str | None, fallback: bool = False) -> Column:
    across = F.lit(axis) if axis else g.box_shortest_axis(box)
    made = _chosen(across, {a: g.box_quarters(box, a) for a in "xyz"})
    narrow = _chosen(across, {a: F.least(*[_extent(box, b) for b in "xyz" if b != a]) for a in "xyz"})
    small = halves(box, least) if fallback else F.array(box).cast(_BOX)
    return F.when((narrow < 2 * least) & F.lit(least > 0), small).otherwise(made)


SCHEMES.register("QuadX")(lambda box, least: _quarters(box, least, "x"))
SCHEMES.register("QuadY")(lambda box, least: _quarters(box, least, "y"))
SCHEMES.register("QuadZ")(lambda box, least: _quarters(box, least, "z"))
SCHEMES.register("QuadAuto")(lambda box, least: _quarters(box, least, None))
SCHEMES.register("QuadAutoWithFallback")(lambda box, least: _quarters(box, least, None, True))


@SCHEMES.register("Oct")
def octants(box: Column, least: float) -> Column:
    """Eight octants; quarters where the shortest extent is below twice the least."""
    shortest = F.least(*[_extent(box, a) for a in "xyz"])
    return F.when((shortest < 2 * least) & F.lit(least > 0), _quarters(box, least, None)).otherwise(g.box_octants(box))


@CRITERIA.register("faces")
def too_many_faces(most: int) -> Column:
    return F.col("n") > most


@CRITERIA.register("area")
def too_large(most: float) -> Column:
    return F.col("area") > most


@CRITERIA.register("texels")
def too_fine(most: float, texels_per_area: float) -> Column:
    """A texture of ``most`` pixels a side would not hold the tile's area at that resolution."""
    return F.sqrt(F.col("area") * texels_per_area) > most


def build(triangles: DataFrame, scheme: str, split: Column, least: float = 0.0, levels: int = 16) -> DataFrame:
    """The tiles of ``build_with_members``."""
    return build_with_members(triangles, scheme, split, least, levels)[0]


def build_with_members(triangles: DataFrame, scheme: str, split: Column, least: float = 0.0, levels: int = 16) -> tuple[DataFrame, DataFrame]:
    """(tiles, members (fid, tile) of the leaves): rows (tile, parent, level, n, area, box, is_leaf) of the tree over triangles (fid, a, b, c: structs of x, y, z).

    The root's box bounds all corners; a triangle belongs to the children's box that holds its
    centroid, the first of several. A tile splits when ``split`` (over n, area, box) holds and
    its boxes give more than one child that is not empty; a child's name is its parent's with one
    more digit. One aggregation and one join with the level's tiles for each level.
    """
    mid = {x: (F.col(f"a.{x}") + F.col(f"b.{x}") + F.col(f"c.{x}")) / 3 for x in "xyz"}
    low = {x: F.least(*[F.col(f"{p}.{x}") for p in "abc"]) for x in "xyz"}
    high = {x: F.greatest(*[F.col(f"{p}.{x}") for p in "abc"]) for x in "xyz"}
    rows = triangles.select("fid", g.triangle_area(F.col("a"), F.col("b"), F.col("c")).alias("size"), g.vec(*mid.values()).alias("mid"), *[e[x].alias(f"{n}{x}") for n, e in (("l", low), ("h", high)) for x in "xyz"])
    corner = lambda f, n: F.struct(*[f(f"{n}{x}").alias(x) for x in "xyz"])
    root = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0.0)).alias("area"), F.struct(corner(F.min, "l").alias("lo"), corner(F.max, "h").alias("hi")).alias("box"))
    level = cut(root.where("n > 0").select(F.lit("0").alias("tile"), F.lit(None).cast("string").alias("parent"), F.lit(0).alias("level"), "n", "area", "box"))
    inside = cut(rows.select("fid", "size", "mid", F.lit("0").alias("tile")))
    done = settled = None
    for depth in range(levels):
        going = level.where(split).select("tile", SCHEMES[scheme](F.col("box"), least).alias("parts")).where("size(parts) > 1")
        moved = inside.join(going, "tile")  # skewed tiles are split by adaptive execution
        holds = F.transform("parts", lambda b: g.box_contains_nearly(b, F.col("mid")))
        moved = moved.withColumn("part", F.array_position(holds, True).cast("int"))
        counts = moved.groupBy("tile", "part", F.element_at("parts", F.col("part")).alias("box")).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("area"))
        several = counts.groupBy("tile").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("tile")
        children = counts.join(several, "tile").select(F.concat("tile", (F.col("part") - 1).cast("string")).alias("child"), F.col("tile").alias("parent"), F.lit(depth + 1).alias("level"), "n", "area", "box")
        children = cut(children.withColumnRenamed("child", "tile"))
        parents = children.select(F.col("parent").alias("tile"), F.lit(False).alias("__leaf")).distinct()
        level = level.join(parents, "tile", "left").withColumn("is_leaf", F.col("__leaf").isNull()).drop("__leaf")
        done = level if done is None else done.unionByName(level)
        rest = inside.join(parents, "tile", "left_anti").select("fid", "tile")
        settled = rest if settled is None else settled.union(rest)
        if not children.take(1):
            return done, settled
        names = children.select(F.col("parent").alias("tile"), F.col("tile").alias("child"))
        stay = moved.select("fid", "size", "mid", "tile", F.concat("tile", (F.col("part") - 1).cast("string")).alias("child"))
        inside = cut(stay.join(names, ["tile", "child"]).select("fid", "size", "mid", F.col("child").alias("tile")))
        level = children
    level, inside = level.withColumn("is_leaf", F.lit(True)), inside.select("fid", "tile")
    return (level, inside) if done is None else (done.unionByName(level), settled.union(inside))


def geometric_errors(tiles: DataFrame, pixels: float, distances: DataFrame | None = None) -> DataFrame:
    """``tiles`` with error: 0 for a leaf, else the greatest error below plus the distance from what it replaces, or four texels if that is more.

    ``distances``: rows (tile, distance); without them the distance is 0. Errors go up a level at a time.
    """
    own = tiles.join(distances, "tile", "left") if distances is not None else tiles.withColumn("distance", F.lit(0.0))
    depth = own.agg(F.max("level")).first()[0] or 0  # one number
    texel = 4 * F.sqrt(F.col("area") / pixels)
    out = below = None
    for level in range(depth, -1, -1):
        here = own.where(F.col("level") == level)
        here = here.join(below, "tile", "left") if below is not None else here.withColumn("under", F.lit(None).cast("double"))
        error = F.when(F.col("is_leaf"), 0.0).otherwise(F.greatest(F.coalesce("under", F.lit(0.0)) + F.coalesce("distance", F.lit(0.0)), texel))
        here = cut(here.withColumn("error", error).drop("under"))
        out = here if out is None else out.unionByName(here)
        below = here.where("parent is not null").groupBy(F.col("parent").alias("tile")).agg(F.max("error").alias("under"))
    return out.drop("distance")
