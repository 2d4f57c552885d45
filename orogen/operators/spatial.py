"""Spatial joins on a grid: boxes against boxes, points within a radius, rays against triangles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

AXES = "xyz"


def _cells(low: list[Column], high: list[Column], size: float) -> Column:
    """All grid cells that a box meets, as an array of arrays of cell numbers."""
    spans = [F.sequence(F.floor(a / size), F.floor(b / size)) for a, b in zip(low, high, strict=True)]
    cells = F.transform(spans[0], lambda x: F.array(x))
    for span in spans[1:]:
        cells = _product(cells, span)
    return cells


def _product(cells: Column, span: Column) -> Column:
    return F.flatten(F.transform(cells, lambda head: F.transform(span, lambda v: F.concat(head, F.array(v)))))


def box_join(left: DataFrame, right: DataFrame, size: float, axes: str = AXES) -> DataFrame:
    """Pairs (left_id, right_id) of boxes that touch; both have id and min/max of each axis.

    Boxes are copied to the cells of a grid of ``size`` they meet; a pair met in several
    cells is reported in the cell of its intersection's least corner only, so no distinct
    is needed. Choose a size near the median extent.
    """

    def side(df: DataFrame, p: str) -> DataFrame:
        cols = [F.col(f"{m}{a}").cast("double").alias(f"{p}{m}{a}") for a in axes for m in ("min", "max")]
        cells = _cells([F.col(f"min{a}").cast("double") for a in axes], [F.col(f"max{a}").cast("double") for a in axes], size)
        return df.withColumn("__cell", F.explode(cells)).select(F.col("id").alias(f"{p}id"), "__cell", *cols)

    pairs = side(left, "l_").join(side(right, "r_"), "__cell")
    meets, owner = F.lit(True), []
    for a in axes:
        meets = meets & (F.col(f"l_min{a}") <= F.col(f"r_max{a}")) & (F.col(f"r_min{a}") <= F.col(f"l_max{a}"))
        owner.append(F.floor(F.greatest(f"l_min{a}", f"r_min{a}") / size))
    return pairs.where(meets & (F.col("__cell") == F.array(*owner))).select(F.col("l_id").alias("left_id"), F.col("r_id").alias("right_id"))


def within(left: DataFrame, right: DataFrame, radius: float, axes: str = AXES) -> DataFrame:
    """Pairs (left_id, right_id, dist) of points at most ``radius`` apart; both have id and the axes."""
    here = F.array(*[F.floor(F.col(a).cast("double") / radius) for a in axes])
    points = left.select(F.col("id").alias("left_id"), *[F.col(a).cast("double").alias(f"l{a}") for a in axes], here.alias("__cell"))
    low, high = ([F.col(a).cast("double") + s * radius for a in axes] for s in (-1, 1))
    near = right.withColumn("__cell", F.explode(_cells(low, high, radius))).select(F.col("id").alias("right_id"), "__cell", *[F.col(a).cast("double").alias(f"r{a}") for a in axes])
    square = sum(((F.col(f"l{a}") - F.col(f"r{a}")) ** 2 for a in axes[1:]), (F.col(f"l{axes[0]}") - F.col(f"r{axes[0]}")) ** 2)
    return points.join(near, "__cell").withColumn("dist", F.sqrt(square)).where(F.col("dist") <= radius).select("left_id", "right_id", "dist")


def dependency_groups(pairs: DataFrame, item: str, dependency: str, most: int) -> DataFrame:
    """Items grouped by their exact set of dependencies, in groups of at most ``most``: item, deps, grp, n."""
    sets = pairs.groupBy(item).agg(F.array_sort(F.collect_set(dependency)).alias("deps"))
    place = F.row_number().over(Window.partitionBy("deps").orderBy(item)) - 1
    grouped = sets.withColumn("part", F.floor(place / most))
    return grouped.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("deps", "part"))).select(item, "deps", "part", "n")


def hausdorff(left: DataFrame, right: DataFrame, radius: float, axes: str = AXES) -> DataFrame:
    """One row (distance, unmatched): greatest distance from a left point to its nearest right point within ``radius``, and points without one."""
    nearest = within(left, right, radius, axes).groupBy("left_id").agg(F.min("dist").alias("d"))
    joined = left.select(F.col("id").alias("left_id")).join(nearest, "left_id", "left")
    return joined.agg(F.max("d").alias("distance"), F.sum(F.col("d").isNull().cast("int")).alias("unmatched"))


def density(points: DataFrame, radius: float, k: int, axes: str = AXES) -> DataFrame:
    """Mean distance of each point to its ``k`` nearest neighbours within ``radius``: id, neighbours, mean_dist."""
    near = within(points, points, radius, axes).where("left_id <> right_id")
    rank = F.row_number().over(Window.partitionBy("left_id").orderBy("dist", "right_id"))
    best = near.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.groupBy(F.col("left_id").alias("id")).agg(F.count(F.lit(1)).alias("neighbours"), F.avg("dist").alias("mean_dist"))


def reject_outliers(pairs: DataFrame, value: str, factor: float) -> DataFrame:
    """Rows whose value lies within ``factor`` upper MADs of the upper median."""
    from .stats import median_and_mad

    stats = median_and_mad(pairs, [], value)
    return pairs.crossJoin(F.broadcast(stats)).where(F.abs(F.col(value) - F.col("median")) < factor * F.col("mad")).drop("median", "mad")  # one row
