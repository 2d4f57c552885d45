"""Rasters as relations: rows (img, row, col, band, val), all operators joins, windows and projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["img", "row", "col", "band"]


def crop(px: DataFrame, row: int, col: int, rows: int, cols: int) -> DataFrame:
    """The part from (row, col) on, renumbered from 0; the bounds reach the scan as filters."""
    inside = F.col("row").between(row, row + rows - 1) & F.col("col").between(col, col + cols - 1)
    return px.where(inside).withColumns({"row": F.col("row") - row, "col": F.col("col") - col})


def flip_vertical(px: DataFrame, rows: int) -> DataFrame:
    return px.withColumn("row", F.lit(rows - 1) - F.col("row"))


def rotate_clockwise(px: DataFrame, rows: int) -> DataFrame:
    """A quarter turn: (row, col) goes to (col, rows - 1 - row)."""
    return px.withColumns({"row": F.col("col"), "col": F.lit(rows - 1) - F.col("row")})


def blit(base: DataFrame, patch: DataFrame, row: int, col: int) -> DataFrame:
    """``base`` with the pixels of ``patch`` written over it at (row, col)."""
    moved = patch.withColumns({"row": F.col("row") + row, "col": F.col("col") + col}).withColumnRenamed("val", "__new")
    return base.join(moved, KEY, "left").withColumn("val", F.coalesce("__new", "val")).drop("__new")


def box_blur(px: DataFrame, radius: int) -> DataFrame:
    """Mean of the (2 r + 1)-square about each pixel, as two running means: rows first, then columns."""
    for line, along in (("row", "col"), ("col", "row")):
        w = Window.partitionBy("img", "band", line).orderBy(along).rangeBetween(-radius, radius)
        px = px.withColumn("val", F.avg("val").over(w))
    return px


def resize_nearest(px: DataFrame, rows: int, cols: int, to_rows: int, to_cols: int) -> DataFrame:
    """Nearest neighbour: every source pixel emits the target pixels that sample it."""

    def targets(at: str, n: int, m: int) -> Column:
        # target t samples source floor(t * n / m): t runs from ceil(s m / n) to ceil((s + 1) m / n) - 1
        lo, hi = F.ceil(F.col(at) * m / n), F.ceil((F.col(at) + 1) * m / n) - 1
        return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))

    out = px.withColumn("__r", F.explode(targets("row", rows, to_rows))).withColumn("__c", F.explode(targets("col", cols, to_cols)))
    return out.withColumns({"row": F.col("__r"), "col": F.col("__c")}).drop("__r", "__c")


def sample_bilinear(px: DataFrame, points: DataFrame) -> DataFrame:
    """Values at fractional (row, col) of ``points`` (img, id, row, col): weighted mean of the four pixels that are there."""
    near = F.array(*[F.struct((F.floor("row") + i).alias("r"), (F.floor("col") + j).alias("c")) for i in (0, 1) for j in (0, 1)])
    asked = points.select("img", "id", F.col("row").alias("y"), F.col("col").alias("x"), F.explode(near).alias("n"))
    met = asked.join(px.withColumnRenamed("img", "__i"), (F.col("img") == F.col("__i")) & (F.col("n.r") == px["row"]) & (F.col("n.c") == px["col"]))
    weight = (1 - F.abs(F.col("y") - F.col("n.r"))) * (1 - F.abs(F.col("x") - F.col("n.c")))
    sums = met.groupBy("img", "id", "band").agg(F.sum(weight * F.col("val")).alias("s"), F.sum(weight).alias("w"))
    return sums.where("w > 0").select("img", "id", "band", (F.col("s") / F.col("w")).alias("val"))


def stretch(px: DataFrame, low: float, high: float, to_low: float = 0.0, to_high: float = 1.0) -> DataFrame:
    """Scale values linearly and clamp them."""
    scaled = (F.col("val") - low) / (high - low) * (to_high - to_low) + to_low
    return px.withColumn("val", F.greatest(F.lit(to_low), F.least(F.lit(to_high), scaled)))


def std_stretch(px: DataFrame, deviations: float) -> DataFrame:
    """Map each band's mean -/+ ``deviations`` population deviations to 0 and 1, clamped; a flat band becomes 0.5."""
    stats = px.groupBy("img", "band").agg(F.avg("val").alias("__m"), F.stddev_pop("val").alias("__s"))
    scaled = (F.col("val") - F.col("__m")) / F.nullif(F.col("__s") * 2 * deviations, F.lit(0.0)) + 0.5
    return px.join(stats, ["img", "band"]).withColumn("val", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(scaled, F.lit(0.5))))).drop("__m", "__s")


def inpaint_once(px: DataFrame, rows: int, cols: int) -> DataFrame:
    """Missing pixels beside present ones get the mean of their present neighbours."""
    step = F.array(*[F.struct((F.col("row") + i).alias("r"), (F.col("col") + j).alias("c")) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j])
    around = px.select("img", "band", F.explode(step).alias("n"), "val").where(F.col("n.r").between(0, rows - 1) & F.col("n.c").between(0, cols - 1))
    means = around.groupBy("img", F.col("n.r").alias("row"), F.col("n.c").alias("col"), "band").agg(F.avg("val").alias("val"))
    return px.unionByName(means.join(px, KEY, "left_anti").select(px.columns))


def chunks(px: DataFrame, size: int) -> DataFrame:
    """Pixels with the chunk that holds them, for partitioned storage."""
    return px.withColumns({"chunk_row": F.floor(F.col("row") / size).cast("int"), "chunk_col": F.floor(F.col("col") / size).cast("int")})


def sample_bicubic(px: DataFrame, points: DataFrame, rows: int, cols: int) -> DataFrame:
    """Values at fractional (row, col) of ``points`` (img, id, row, col) by Catmull-Rom weights of 4 x 4 pixels, clamped to the picture's edge."""
    near = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1, 2) for j in (-1, 0, 1, 2)])
    asked = points.select("img", "id", F.col("row").alias("y"), F.col("col").alias("x"), F.explode(near).alias("n"))
    edge = lambda at, step, size: F.greatest(F.lit(0), F.least(F.lit(size - 1), F.floor(at) + step))
    asked = asked.withColumns({"row": edge(F.col("y"), F.col("n.i"), rows), "col": edge(F.col("x"), F.col("n.j"), cols)})

    def weight(at: Column, step: Column) -> Column:
        d = F.abs(at - F.floor(at) - step)
        return F.when(d <= 1, (1.5 * d - 2.5) * d * d + 1).otherwise(((-0.5 * d + 2.5) * d - 4) * d + 2)

    both = weight(F.col("y"), F.col("n.i")) * weight(F.col("x"), F.col("n.j"))
    return asked.join(px, ["img", "row", "col"]).groupBy("img", "id", "band").agg(F.sum(both * F.col("val")).alias("val"))


def normalize(px: DataFrame) -> DataFrame:
    """Each picture's values from its least to its greatest as 0 to 1; a flat one is 0."""
    ends = px.groupBy("img").agg(F.min("val").alias("__l"), F.max("val").alias("__h"))
    share = (F.col("val") - F.col("__l")) / F.nullif(F.col("__h") - F.col("__l"), F.lit(0.0))
    return px.join(ends, "img").withColumn("val", F.coalesce(share, F.lit(0.0))).drop("__l", "__h")


def trim(px: DataFrame, valid: Column) -> DataFrame:
    """The least rectangle that holds all pixels for which ``valid`` holds, renumbered from 0."""
    box = px.where(valid).groupBy("img").agg(F.min("row").alias("__r0"), F.max("row").alias("__r1"), F.min("col").alias("__c0"), F.max("col").alias("__c1"))
    inside = px.join(box, "img").where("row between __r0 and __r1 and col between __c0 and __c1")
    return inside.withColumns({"row": F.col("row") - F.col("__r0"), "col": F.col("col") - F.col("__c0")}).drop("__r0", "__r1", "__c0", "__c1")


def densify(px: DataFrame, rows: int, cols: int, fill: float = 0.0) -> DataFrame:
    """Chunked or sparse pixels as a whole picture: those that are missing get ``fill``."""
    kinds = px.select("img", "band").distinct()
    grid = kinds.withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))))
    return grid.join(px.select(*KEY, "val"), KEY, "left").withColumn("val", F.coalesce("val", F.lit(fill))).select(*KEY, "val")


def convert_range(px: DataFrame, kind: str, to_unit: bool = True) -> DataFrame:
    """Whole numbers of a kind (uint8, int16, uint16) as 0 to 1, or back, rounded to the nearest."""
    low, high = {"uint8": (0, 255), "int16": (-32768, 32767), "uint16": (0, 65535)}[kind]
    value = (F.col("val") - low) / (high - low) if to_unit else F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("val"))) * (high - low) + low)
    return px.withColumn("val", value)


def match_luminance(px: DataFrame, of: DataFrame, to: DataFrame, weight: float = 1.0) -> DataFrame:
    """Values moved from one upper median and deviation (img, median, mad) to another, by the share ``weight``."""
    weight = min(1.0, max(0.0, weight))
    both = px.join(of.withColumnsRenamed({"median": "__m", "mad": "__d"}), "img").join(to.withColumnsRenamed({"median": "__tm", "mad": "__td"}), "img")
    middle, width = F.col("__m") + (F.col("__tm") - F.col("__m")) * weight, F.col("__d") + (F.col("__td") - F.col("__d")) * weight
    size = F.when(F.abs(F.col("__d")) > 1e-9, F.col("__d")).otherwise(1.0)
    return both.withColumn("val", middle + (F.col("val") - F.col("__m")) / size * width).drop("__m", "__d", "__tm", "__td")
