"""Masks and binary pictures as relations of pixels: rows (img, row, col, valid) next to the raster's values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import components


def valid_counts(px: DataFrame) -> DataFrame:
    """Rows (img, valid, total)."""
    return px.groupBy("img").agg(F.count_if("valid").alias("valid"), F.count(F.lit(1)).alias("total"))


def mask_image(px: DataFrame) -> DataFrame:
    """The mask as a picture of one band: 1 where a pixel is masked, else 0."""
    return px.select("img", "row", "col", F.lit(0).alias("band"), F.when(F.col("valid"), 0.0).otherwise(1.0).alias("val"))


def union_masks(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pixels of ``a`` that are valid where ``b`` is valid or has no pixel."""
    other = b.select("img", "row", "col", F.col("valid").alias("__v"))
    return a.join(other, ["img", "row", "col"], "left").withColumn("valid", F.col("valid") & F.coalesce("__v", F.lit(True))).drop("__v")


def fill_masked(px: DataFrame, value: float) -> DataFrame:
    return px.withColumn("val", F.when(F.col("valid"), F.col("val")).otherwise(F.lit(value)))


def replace_colour(bands: DataFrame, old: list[float], new: list[float], columns: list[str]) -> DataFrame:
    """Pixels (one column a band) that equal ``old`` in all bands become ``new``."""
    same = F.lit(True)
    for c, v in zip(columns, old, strict=True):
        same = same & (F.col(c) == v)
    return bands.withColumn("__s", same).withColumns({c: F.when(F.col("__s"), F.lit(v)).otherwise(F.col(c)) for c, v in zip(columns, new, strict=True)}).drop("__s")


def _blocks(px: DataFrame, size: int) -> DataFrame:
    return px.withColumns({"__r": F.floor(F.col("row") / size), "__c": F.floor(F.col("col") / size)})


def _sparse(px: DataFrame, size: int, least: float) -> DataFrame:
    share = F.count_if("valid") / F.count(F.lit(1))
    return _blocks(px, size).groupBy("img", "__r", "__c").agg(share.alias("share")).where(F.col("share") < least).select("img", "__r", "__c")


def mask_sparse_blocks(px: DataFrame, size: int, least: float) -> DataFrame:
    """Masks the blocks of ``size`` x ``size`` pixels whose valid share is under ``least``."""
    bad = _sparse(px, size, least).withColumn("__bad", F.lit(True))
    return _blocks(px, size).join(bad, ["img", "__r", "__c"], "left").withColumn("valid", F.col("valid") & F.col("__bad").isNull()).select(*px.columns)


def _cell_id(row: str, col: str) -> Column:
    return F.concat_ws("/", "img", F.lpad(F.col(row).cast("string"), 9, "0"), F.lpad(F.col(col).cast("string"), 9, "0"))


def _regions(cells: DataFrame, row: str = "row", col: str = "col") -> DataFrame:
    """``cells`` with ``region``, the least cell of its 4-connected group."""
    own = cells.withColumn("__id", _cell_id(row, col))
    links = []
    for line, along in ((row, col), (col, row)):
        w = Window.partitionBy("img", line).orderBy(along)
        links.append(own.select(F.col("__id").alias("a"), F.lag("__id").over(w).alias("b"), (F.col(along) - F.lag(along).over(w)).alias("gap")).where("gap = 1").select("a", "b"))
    found = components(links[0].union(links[1]), "a", "b")
    return own.join(found, F.col("__id") == F.col("node"), "left").withColumn("region", F.coalesce("component", "__id")).drop("__id", "node", "component")


def mask_sparse_outer_blocks(px: DataFrame, size: int, least: float) -> DataFrame:
    """As ``mask_sparse_blocks``, only sparse blocks that reach the picture's border through sparse blocks."""
    edge = _blocks(px, size).groupBy("img").agg(F.max("__r").alias("__rows"), F.max("__c").alias("__cols"))
    part = _regions(_sparse(px, size, least), "__r", "__c").join(edge, "img")
    border = part.where("__r = 0 or __c = 0 or __r = __rows or __c = __cols").select("region").distinct()
    bad = part.join(border, "region", "left_semi").select("img", "__r", "__c").withColumn("__bad", F.lit(True))
    return _blocks(px, size).join(bad, ["img", "__r", "__c"], "left").withColumn("valid", F.col("valid") & F.col("__bad").isNull()).select(*px.columns)


def keep_largest_regions(px: DataFrame, share: float = 0.2) -> DataFrame:
    """Masks the 4-connected regions of valid pixels of under ``share`` times the largest region's size."""
    part = _regions(px.where("valid").select("img", "row", "col"))
    sizes = part.groupBy("img", "region").agg(F.count(F.lit(1)).alias("n"))
    top = sizes.groupBy("img").agg(F.max("n").alias("top"))
    good = sizes.join(top, "img").where(F.col("n") >= F.col("top") * share).select("img", "region")
    kept = part.join(good, ["img", "region"], "left_semi").select("img", "row", "col").withColumn("__keep", F.lit(True))
    return px.join(kept, ["img", "row", "col"], "left").withColumn("valid", F.col("valid") & F.col("__keep").isNotNull()).select(*px.columns)


def outer_regions(px: DataFrame) -> DataFrame:
    """The invalid pixels (img, row, col) that reach the picture's border through invalid pixels."""
    edge = px.groupBy("img").agg(F.max("row").alias("__rows"), F.max("col").alias("__cols"))
    part = _regions(px.where("not valid").select("img", "row", "col")).join(edge, "img")
    border = part.where("row = 0 or col = 0 or row = __rows or col = __cols").select("region").distinct()
    return part.join(border, "region", "left_semi").select("img", "row", "col")


def dilate(px: DataFrame, radius: int, erode: bool = False) -> DataFrame:
    """``val`` (0 or 1) spread, or for ``erode`` shrunk, by a square of side 2 r + 1, rows first; pixels that are absent pass nothing on."""
    pick = F.min if erode else F.max
    for line, along in (("row", "col"), ("col", "row")):
        px = px.withColumn("val", pick("val").over(Window.partitionBy("img", line).orderBy(along).rangeBetween(-radius, radius)))
    return px


def block_means(px: DataFrame, size: int, columns: list[str], unit: bool = False) -> DataFrame:
    """Rows (img, row, col, columns, n): means of the valid pixels of each block; ``unit``: made unit vectors again (normals)."""
    out = _blocks(px.where("valid"), size).groupBy("img", F.col("__r").alias("row"), F.col("__c").alias("col"))
    out = out.agg(*[F.avg(c).alias(c) for c in columns], F.count(F.lit(1)).alias("n"))
    if unit:
        size_ = F.nullif(F.sqrt(sum((F.col(c) ** 2 for c in columns), F.lit(0.0))), F.lit(0.0))
        out = out.withColumn("__s", size_).withColumns({c: F.col(c) / F.col("__s") for c in columns}).drop("__s")
    return out


def box_radii(sigma: float, boxes: int = 3) -> list[int]:
    """Radii of the box blurs whose succession comes nearest to a Gaussian of ``sigma``."""
    ideal = (12 * sigma * sigma / boxes + 1) ** 0.5
    low = int(ideal) - (int(ideal) % 2 == 0)
    small = round((12 * sigma * sigma - boxes * (low * low + 4 * low + 3)) / (-4 * low - 4))
    return [((low if i < small else low + 2) - 1) // 2 for i in range(boxes)]


def gaussian_blur(px: DataFrame, sigma: float) -> DataFrame:
    """Three box blurs in place of a Gaussian."""
    from .raster import box_blur

    for radius in box_radii(sigma):
        px = box_blur(px, radius)
    return px
