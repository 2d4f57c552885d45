"""Choice among products: successive filters of variants, caps of wedges, latest meshes and orders of site drives.

A product is a row with id, type, color, eye, geometry (Linearized or Raw), special, version and the
columns that name its group; every filter is one window over the group or none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import band_preference

# Kinds of product types.
GEOMETRY = ("Range", "Points", "Normals", "RoughnessMap")
RASTER = ("Image",)
MASK = "RoverMask"
MONOCHROME = ("Grayscale", "Red", "Green", "Blue")


def _any(test: Column, keys: list[str]) -> Column:
    return F.bool_or(F.coalesce(test, F.lit(False))).over(Window.partitionBy(*keys))


def without_range(df: DataFrame, keys: list[str]) -> DataFrame:
    """Without range maps where the group has points."""
    return df.withColumn("__p", _any(F.col("type") == "Points", keys)).where("not (__p and type = 'Range')").drop("__p")


def preferred_colour(df: DataFrame, keys: list[str], colour_first: bool) -> DataFrame:
    """Of each group the preferred colour only: full colour or the best single band; products of unknown colour go."""
    full = F.coalesce(F.col("color") == "FullColor", F.lit(False))
    mono = F.coalesce(F.col("color").isin(*MONOCHROME), F.lit(False))
    order = F.when(full, 0 if colour_first else 9).when(mono, band_preference(F.col("color")))
    best = F.min(order).over(Window.partitionBy(*keys))
    return df.withColumn("__o", order).withColumn("__b", best).where("__o = __b").drop("__o", "__b")


def preferred_eye(df: DataFrame, eye: str) -> DataFrame:
    """Pure geometry of the other eye goes, even where the preferred eye has none; ``Any`` keeps all."""
    return df if eye == "Any" else df.where(~F.col("type").isin(*GEOMETRY) | (F.coalesce(F.col("eye"), F.lit("")) == eye))


def preferred_geometry(df: DataFrame, keys: list[str], linear_geometry: bool, linear_raster: bool) -> DataFrame:
    """Where a group has both linearised and raw products, the preferred of each of geometry and rasters; masks follow what is left."""
    lin, raw = F.col("geometry") == "Linearized", F.col("geometry") == "Raw"
    geo, ras, mask = F.col("type").isin(*GEOMETRY), F.col("type").isin(*RASTER), F.col("type") == MASK
    df = df.withColumns({"__both": _any(lin, keys) & _any(raw, keys), "__gl": _any(geo & lin, keys), "__gr": _any(geo & raw, keys), "__rl": _any(ras & lin, keys), "__rr": _any(ras & raw, keys)})
    gl, gr, rl, rr = (F.col(c) for c in ("__gl", "__gr", "__rl", "__rr"))
    # what is left of geometry and rasters after their own choice
    left_gl, left_gr = gl & (~gr | F.lit(linear_geometry)), gr & (~gl | F.lit(not linear_geometry))
    left_rl, left_rr = rl & (~rr | F.lit(linear_raster)), rr & (~rl | F.lit(not linear_raster))
    has_g, has_r, has_lin, has_raw = gl | gr, rl | rr, left_gl | left_rl, left_gr | left_rr
    of_mask = (
        F.when(has_g & ~has_r, lin if linear_geometry else raw).when(has_r & ~has_g, lin if linear_raster else raw)
        .when(has_lin & ~has_raw, lin).when(has_raw & ~has_lin, raw).otherwise(F.lit(True))
    )
    keep = F.when(~F.col("__both"), F.lit(True)).when(geo, (lin & left_gl) | (raw & left_gr)).when(ras, (lin & left_rl) | (raw & left_rr)).when(mask, of_mask).otherwise(F.lit(False))
    return df.where(keep).drop("__both", "__gl", "__gr", "__rl", "__rr")


def best_special(df: DataFrame, keys: list[str], allowed: list[str]) -> DataFrame:
    """Of each group the special processing that comes last in ``allowed``; others rank before all of them, the least name among them."""
    place = F.array_position(F.array(*map(F.lit, allowed)), F.col("special"))
    best = F.max(F.struct(place.alias("place"), F.when(place > 0, F.lit(0)).otherwise(-F.ascii("special")).alias("first"), "special")).over(Window.partitionBy(*keys))
    return df.withColumn("__b", best["special"]).where("special <=> __b").drop("__b")


def latest_version(df: DataFrame, keys: list[str]) -> DataFrame:
    top = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("version").desc(), F.col("id").desc()))
    return df.withColumn("__n", top).where("__n = 1").drop("__n")


def filter_groups(df: DataFrame, frame: list[str], eye: str = "Left", colour_first: bool = True, linear_geometry: bool = True, linear_raster: bool = False, allowed: list[str] | None = None) -> DataFrame:
    """The filters one after another over products of a frame, and the latest version of what is left."""
    df = without_range(df, frame)
    df = preferred_geometry(df, frame, linear_geometry, linear_raster)
    df = preferred_eye(df, eye)
    df = preferred_colour(df.where(F.col("type").isin(*RASTER)), [*frame, "type", "geometry"], colour_first).unionByName(df.where(~F.col("type").isin(*RASTER)))
    df = best_special(df, [*frame, "type"], allowed or ["_"])
    return latest_version(df, [*frame, "type", "geometry", "color"])


def wedge_limits(df: DataFrame, keys: list[str], order: list[Column], camera: Column, most: int, most_nav: int, most_mast: int) -> DataFrame:
    """At most ``most`` wedges of a group in ``order``, of which ``most_nav`` of navigation cameras and one more than ``most_mast`` of mast cameras.

    ``camera``: 'Navcam', 'Mastcam' or other. A wedge over its camera's cap is skipped and does not count.
    """
    cap = F.when(F.col("__c") == "Navcam", most_nav).when(F.col("__c") == "Mastcam", most_mast + 1)
    df = df.withColumn("__c", F.coalesce(camera, F.lit(""))).withColumn("__n", F.row_number().over(Window.partitionBy(*keys, "__c").orderBy(*order)))
    df = df.where(cap.isNull() | (F.col("__n") <= cap))
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__n") <= most).drop("__c", "__n")


def latest_meshes(df: DataFrame, keys: list[str], linear_first: bool = True) -> DataFrame:
    """One mesh of each site drive and camera: preferred geometry, then greater sol, then greater version, then greater id."""
    wanted = F.col("geometry") == ("Linearized" if linear_first else "Raw")
    top = F.row_number().over(Window.partitionBy(*keys).orderBy(wanted.desc(), F.col("sol").desc(), F.col("version").desc(), F.col("id").desc()))
    return df.withColumn("__n", top).where("__n = 1").drop("__n")


def listed(lines: DataFrame, base: str = "") -> DataFrame:
    """Rows (url) of a list file's lines (value): blank lines and those that begin with # are left out, ``base`` goes before the rest."""
    text = F.trim("value")
    return lines.where((text != "") & ~text.startswith("#")).select(F.concat(F.lit(base), text).alias("url")).distinct()


def in_sols(df: DataFrame, sols: list[tuple[int, int]]) -> DataFrame:
    """Rows whose sol lies in one of the closed ranges; all without ranges."""
    hit = F.lit(not sols)
    for low, high in sols:
        hit = hit | F.col("sol").between(low, high)
    return df.where(hit)


def use_product(camera: Column, kind: Column, accepted: dict[str, list[str]]) -> Column:
    """Whether a mission takes a type of product of a camera."""
    out = F.lit(False)
    for name, kinds in accepted.items():
        out = out | ((camera == name) & kind.isin(*kinds))
    return out


def site_drive_order(priority: str, project: str | None = None) -> list[Column]:
    """Sort columns over (site_drive, area) for Newest, Oldest, Biggest, Smallest or ProjectThenBiggest; ties by site drive."""
    orders = {
        "Newest": [F.col("site_drive").desc()], "Oldest": [F.col("site_drive")], "Biggest": [F.col("area").desc()], "Smallest": [F.col("area")],
        "ProjectThenBiggest": [(F.col("site_drive") != (project or "")).cast("int"), F.col("area").desc()],
    }
    if priority not in orders:
        raise ValueError(f"unknown priority {priority}")
    return [*orders[priority], F.col("site_drive")]


def by_frame(df: DataFrame, linear_first: bool, order: list[Column]) -> DataFrame:
    """One row for each frame with the ids of its best Range, Points, Image, Normals and RoverMask: preferred geometry first, then ``order``."""
    wanted = (F.col("geometry") == ("Linearized" if linear_first else "Raw")).desc()
    first = F.row_number().over(Window.partitionBy("frame", "type").orderBy(wanted, *order))
    best = df.withColumn("__n", first).where("__n = 1")
    return best.groupBy("frame").pivot("type", ["Range", "Points", "Image", "Normals", MASK]).agg(F.first("id"))


def least_recently_used(df: DataFrame, keys: list[str], at: str, capacity: int) -> DataFrame:
    """The entries that a cache of ``capacity`` evicts: all but the latest accessed ones, the greater ``entry`` kept on ties."""
    last = df.groupBy(*keys, "entry").agg(F.max(at).alias(at))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(at).desc(), F.col("entry").desc()))
    return last.withColumn("__n", place).where(F.col("__n") > capacity).drop("__n")
