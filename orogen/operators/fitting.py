"""Fits from sums: every one is a single aggregation with partial sums, closed in Columns or, for small matrices, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import normalize, vec


def rms(value: Column) -> Column:
    """Root mean square; 0 of no rows."""
    return F.coalesce(F.sqrt(F.avg(value * value)), F.lit(0.0))


def mean_and_covariance(df: DataFrame, keys: list[str], columns: list[str], weight: str | None = None, population: bool = False) -> DataFrame:
    """Rows (keys, n, mean, covariance): array and row-major array of a group's points.

    Without ``weight`` the covariance is divided by n - 1 (``population``: n) and zero for one
    point; with it, the mean and the covariance are plain weighted sums about that mean.
    """
    w = F.col(weight) if weight else F.lit(1.0)
    size = F.count(F.lit(1))
    total = F.lit(1.0) if weight else size
    mean = df.groupBy(*keys).agg(size.alias("n"), *[(F.sum(w * F.col(c)) / total).alias(f"__m{i}") for i, c in enumerate(columns)])
    joined = df.join(mean, keys) if keys else df.crossJoin(F.broadcast(mean))  # one row
    over = F.lit(1.0) if weight else F.first("n") if population else F.nullif(F.first("n") - 1, F.lit(0))
    off = [F.col(c) - F.col(f"__m{i}") for i, c in enumerate(columns)]
    cov = F.array(*[F.coalesce(F.sum(w * a * b) / over, F.lit(0.0)) for a in off for b in off])
    return joined.groupBy(*keys).agg(F.first("n").alias("n"), F.array(*[F.first(f"__m{i}") for i in range(len(columns))]).alias("mean"), cov.alias("covariance"))


def principal_axes(stats: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Rows (keys, values, axes) of ``mean_and_covariance``: the greatest eigenvalues and their unit vectors, first non-zero part positive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, axes = [], []
            for cov in batch.column("covariance").to_pylist():
                n = round(len(cov) ** 0.5)
                w, v = np.linalg.eigh(np.array(cov).reshape(n, n))
                order = np.argsort(-w)[:most]
                v = v[:, order].T
                lead = np.take_along_axis(v, np.argmax(np.abs(v) > 1e-12, axis=1)[:, None], axis=1)
                values.append(w[order].tolist())
                axes.append((v * np.where(lead < 0, -1.0, 1.0)).tolist())
            kept = [batch.column(k) for k in keys]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(values, pa.list_(pa.float64())), pa.array(axes, pa.list_(pa.list_(pa.float64())))], [*keys, "values", "axes"])

    fields = [f"`{k}` {stats.schema[k].dataType.simpleString()}" for k in keys]
    return stats.select(*keys, "covariance").mapInArrow(run, ", ".join([*fields, "values array<double>", "axes array<array<double>>"]))


def fit_planes(points: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, n, cx, cy, cz, nx, ny, nz): centroid and unit normal of each group's x, y, z.

    The normal comes from the second moments, solved along the axis with the largest
    determinant. Groups of under three points, or on a line, have a null normal.
    """
    mean = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"c{c}") for c in "xyz"])
    joined = points.join(mean, keys) if keys else points.crossJoin(F.broadcast(mean))  # one row
    d = {c: F.col(c) - F.col(f"c{c}") for c in "xyz"}
    pairs = ("xx", "xy", "xz", "yy", "yz", "zz")
    sums = joined.groupBy(*keys).agg(*[F.first(c).alias(c) for c in ("n", "cx", "cy", "cz")], *[F.sum(d[a] * d[b]).alias(f"__{a}{b}") for a, b in pairs])
    m = {p: F.col(f"__{p}") for p in pairs}
    dx, dy, dz = m["yy"] * m["zz"] - m["yz"] * m["yz"], m["xx"] * m["zz"] - m["xz"] * m["xz"], m["xx"] * m["yy"] - m["xy"] * m["xy"]
    xy, xz, yz = m["xz"] * m["yz"] - m["xy"] * m["zz"], m["xy"] * m["yz"] - m["xz"] * m["yy"], m["xy"] * m["xz"] - m["yz"] * m["xx"]
    top = F.greatest(dx, dy, dz)
    raw = [F.when(top == dx, a).when(top == dy, b).otherwise(c) for a, b, c in ((dx, xy, xz), (xy, dy, yz), (xz, yz, dz))]
    unit = normalize(vec(*raw))
    ok = (F.col("n") >= 3) & (top > 0)
    return sums.select(*keys, "n", "cx", "cy", "cz", *[F.when(ok, unit[c]).alias(f"n{c}") for c in "xyz"])


def rigid_2d(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, n, tx, ty, angle, residual): the turn and shift that best carry (mx, my) to (fx, fy).

    A point p goes to the moving centroid, turned about it, then shifted by t, the difference of
    the centroids. The residual is the root of the mean squared distance left. Groups of one
    point, and of points that coincide, are not turned.
    """
    names = ("mx", "my", "fx", "fy")
    mean = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"__{c}") for c in names])
    joined = pairs.join(mean, keys) if keys else pairs.crossJoin(F.broadcast(mean))  # one row
    mx, my, fx, fy = (F.col(c) - F.col(f"__{c}") for c in names)
    sums = joined.groupBy(*keys).agg(
        F.first("n").alias("n"), *[F.first(f"__{c}").alias(c) for c in names], F.sum(mx * fx + my * fy).alias("__cos"), F.sum(mx * fy - my * fx).alias("__sin"),
        F.sum(mx * mx + my * my + fx * fx + fy * fy).alias("__all"),
    )
    left = F.col("__all") - 2 * F.hypot("__cos", "__sin")
    return sums.select(
        *keys, "n", (F.col("fx") - F.col("mx")).alias("tx"), (F.col("fy") - F.col("my")).alias("ty"), F.atan2("__sin", "__cos").alias("angle"),
        F.sqrt(F.greatest(left, F.lit(0.0)) / F.col("n")).alias("residual"),
    )


def similarity_3d(pairs: DataFrame, keys: list[str], scaled: bool = False) -> DataFrame:
    """Rows (keys, n, rotation (row-major 3 x 3), scale, translation, residual) that best carry (mx, my, mz) to (fx, fy, fz).

    fixed = scale * rotation * moving + translation; least squares by the singular values of the
    3 x 3 sums, without reflection. Only the sums of each group reach Python.
    """
    names = [f"{s}{c}" for s in "mf" for c in "xyz"]
    mean = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"__{c}") for c in names])
    joined = pairs.join(mean, keys) if keys else pairs.crossJoin(F.broadcast(mean))  # one row
    off = {c: F.col(c) - F.col(f"__{c}") for c in names}
    sums = joined.groupBy(*keys).agg(
        F.first("n").alias("n"), F.array(*[F.first(f"__{c}") for c in names]).alias("means"), F.array(*[F.sum(off[f"f{a}"] * off[f"m{b}"]) for a in "xyz" for b in "xyz"]).alias("h"),
        F.sum(sum(off[f"m{c}"] * off[f"m{c}"] for c in "xyz")).alias("mm"), F.sum(sum(off[f"f{c}"] * off[f"f{c}"] for c in "xyz")).alias("ff"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n, means, h, mm, ff in zip(*(batch.column(c).to_pylist() for c in ("n", "means", "h", "mm", "ff")), strict=True):
                u, s, vt = np.linalg.svd(np.array(h).reshape(3, 3))
                flip = np.array([1.0, 1.0, np.sign(np.linalg.det(u @ vt)) or 1.0])
                turn, gain = (u * flip) @ vt, float(s @ flip)
                size = gain / mm if scaled and mm > 0 else 1.0
                shift = np.array(means[3:]) - size * turn @ np.array(means[:3])
                out.append((n, turn.ravel().tolist(), size, shift.tolist(), float(np.sqrt(max(0.0, ff + size * size * mm - 2 * size * gain) / n))))
            types = [pa.int64(), pa.list_(pa.float64()), pa.float64(), pa.list_(pa.float64()), pa.float64()]
            cols = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), *cols], [*keys, "n", "rotation", "scale", "translation", "residual"])

    fields = [f"`{k}` {pairs.schema[k].dataType.simpleString()}" for k in keys]
    return sums.mapInArrow(run, ", ".join([*fields, "n long, rotation array<double>, scale double, translation array<double>, residual double"]))


def truncated_histogram(df: DataFrame, value: Column, size: float, *keys: str) -> DataFrame:
    """Rows (keys, bucket, n, low, high): counts by value / size cut towards zero, without ends, so bucket 0 is twice as wide."""
    bucket = F.when(value < 0, F.ceil(value / size)).otherwise(F.floor(value / size)).cast("long")
    out = df.where(value.isNotNull()).groupBy(*keys, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return out.withColumns({"low": F.col("bucket") * size, "high": (F.col("bucket") + 1) * size})


def summed_files(events: DataFrame, path: str, size: str, at: str) -> DataFrame:
    """The latest row of each path, oldest access first by ``rank``, with the running and the total bytes."""
    last = events.groupBy(path).agg(F.max_by(size, F.struct(at, size)).alias(size), F.max(at).alias(at))
    total = last.agg(F.sum(size).alias("total"))
    by_day = Window.partitionBy("__day").orderBy(at, path)
    placed = last.withColumn("__day", F.to_date(at)).withColumns({"__n": F.row_number().over(by_day), "__b": F.sum(size).over(by_day)})
    days = placed.groupBy("__day").agg(F.max("__n").alias("dn"), F.max("__b").alias("db"))
    before = Window.orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)  # a row for each day
    days = days.select("__day", F.coalesce(F.sum("dn").over(before), F.lit(0)).alias("dn"), F.coalesce(F.sum("db").over(before), F.lit(0)).alias("db"))
    out = placed.join(F.broadcast(days), "__day").crossJoin(F.broadcast(total))
    return out.select(path, size, at, (F.col("__n") + F.col("dn")).alias("rank"), (F.col("__b") + F.col("db")).alias("upto"), "total")
