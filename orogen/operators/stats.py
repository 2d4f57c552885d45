"""Statistics with the semantics of the original: sample variance, upper medians, clamped histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_stats(value: Column) -> list[Column]:
    """count, mean, variance (n - 1; 0 up to one value), standard deviation, min and max; zeros when empty."""
    n = F.count(value)
    var = F.when(n > 1, F.var_samp(value)).otherwise(F.lit(0.0))
    zero = F.lit(0.0)
    return [n.alias("n"), F.coalesce(F.avg(value), zero).alias("mean"), var.alias("variance"), F.sqrt(var).alias("stddev"), F.coalesce(F.min(value), zero).alias("min"), F.coalesce(F.max(value), zero).alias("max")]


def upper_median(df: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """The element of rank n div 2 (from 0) of each group's sorted non-null values: the upper median.

    Found by a window over the group's counts of equal values, not by collecting the values.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    group = Window.partitionBy(*keys)
    upto = F.sum("__n").over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.withColumn("__upto", upto).withColumn("__all", F.sum("__n").over(group))
    hit = placed.where("__upto > __all div 2 and __upto - __n <= __all div 2")
    return hit.select(*keys, F.col(value).alias(name))


def median_and_mad(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Upper median and upper median of absolute deviations from it."""
    med = upper_median(df, keys, value, "median")
    joined = df.join(med, keys) if keys else df.crossJoin(F.broadcast(med))  # one row
    mad = upper_median(joined.withColumn("__d", F.abs(F.col(value) - F.col("median"))), keys, "__d", "mad")
    return med.join(mad, keys) if keys else med.crossJoin(F.broadcast(mad))


def histogram(df: DataFrame, value: Column, low: float, high: float, bins: int) -> DataFrame:
    """Rows (bin, n) of floor((value - low) / width), clamped to the first and last bin; empty bins are absent."""
    scaled = F.floor((value - low) / ((high - low) / bins))
    clamped = F.greatest(F.lit(0), F.least(F.lit(bins - 1), scaled)).cast("int")
    return df.where(value.isNotNull()).groupBy(clamped.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def percent_stretch(hist: DataFrame, fraction: float) -> DataFrame:
    """One row (low_bin, high_bin): first bins whose tails reach ``fraction`` of the counts, bin 0 (black) left out.

    ``hist`` has one row for each bin, a bounded number, so its running sums need no dealing.
    """
    counts = hist.where("bin > 0")
    up = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(F.lit(0))
    sums = counts.select("bin", F.sum("n").over(up).alias("up"), F.sum("n").over(down).alias("down"), F.sum("n").over(every).alias("total"))
    return sums.agg(F.min(F.when(F.col("up") >= F.col("total") * fraction, F.col("bin"))).alias("low_bin"), F.max(F.when(F.col("down") >= F.col("total") * fraction, F.col("bin"))).alias("high_bin"))


def decimate(df: DataFrame, row: Column, col: Column, value: Column, block: int, rows: int, cols: int) -> DataFrame:
    """Means of whole ``block`` x ``block`` cells; cells that the edge cuts are dropped."""
    inside = (row < rows // block * block) & (col < cols // block * block)
    cell = [F.floor(row / block).cast("int").alias("brow"), F.floor(col / block).cast("int").alias("bcol")]
    return df.where(inside).groupBy(*cell).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))
