"""Aggregations, histograms and raster windows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.stats import decimate, histogram, median_and_mad, percent_stretch, running_stats, upper_median
from ..tables import read


def _rounded(df, places, *cols):
    return df.withColumns({c: F.round(c, places) for c in cols})


def welford(spark, sf_dir):
    stats = read(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(*running_stats(F.col("l_extendedprice")))
    return _rounded(stats, 2, "mean", "stddev", "min", "max").withColumn("variance", F.round("variance", -2))


def upper_median_mad(spark, sf_dir):
    return _rounded(median_and_mad(read(spark, sf_dir, "orders"), ["o_orderpriority"], "o_totalprice"), 2, "median", "mad")


def median_of_medians(spark, sf_dir):
    inner = upper_median(read(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_extendedprice", "m")
    return _rounded(upper_median(inner, [], "m"), 2, "median")


def discount_histogram(spark, sf_dir):
    return histogram(read(spark, sf_dir, "lineitem"), F.col("l_quantity"), 1.0, 41.0, 16)


def pct_stretch(spark, sf_dir):
    hist = histogram(read(spark, sf_dir, "lineitem"), F.col("l_quantity"), 0.0, 64.0, 64)
    return percent_stretch(hist, 0.02)


def _grid(spark, sf_dir):
    """A raster of events: days by hours, the mean value."""
    events = read(spark, sf_dir, "events")
    return events.groupBy(F.dayofmonth("ts").alias("row"), F.hour("ts").alias("col")).agg(F.avg("value").alias("v"))


def block_decimate(spark, sf_dir):
    out = decimate(_grid(spark, sf_dir), F.col("row"), F.col("col"), F.col("v"), 5, 32, 24)
    return _rounded(out, 6, "mean")


def blur(spark, sf_dir):
    row = Window.partitionBy("row").orderBy("col").rangeBetween(-1, 1)
    return _grid(spark, sf_dir).select("row", "col", F.round(F.avg("v").over(row), 6).alias("blurred"))


def bilinear(spark, sf_dir):
    grid = _grid(spark, sf_dir)
    right = grid.select("row", (F.col("col") - 1).alias("col"), F.col("v").alias("v01"))
    below = grid.select((F.col("row") - 1).alias("row"), "col", F.col("v").alias("v10"))
    corner = grid.select((F.col("row") - 1).alias("row"), (F.col("col") - 1).alias("col"), F.col("v").alias("v11"))
    four = grid.join(right, ["row", "col"]).join(below, ["row", "col"]).join(corner, ["row", "col"])
    return four.select("row", "col", F.round(F.expr("0.5 * (0.75 * v + 0.25 * v01) + 0.5 * (0.75 * v10 + 0.25 * v11)"), 6).alias("sampled"))


def level_stats(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    cube = lines.rollup("l_returnflag", "l_linestatus").agg(F.grouping_id().cast("int").alias("lvl"), F.count(F.lit(1)).alias("n"), F.round(F.avg("l_quantity"), 6).alias("mean_qty"))
    return cube


def grid_prune(spark, sf_dir):
    cell = [F.floor(F.col("embedding")[i].cast("double") * 4).cast("int").alias(f"c{i}") for i in range(2)]
    away = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    points = read(spark, sf_dir, "embeddings").withColumn("scaled", away * (1 + F.col("vec_id") % 5)).select("vec_id", "scaled", *cell)
    kept = points.withColumn("least", F.min("scaled").over(Window.partitionBy("c0", "c1"))).where("scaled <= 1.2 * least")
    return kept.select("vec_id", "c0", "c1")


QUERIES = {
    "welford": welford, "upper_median_mad": upper_median_mad, "median_of_medians": median_of_medians, "histogram": discount_histogram, "pct_stretch": pct_stretch,
    "block_decimate": block_decimate, "blur": blur, "bilinear": bilinear, "level_stats": level_stats, "grid_prune": grid_prune,
}

_GRID = "(SELECT CAST(extract(day FROM ts) AS INTEGER) AS row, CAST(extract(hour FROM ts) AS INTEGER) AS col, avg(value) AS v FROM events GROUP BY 1, 2)"
_UPPER = "list_sort(list({v}))[len(list({v})) // 2 + 1]"

ORACLES = {
    "welford": """SELECT l_returnflag, l_linestatus, count(l_extendedprice) AS n, round(avg(l_extendedprice), 2) AS mean, round(var_samp(l_extendedprice), -2) AS variance,
        round(stddev_samp(l_extendedprice), 2) AS stddev, round(min(l_extendedprice), 2) AS min, round(max(l_extendedprice), 2) AS max FROM lineitem GROUP BY 1, 2""",
    "upper_median_mad": f"""WITH m AS (SELECT o_orderpriority, {_UPPER.format(v='o_totalprice')} AS median FROM orders GROUP BY 1)
        SELECT o_orderpriority, round(any_value(median), 2) AS median, round({_UPPER.format(v='abs(o_totalprice - median)')}, 2) AS mad FROM orders JOIN m USING (o_orderpriority) GROUP BY 1""",
    "median_of_medians": f"SELECT round({_UPPER.format(v='m')}, 2) AS median FROM (SELECT {_UPPER.format(v='l_extendedprice')} AS m FROM lineitem GROUP BY l_suppkey)",
    "histogram": "SELECT CAST(greatest(0, least(15, floor((l_quantity - 1) / 2.5))) AS INTEGER) AS bin, count(*) AS n FROM lineitem GROUP BY 1",
    "pct_stretch": """WITH h AS (SELECT CAST(greatest(0, least(63, floor(l_quantity))) AS INTEGER) AS bin, count(*) AS n FROM lineitem GROUP BY 1),
        s AS (SELECT bin, sum(n) OVER (ORDER BY bin) AS up, sum(n) OVER (ORDER BY bin DESC) AS down, sum(n) OVER () AS total FROM h WHERE bin > 0)
        SELECT min(CASE WHEN up >= total * 0.02 THEN bin END) AS low_bin, max(CASE WHEN down >= total * 0.02 THEN bin END) AS high_bin FROM s""",
    "block_decimate": f"SELECT CAST(row // 5 AS INTEGER) AS brow, CAST(col // 5 AS INTEGER) AS bcol, round(avg(v), 6) AS mean, count(v) AS n FROM {_GRID} WHERE row < 30 AND col < 20 GROUP BY 1, 2",
    "blur": f"SELECT row, col, round(avg(v) OVER (PARTITION BY row ORDER BY col RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING), 6) AS blurred FROM {_GRID}",
    "bilinear": f"""WITH g AS {_GRID} SELECT a.row, a.col, round(0.5 * (0.75 * a.v + 0.25 * b.v) + 0.5 * (0.75 * c.v + 0.25 * d.v), 6) AS sampled FROM g a
        JOIN g b ON b.row = a.row AND b.col = a.col + 1 JOIN g c ON c.row = a.row + 1 AND c.col = a.col JOIN g d ON d.row = a.row + 1 AND d.col = a.col + 1""",
    "level_stats": "SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag, l_linestatus) AS INTEGER) AS lvl, count(*) AS n, round(avg(l_quantity), 6) AS mean_qty FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)",
    "grid_prune": """SELECT vec_id, c0, c1 FROM (SELECT vec_id, sqrt(list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE)))) * (1 + vec_id % 5) AS scaled,
        CAST(floor(CAST(embedding[1] AS DOUBLE) * 4) AS INTEGER) AS c0, CAST(floor(CAST(embedding[2] AS DOUBLE) * 4) AS INTEGER) AS c1 FROM embeddings)
        QUALIFY scaled <= 1.2 * min(scaled) OVER (PARTITION BY c0, c1)""",
}
