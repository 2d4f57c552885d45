"""Ranking within groups: best, cascades of preferences, greedy folds, score classes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import cut


def best_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows of each group in ``order``.

    Spark plans the filter as a group limit before the shuffle, so each task sends at
    most ``k`` rows of a group. Give a total order: ties are otherwise arbitrary.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= k).drop("__rank")


def cascade(df: DataFrame, keys: list[str], preferences: Iterable[Column]) -> DataFrame:
    """Rows that survive successive preferences: each keeps a group's rows of greatest value among those left.

    All preferences share one partitioning, so the cascade needs a single shuffle.
    """
    group = Window.partitionBy(*keys)
    for i, value in enumerate(preferences):
        df = df.withColumn(f"__p{i}", value).withColumn(f"__m{i}", F.max(f"__p{i}").over(group))
        df = df.where(F.col(f"__p{i}").eqNullSafe(F.col(f"__m{i}"))).drop(f"__p{i}", f"__m{i}")
    return df


def greedy_budget(df: DataFrame, keys: list[str], order: list[str], cost: str, budget: float, fields: list[str]) -> DataFrame:
    """The rows that a greedy walk keeps: one that would overrun the budget is skipped, later smaller ones still fit.

    ``order`` must be total and is ascending, costs must not be negative. Returns keys, ``pos`` (the
    place among the kept rows, from 0) and ``fields``. With keys the walk is an ordered fold over each
    group's rows, which must fit a task; without keys the table stays dealt by ranges (``_walk``).
    """
    if not keys:
        return _walk(df, order, cost, budget, fields)
    rows = F.array_sort(F.collect_list(F.struct(*order, *[c for c in {cost: 0, **dict.fromkeys(fields, 0)} if c not in order])))
    empty = F.struct(F.lit(0.0).alias("total"), F.filter(F.col("rows"), lambda r: F.lit(False)).alias("kept"))

    def step(acc: Column, r: Column) -> Column:
        fits = acc["total"] + r[cost] <= budget
        return F.struct(
            F.when(fits, acc["total"] + r[cost]).otherwise(acc["total"]).cast("double").alias("total"),
            F.when(fits, F.concat(acc["kept"], F.array(r))).otherwise(acc["kept"]).alias("kept"),
        )

    groups = df.groupBy(*keys).agg(rows.alias("rows")) if keys else df.agg(rows.alias("rows"))
    folded = groups.withColumn("acc", F.aggregate("rows", empty, step))
    return folded.select(*keys, F.posexplode("acc.kept").alias("pos", "r")).select(*keys, "pos", *[F.col(f"r.{c}").alias(c) for c in fields])


def _walk(df: DataFrame, order: list[str], cost: str, budget: float, fields: list[str]) -> DataFrame:
    """``greedy_budget`` over a whole table.

    Rows that cost more than what is left can never fit. Of the others, in order, all fit up to the
    first that overruns; it is skipped, and the search goes on behind it with what is left. Each
    such round sums the partitions, then looks into the one where the budget runs out; the driver
    receives a row for each partition.
    """
    placed = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"__p": F.spark_partition_id(), "__i": F.monotonically_increasing_id()}))
    left, start, taken = float(budget), -1, F.lit(False)
    while True:
        open_ = placed.where((F.col("__i") > start) & (F.col(cost) <= left))
        before, where = 0.0, None
        for r in sorted(open_.groupBy("__p").agg(F.sum(cost).alias("s")).collect()):
            if before + r["s"] > left:
                where = r["__p"]
                break
            before += float(r["s"])
        if where is None:
            taken = taken | ((F.col("__i") > start) & (F.col(cost) <= left))
            break
        inner = open_.where(F.col("__p") == where).select("__i", "__p", F.col(cost).alias("c")).withColumn("u", F.sum("c").over(Window.partitionBy("__p").orderBy("__i")))
        stop = inner.where(F.col("u") + before > left).agg(F.min(F.struct("__i", (F.col("u") - F.col("c")).alias("u"))).alias("s")).first()["s"]
        taken = taken | (F.col("__i").between(start + 1, stop["__i"] - 1) & (F.col(cost) <= left))
        left, start = left - before - float(stop["u"]), stop["__i"]
    kept = placed.where(taken).withColumn("__n", F.row_number().over(Window.partitionBy("__p").orderBy("__i")))
    sizes = sorted(kept.groupBy("__p").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, total = [], 0
    for r in sizes:
        offsets.append((r["__p"], total))
        total += r["n"]
    base = df.sparkSession.createDataFrame(offsets or [(0, 0)], "__p int, __o long")  # a row for each partition
    out = kept.join(F.broadcast(base), "__p").withColumn("pos", (F.col("__n") + F.col("__o") - 1).cast("int"))
    return out.select("pos", *fields)


def score_classes(df: DataFrame, keys: list[str], score: str, ident: str, tolerance: float) -> DataFrame:
    """Class numbers by descending score: a row starts a class when it falls short of the class's head by more than ``tolerance``.

    Rows are compared with the head of their class, not with their predecessor.
    """
    rows = F.sort_array(F.collect_list(F.struct(F.col(score).alias("s"), (-F.col(ident)).alias("i"))), asc=False)
    start = F.struct(F.lit(None).cast("double").alias("head"), F.lit(-1).alias("cls"), F.expr("array()").cast("array<struct<i:bigint,cls:int>>").alias("out"))

    def step(acc: Column, r: Column) -> Column:
        fresh = acc["head"].isNull() | (acc["head"] - r["s"] > tolerance)
        cls = F.when(fresh, acc["cls"] + 1).otherwise(acc["cls"])
        item = F.struct((-r["i"]).cast("bigint").alias("i"), cls.alias("cls"))
        return F.struct(F.when(fresh, r["s"]).otherwise(acc["head"]).alias("head"), cls.alias("cls"), F.concat(acc["out"], F.array(item)).alias("out"))

    groups = df.groupBy(*keys).agg(rows.alias("rows"))
    out = groups.withColumn("acc", F.aggregate("rows", start, step)).select(*keys, F.explode("acc.out").alias("r"))
    return out.select(*keys, F.col("r.i").alias(ident), F.col("r.cls").alias("score_class"))


def islands(df: DataFrame, keys: list[str], value: str, step: int = 1) -> DataFrame:
    """Maximal runs of consecutive integers of each group: keys, first, last, n."""
    distinct = df.select(*keys, value).distinct()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(value))
    runs = distinct.withColumn("__run", F.col(value) - place * step)
    return runs.groupBy(*keys, "__run").agg(F.min(value).alias("first"), F.max(value).alias("last"), F.count(F.lit(1)).alias("n")).drop("__run")
