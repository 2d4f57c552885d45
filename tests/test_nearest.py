"""Findings of round 2: nearest rows by value and by vector, without lists of pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from orogen.operators import joins
from orogen.plans import joining


def test_nearest_value_against_all_pairs(spark):
    rnd = random.Random(5)
    left = [(i, rnd.choice([0, 1, 2, None]), round(rnd.uniform(-300, 900), 1)) for i in range(300)]
    left += [(300, 0, None), (301, 1, math.nan), (302, 2, math.inf), (303, 7, 1.0), (0, 1, 5.0)]
    right = [(rnd.randrange(1000), rnd.choice([0, 1, 2, None]), round(rnd.choice([rnd.uniform(-100, 100), rnd.uniform(500, 5000)]), 1)) for _ in range(120)]
    right += [(2000 + i, 0, 250.0) for i in range(3)] + [(3000, 8, 1.0)]
    a = spark.createDataFrame(left, "o long, k int, x double")
    b = spark.createDataFrame(right, "s long, k int, y double")
    found = joins.nearest_value(a, b, ["k"], F.col("x"), F.col("y"), "s", 50)
    ours = sorted((r["o"], r["best"]["id"], r["passing"]) for r in found.collect())
    pairs = a.withColumn("row", F.monotonically_increasing_id()).join(b, "k")
    plain = pairs.groupBy("row", "o").agg(F.min_by("s", F.struct(F.abs(F.col("x") - F.col("y")), "s")).alias("best"), F.count(F.lit(1)).alias("n"))
    assert ours == sorted((r["o"], r["best"], r["n"]) for r in plain.collect())


def test_backproject_rank_joins_no_pairs(spark, data):
    plan = joining.backproject_rank(spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" not in plan


@pytest.mark.parametrize("block", [2048, 16])
def test_nearest_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(joins, "BLOCK", block)
    rnd = random.Random(6)
    rows = [(i, [rnd.choice([0.0, 1.0, rnd.random()]) for _ in range(6)], i % 2) for i in range(80)]
    rows += [(100 + i, rows[i][1], rows[i][2]) for i in range(0, 40, 3)]  # copies, and distances that tie
    df = spark.createDataFrame(rows, "id long, v array<float>, g int")
    ours = sorted((r["q_id"], r["rank"], r["b_id"], r["dist"]) for r in joins.nearest(df, df, "id", "v", "g", 2).collect())
    own = [(r["id"], r["v"], r["g"]) for r in df.collect()]
    wanted = []
    for i, v, g in own:
        near = []
        for j, w, h in own:
            if h == g and j != i:
                total = 0.0
                for c, d in zip(v, w, strict=True):
                    total += (c - d) * (c - d)
                near.append((math.sqrt(total), j))
        wanted += [(i, r + 1, j, d) for r, (d, j) in enumerate(sorted(near)[:2])]
    assert ours == sorted(wanted)


def test_nearest_lists_no_pairs_and_skips_missing_components(spark):
    rows = [(1, [1.0, None], 0), (2, [1.0, 5.0], 0), (3, None, 0), (4, [3.0, 5.0], 0), (5, [], 0), (6, [2.0], None), (7, [4.0], 1)]
    df = spark.createDataFrame(rows, "id long, v array<float>, g int")
    found = joins.nearest(df, df, "id", "v", "g", 2)
    got = {(r["q_id"], r["rank"]): (r["b_id"], r["dist"]) for r in found.collect()}
    assert got[1, 1] == (2, 0.0) and got[1, 2] == (4, 2.0) and got[4, 1] == (1, 2.0) and got[4, 2] == (2, 2.0)
    assert got[3, 1] == (1, None) and got[5, 2] == (2, None) and not any(q in (6, 7) for q, _ in got)
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().optimizedPlan().toString()
