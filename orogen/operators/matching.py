"""Matches of features between pictures: filters, robust fits and poses along a spanning tree.

One pair of pictures has at most a few thousand matches; each pair is one group, worked on by itself.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..registry import MATCH_FILTERS
from .stats import median_and_mad

MATCH = "pair string, match long, mx double, my double, fx double, fy double"


def _rigid(m: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(turn 2 x 2, shift) that best carries the points m to f."""
    a, b = m - m.mean(axis=0), f - f.mean(axis=0)
    angle = np.arctan2((a[:, 0] * b[:, 1] - a[:, 1] * b[:, 0]).sum(), (a * b).sum())
    turn = np.array([[np.cos(angle), -np.sin(angle)], [np.sin(angle), np.cos(angle)]])
    return turn, f.mean(axis=0) - turn @ m.mean(axis=0)


def ransac(m: np.ndarray, f: np.ndarray, radius: float, tries: int, seed: int = 1) -> np.ndarray:
    """Which matches agree, within ``radius``, with the rigid motion of the pair of matches that most agree with, refitted once.

    All pairs are tried if there are at most ``tries``, in shuffled order, else so many different random ones.
    """
    n, rng = len(m), np.random.default_rng(seed)
    if n < 2:
        return np.zeros(n, bool)
    if n * (n - 1) // 2 <= tries:
        pairs = list(itertools.combinations(range(n), 2))
        rng.shuffle(pairs)
    else:
        chosen: dict[tuple[int, int], None] = {}
        while len(chosen) < tries:
            i, j = rng.choice(n, 2, replace=False).tolist()
            chosen[min(i, j), max(i, j)] = None
        pairs = list(chosen)
    best = np.zeros(n, bool)
    for pair in pairs:
        at = list(pair)
        turn, shift = _rigid(m[at], f[at])
        good = np.linalg.norm(m @ turn.T + shift - f, axis=1) <= radius
        if good.sum() >= 2:
            turn, shift = _rigid(m[good], f[good])
            good = np.linalg.norm(m @ turn.T + shift - f, axis=1) <= radius
        if good.sum() > best.sum():
            best = good
    return best


def graph_agreement(m: np.ndarray, f: np.ndarray, k: int = 5) -> np.ndarray:
    """Graph transformation matching: drop the match whose neighbours differ most until both pictures' graphs agree.

    A point's neighbours are its ``k`` nearest that are no farther than the median distance; without ``k`` such it has none.
    """
    alive = np.arange(len(m))

    def neighbours(p: np.ndarray) -> np.ndarray:
        d = np.linalg.norm(p[:, None] - p[None], axis=2)
        n = len(p)
        out = np.zeros((n, n), bool)
        if n <= k:
            return out
        limit = np.median(d[~np.eye(n, dtype=bool)])
        np.fill_diagonal(d, np.inf)
        order = np.argsort(d, axis=1, kind="stable")[:, :k]
        near = np.take_along_axis(d, order, axis=1)
        for i in np.flatnonzero((near <= limit).all(axis=1)):
            out[i, order[i]] = True
        return out

    while len(alive):
        a, b = neighbours(m[alive]), neighbours(f[alive])
        differ = a != b
        if not differ.any():
            kept = a.any(axis=1) | a.any(axis=0)
            alive = alive[kept]
            break
        worst = differ.sum(axis=0) + differ.sum(axis=1)
        alive = np.delete(alive, int(worst.argmax()))
    out = np.zeros(len(m), bool)
    out[alive] = True
    return out


def _kept(matches: DataFrame, test) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("match")
        return pdf[test(pdf[["mx", "my"]].to_numpy(float), pdf[["fx", "fy"]].to_numpy(float))]

    return matches.select("pair", "match", "mx", "my", "fx", "fy").groupBy("pair").applyInPandas(run, MATCH)


@MATCH_FILTERS.register("ransac")
def ransac_matches(matches: DataFrame, radius: float, tries: int = 1000) -> DataFrame:
    return _kept(matches, lambda m, f: ransac(m, f, radius, tries))


@MATCH_FILTERS.register("gtm")
def graph_matches(matches: DataFrame, k: int = 5) -> DataFrame:
    return _kept(matches, lambda m, f: graph_agreement(m, f, k))


@MATCH_FILTERS.register("length")
def usual_lengths(matches: DataFrame, k: float) -> DataFrame:
    """Matches (pair, match, length) whose length lies less than ``k`` upper median deviations from the pair's upper median."""
    stats = median_and_mad(matches, ["pair"], "length")
    return matches.join(stats, "pair").where(F.abs(F.col("length") - F.col("median")) < k * F.col("mad")).drop("median", "mad")


def pose_tree(edges: DataFrame, fixed: str) -> DataFrame:
    """Rows (node, steps, angle, x, y): poses of pictures from pairwise motions (a, b, n, angle, x, y), from ``fixed`` outwards.

    An edge carries points of b to a. Nodes are reached in the fewest steps, over the edge with the
    most matches (then the least name); a round joins the last nodes with their edges. Nodes that
    no edge reaches have no row.
    """
    from .graph import cut

    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "n", (-F.col("angle")).alias("angle"), (-(F.cos("angle") * F.col("x") + F.sin("angle") * F.col("y"))).alias("x"), (F.sin("angle") * F.col("x") - F.cos("angle") * F.col("y")).alias("y"))
    both = cut(edges.select("a", "b", "n", "angle", "x", "y").unionByName(back))
    spark = edges.sparkSession
    found = last = spark.createDataFrame([(fixed, 0, 0.0, 0.0, 0.0)], "node string, steps int, angle double, x double, y double")
    while True:
        base = last.select(F.col("node").alias("a"), (F.col("steps") + 1).alias("steps"), F.col("angle").alias("t"), F.col("x").alias("px"), F.col("y").alias("py"))
        step = both.join(base, "a").join(found.select(F.col("node").alias("b")), "b", "left_anti")
        pose = F.struct(
            F.col("n"), (F.col("t") + F.col("angle")).alias("angle"),
            (F.cos("t") * F.col("x") - F.sin("t") * F.col("y") + F.col("px")).alias("x"), (F.sin("t") * F.col("x") + F.cos("t") * F.col("y") + F.col("py")).alias("y"),
        )
        last = step.groupBy(F.col("b").alias("node")).agg(F.first("steps").alias("steps"), F.max_by(pose, F.struct("n", F.col("a"))).alias("p")).select("node", "steps", "p.angle", "p.x", "p.y")
        last = cut(last)
        if not last.take(1):
            return found
        found = cut(found.unionByName(last))


def grouped(edges: DataFrame) -> DataFrame:
    """Rows (node, component): pictures that matches join, directly or through others."""
    from .graph import components

    return components(edges, "a", "b")
