"""Hierarchies, components and quadtrees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (node, component): connected components, labelled by their least node.

    Large-star and small-star steps by turns: every node's greater neighbours, then its lesser
    ones, are linked to its least neighbour, until nothing changes; long paths halve in each
    turn. Hubs are reduced by partial aggregation. Lineage is cut by reliable checkpoints where
    a checkpoint folder is set.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    alone = pairs.select("u").union(pairs.select("v")).distinct().withColumnRenamed("u", "node")
    links = cut(pairs.where("u <> v").select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).distinct())
    seen = _state(links)
    while seen[0]:
        both = links.union(links.select("lo", "hi")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        links = cut(small.union(low.select("hi", "m")).distinct())
        seen, before = _state(links), seen
        if seen == before:
            break
    return alone.join(links, F.col("node") == F.col("hi"), "left").select("node", F.coalesce("lo", "node").alias("component"))


def _state(links: DataFrame) -> tuple[int, int]:
    r = links.agg(F.count(F.lit(1)), F.expr("coalesce(bit_xor(xxhash64(hi, lo)), 0)")).first()
    return r[0], r[1]


def cut(df: DataFrame) -> DataFrame:
    """``df`` from a reliable checkpoint, if the session names a folder for them."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint() if folder or spark.sparkContext.getCheckpointDir() else df


def hierarchy(nodes: DataFrame, ident: str, parent: str, levels: int) -> DataFrame:
    """Rows (node, path, depth, root): ids from the root down, by doubling ancestor pointers.

    After round k every node knows 2**k ancestors, so ``levels`` is met after log2 rounds; a
    chain of more than ``levels`` nodes, or a circle, raises. Nodes whose chain ends at a missing
    parent keep the path found so far, root null.
    """
    at = nodes.select(F.col(ident).alias("node"), F.col(parent).alias("up"), F.array(ident).alias("path"))
    done = 1
    while done < levels:
        above = at.select(F.col("node").alias("p"), F.col("up").alias("up2"), F.col("path").alias("path2"))
        at = at.join(above, at.up == above.p, "left").select(
            "node", F.when(F.col("p").isNotNull(), F.col("up2")).otherwise(F.col("up")).alias("up"), F.concat(F.coalesce("path2", F.array().cast(at.schema["path"].dataType)), "path").alias("path")
        )
        done *= 2
    more = at.join(nodes.select(F.col(ident).alias("__known")), F.col("up") == F.col("__known"), "left")
    path = F.when(F.col("__known").isNotNull(), F.raise_error(F.lit(f"a chain is longer than {levels} nodes"))).otherwise(F.col("path"))
    return more.select("node", path.alias("path"), "up").select("node", "path", (F.size("path") - 1).alias("depth"), F.when(F.col("up").isNull(), F.col("path")[0]).alias("root"))


def quadkeys(x: Column, y: Column, levels: int) -> list[Column]:
    """Cell codes of (x, y) in [0, 1) at levels 0 to ``levels``: two bits a level, y's above x's."""
    out = [F.lit(0).cast("long")]
    for level in range(1, levels + 1):
        size = 1 << level
        cx, cy = (F.greatest(F.lit(0), F.least(F.lit(size - 1), F.floor(v * size))) for v in (x, y))
        code = F.lit(0).cast("long")
        for b in range(level):
            code = code + F.shiftright(cx, b).bitwiseAND(F.lit(1)) * (1 << (2 * b)) + F.shiftright(cy, b).bitwiseAND(F.lit(1)) * (1 << (2 * b + 1))
        out.append(code.cast("long"))
    return out


def quadtree(points: DataFrame, x: Column, y: Column, most: int, levels: int) -> DataFrame:
    """Nodes (level, code, n, is_leaf, bounds) of a quadtree that splits cells with more than ``most`` points.

    All levels are counted in one aggregation; a node exists when its parent splits.
    """
    keyed = points.select(x.alias("x"), y.alias("y"))
    cells = F.array(*[F.struct(F.lit(i).alias("level"), k.alias("code")) for i, k in enumerate(quadkeys(F.col("x"), F.col("y"), levels))])
    counts = keyed.select("x", "y", F.explode(cells).alias("c")).groupBy(F.col("c.level").alias("level"), F.col("c.code").alias("code")).agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("min_x"), F.max("x").alias("max_x"), F.min("y").alias("min_y"), F.max("y").alias("max_y")
    )
    parent = counts.select((F.col("level") + 1).alias("level"), F.col("code").alias("up"), F.col("n").alias("up_n"))
    kept = counts.withColumn("up", F.shiftright("code", 2)).join(parent, ["level", "up"], "left").where((F.col("level") == 0) | (F.col("up_n") > most))
    return kept.select("level", "code", "n", ((F.col("n") <= most) | (F.col("level") == levels)).alias("is_leaf"), "min_x", "max_x", "min_y", "max_y")
