"""Joins that equality alone cannot express, as bucketed equi-joins."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def range_join(left: DataFrame, right: DataFrame, point: Column, low: Column, high: Column, width: float) -> DataFrame:
    """Pairs with low <= point <= high: intervals are spread over buckets of ``width``, points fall into one.

    ``point`` belongs to ``left``, the bounds to ``right``. Choose a width near the
    median interval, so that an interval meets few buckets.
    """
    points = left.withColumn("__b", F.floor(point / width))
    spans = right.withColumn("__b", F.explode(F.sequence(F.floor(low / width), F.floor(high / width))))
    return points.join(spans, "__b").where((point >= low) & (point <= high)).drop("__b")


def asof_previous(df: DataFrame, keys: list[str], at: str, value: Column, within: Column | None = None, name: str = "previous") -> DataFrame:
    """``df`` with the last non-null ``value`` strictly before each row, at most ``within`` old (a bound on its time)."""
    place = F.dense_rank().over(Window.partitionBy(*keys).orderBy(at))  # rows of one time share a place
    before = Window.partitionBy(*keys).orderBy("__place").rangeBetween(Window.unboundedPreceding, -1)
    found = F.last(F.when(value.isNotNull(), F.struct(F.col(at).alias("t"), value.alias("v"))), ignorenulls=True).over(before)
    df = df.withColumn("__place", place)
    out = df.withColumn("__f", found)
    ok = F.lit(True) if within is None else F.col("__f.t") >= within
    return out.withColumn(name, F.when(ok, F.col("__f.v"))).drop("__f", "__place")


def ordered_pairs(df: DataFrame, key: str, condition: Column | None = None) -> DataFrame:
    """Unordered pairs of rows, the lesser key as ``a_*``; ``condition`` narrows the join."""
    a, b = (df.select(*[F.col(c).alias(f"{p}_{c}") for c in df.columns]) for p in "ab")
    on = F.col(f"a_{key}") < F.col(f"b_{key}")
    return a.join(b, on if condition is None else on & condition)


def nearest(queries: DataFrame, base: DataFrame, ident: str, vector: str, group: str, k: int) -> DataFrame:
    """The ``k`` nearest base rows (Euclidean) of each query within its ``group``, ties to the lesser id.

    Both sides are dealt to blocks of about ``BLOCK`` rows of a group, and each pair of blocks
    meets in a task, which sends on the ``k`` best of each query; no list of pairs is made.
    Products of matrices rule pairs out, with room for their rounding; distances of the others
    are summed in the order of the components. As in SQL, components that either vector lacks
    are left out of the sum, and a distance without any component is null and last.
    """
    schema = f"g {base.schema[group].dataType.simpleString()}, q_id {queries.schema[ident].dataType.simpleString()}, b_id {base.schema[ident].dataType.simpleString()}, dist double"
    sides = []
    for df, other in ((queries, base), (base, queries)):
        own = df.select(F.col(group).alias("g"), F.col(ident).alias("id"), F.col(vector).alias("v")).where("g is not null and id is not null")
        for name, of in (("own", df), ("other", other)):
            own = own.join(of.groupBy(F.col(group).alias("g")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias(name)), "g")
        own = own.withColumn("mine", F.expr("pmod(xxhash64(id), own)")).withColumn("its", F.explode(F.expr("sequence(0L, other - 1)")))
        sides.append(own)
    q, b = (own.select("g", *[F.col(c).alias(n) for c, n in zip(("mine", "its"), names, strict=True)], "id", "v") for own, names in zip(sides, ("xy", "yx"), strict=True))
    best = q.groupBy("g", "x", "y").cogroup(b.groupBy("g", "x", "y")).applyInArrow(_block_nearest(k), schema)
    rank = F.row_number().over(Window.partitionBy("q_id").orderBy(F.col("dist").asc_nulls_last(), "b_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).withColumnRenamed("g", group)


#: Rows of a block of ``nearest``, and queries compared at a time.
BLOCK, _QUERIES = 2048, 256


def _block_nearest(k: int):
    """Two blocks (g, x, y, id, v) to rows (g, q_id, b_id, dist): each query's ``k`` nearest of the other block, and rows as near."""

    def dense(vectors: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        rows = [v or [] for v in vectors.to_pylist()]
        out, has = (np.zeros((len(rows), max(1, *map(len, rows))), t) for t in (np.float64, bool))
        for i, row in enumerate(rows):
            has[i, : len(row)] = [c is not None for c in row]
            out[i, : len(row)] = [0.0 if c is None else c for c in row]
        return out, has

    def exact(a: np.ndarray, b: np.ndarray, both: np.ndarray | None) -> np.ndarray:
        total = np.zeros(len(a))
        for d in range(a.shape[1]):  # in the order of the components
            term = (a[:, d] - b[:, d]) ** 2
            total += term if both is None else np.where(both[:, d], term, 0.0)
        return np.sqrt(total if both is None else np.where(both.any(axis=1), total, np.nan))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = [left.schema.field("g").type, left.schema.field("id").type, right.schema.field("id").type, pa.float64()]
        names = ["g", "q_id", "b_id", "dist"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names)
        q_ids, b_ids = (np.array(t.column("id").to_pylist()) for t in (left, right))
        (a, has_a), (b, has_b) = dense(left.column("v")), dense(right.column("v"))
        width = max(a.shape[1], b.shape[1])
        a, has_a, b, has_b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, has_a, b, has_b))
        whole = has_a.all() and has_b.all()
        with np.errstate(all="ignore"):
            norm_a, norm_b = (a * a).sum(axis=1), (b * b).sum(axis=1)
            regular = whole and np.isfinite(norm_a.max() * 4) and np.isfinite(norm_b.max() * 4)
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for at in range(0, len(a), _QUERIES):
                part = slice(at, at + _QUERIES)
                keep = q_ids[part, None] != b_ids
                if regular:
                    near = norm_a[part, None] + norm_b - 2 * (a[part] @ b.T)
                    near[~keep] = np.inf
                    room = 16 * (width + 8) * np.finfo(float).eps * (norm_a[part] + norm_b.max()) + np.finfo(float).tiny
                    kth = np.partition(near, min(k, len(b)) - 1, axis=1)[:, min(k, len(b)) - 1]
                    keep &= near <= (kth + room)[:, None]
                i, j = np.nonzero(keep)
                for lo in range(0, len(i), 1 << 16):
                    x, y = i[lo : lo + (1 << 16)] + at, j[lo : lo + (1 << 16)]
                    found.append((x, y, exact(a[x], b[y], None if whole else has_a[x] & has_b[y])))
        i, j, dist = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        none = np.zeros(len(i), bool) if whole else ~(has_a[i] & has_b[j]).any(axis=1)
        order = np.lexsort((b_ids[j], none, dist, i))
        i, j, dist, none = i[order], j[order], dist[order], none[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        i, j, dist, none = (c[place < k] for c in (i, j, dist, none))
        made = [pa.array([left.column("g")[0].as_py()] * len(i), kinds[0]), pa.array(q_ids[i].tolist(), kinds[1]), pa.array(b_ids[j].tolist(), kinds[2]), pa.array(dist, pa.float64(), mask=none)]
        return pa.table(made, names)

    return run


def nearest_value(left: DataFrame, right: DataFrame, keys: list[str], x: Column, y: Column, ident: str, width: float) -> DataFrame:
    """``left`` with ``best`` (gap, id): the right row of equal keys with the least |x - y|, ties to the lesser ``ident``; and ``passing``, how many have these keys.

    No pairs are listed. Both sides are dealt by their keys and by buckets of ``width``; each
    bucket gets the last value below it and the first above, so that sorted neighbours decide.
    Left rows without a match go, as do right rows without ``y``; where ``x`` is null or not
    finite all gaps are equal. Values of ``y`` on one side of x whose gaps are equal only after
    rounding count as apart.
    """

    def bucket(v: Column) -> Column:
        return F.floor(F.greatest(F.least(v / width, F.lit(1e18)), F.lit(-1e18))).alias("__b")

    known = [F.col(k).isNotNull() for k in keys]
    rows = left.select(*[F.col(k) for k in keys], F.struct(*left.columns).alias("__l"), x.cast("double").alias("__v"))
    values = right.select(*keys, y.cast("double").alias("__v"), F.col(ident).alias("__id")).where(F.col("__v").isNotNull())
    for k in known:
        rows, values = rows.where(k), values.where(k)
    rows = rows.withColumn("__b", F.coalesce(bucket(F.col("__v")), F.lit(0)))
    values = values.groupBy(*keys, "__v").agg(F.min("__id").alias("__id"), F.count(F.lit(1)).alias("__n")).withColumn("__b", bucket(F.col("__v")))
    near = F.struct(F.col("__v").alias("y"), F.col("__id").alias("id"))
    ends = values.groupBy(*keys, "__b").agg(F.min(near).alias("lo"), F.max(near).alias("hi"), F.sum("__n").alias("n"), F.min("__id").alias("least"))
    ends = rows.select(*keys, "__b").distinct().join(ends, [*keys, "__b"], "full_outer")
    group, place = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("__b")
    ends = ends.select(
        *keys, "__b", F.last("hi", True).over(place.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
        F.last("lo", True).over(Window.partitionBy(*keys).orderBy(F.desc("__b")).rowsBetween(Window.unboundedPreceding, -1)).alias("after"),
        F.sum("n").over(group).alias("n"), F.min("least").over(group).alias("least"),
    )
    kind, no = dict((f.name, f.dataType) for f in ends.schema), F.lit(None)

    def part(df: DataFrame, pos: int, side: int, **cols: Column) -> DataFrame:
        all_ = {"__v": no.cast("double"), "__l": no.cast(rows.schema["__l"].dataType), "r": no.cast(kind["before"]), "n": no.cast("long"), "least": no.cast(kind["least"])} | cols
        return df.select(*keys, "__b", F.lit(pos).alias("pos"), F.lit(side).alias("side"), *[c.alias(k) for k, c in all_.items()])

    met = part(rows, 1, 1, __v=F.col("__v"), __l=F.col("__l")).union(part(values, 1, 0, __v=F.col("__v"), r=near))
    met = met.union(part(ends, 0, 0, r=F.col("before"), n=F.col("n"), least=F.col("least"))).union(part(ends, 2, 0, r=F.col("after")))
    cell, so_far = Window.partitionBy(*keys, "__b"), (Window.unboundedPreceding, Window.currentRow)
    up = cell.orderBy("pos", "__v", "side").rowsBetween(*so_far)
    down = cell.orderBy(F.desc("pos"), F.desc("__v"), "side").rowsBetween(*so_far)
    met = met.select("__l", "__v", *[F.last(c, True).over(up).alias(c) for c in ("n", "least")], F.last("r", True).over(up).alias("lo"), F.last("r", True).over(down).alias("hi"))
    met = met.where("__l is not null and n is not null")
    gaps = [F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col("__v") - F.col(f"{c}.y")).alias("gap"), F.col(f"{c}.id").alias("id"))) for c in ("lo", "hi")]
    plain = F.abs(F.col("__v")) < float("inf")  # neither null nor NaN, which is the greatest
    best = F.when(plain, F.least(*gaps)).otherwise(F.struct(F.abs(F.col("__v")).alias("gap"), F.col("least").alias("id")))
    return met.select("__l.*", best.alias("best"), F.col("n").alias("passing"))


def upsert(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """``base`` with the rows of ``changes`` inserted, or replacing those of equal keys."""
    rest = [c for c in base.columns if c not in keys]
    new = changes.select(*keys, *[F.col(c).alias(f"__n_{c}") for c in rest], F.lit(True).alias("__hit"))
    joined = base.join(new, keys, "full_outer")
    return joined.select(*keys, *[F.when(F.col("__hit"), F.col(f"__n_{c}")).otherwise(F.col(c)).alias(c) for c in rest])


def sign_code(vector: Column, planes: list[list[float]]) -> Column:
    """Bits of the signs of dot products with fixed planes, first plane lowest."""
    out = F.lit(0)
    for i, plane in enumerate(planes):
        dot = F.aggregate(F.zip_with(vector, F.array(*map(F.lit, plane)), lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
        out = out + F.when(dot > 0, F.lit(1 << i)).otherwise(F.lit(0))
    return out
