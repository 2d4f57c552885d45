"""Embedding near-duplicates by Euclidean p-stable hashing.

Normalised vectors are hashed by quantised Gaussian projections, ``PROJECTIONS`` to a
bucket key, in ``TABLES`` independent tables. Vectors that share a bucket are compared by
their exact cosine in double precision, block against block, so a bucket of any size is
compared whole without listing its pairs and without gathering in one task. A pair met in
several tables counts in the first: every vector carries all its bucket keys. The number of
projections grows with the logarithm of the classes, so that unrelated vectors do not crowd the
buckets of a larger table; the number of tables follows, so that the recall stays (``plan``).

Equal vectors of a label form one class, compared once; members are counted, not expanded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, partitions, read, written

COSINE = 0.98
TABLES, PROJECTIONS, WIDTH = 12, 7, 0.9
#: Classes up to which TABLES and PROJECTIONS hold; chance that one projection puts unrelated, or just similar, vectors into one cell.
FIRST, APART, TOGETHER = 1 << 16, 0.3, 0.82
#: Classes of a bucket that one task compares with as many others.
BLOCK = 512


def plan(classes: int) -> tuple[int, int]:
    """(tables, projections) for so many classes: one projection more whenever they grow by 1 / APART."""
    more = max(0, math.ceil(math.log(max(classes, 1) / FIRST) / math.log(1 / APART)))
    return math.ceil(TABLES / TOGETHER**more), PROJECTIONS + more


def _keys(x: np.ndarray, seed: int, tables: int, projections: int) -> np.ndarray:
    """Bucket keys (rows x tables, int64) of normalised vectors."""
    rng = np.random.default_rng([seed, x.shape[1]])
    a = rng.standard_normal((x.shape[1], tables * projections))
    b = rng.uniform(0, WIDTH, tables * projections)
    cells = np.floor((x @ a + b) / WIDTH).astype(np.int64).reshape(len(x), tables, projections).view(np.uint64)
    key = np.full((len(x), tables), x.shape[1], np.uint64)
    for i in range(projections):
        key = (key ^ cells[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _unit(values: list) -> np.ndarray | None:
    """The vector in double precision at length one; None if it links with nothing."""
    if not values or any(v is None for v in values):
        return None
    x = np.asarray(values, np.float64)
    if not np.isfinite(x).all():
        return None
    top = np.abs(x).max()
    if not top:
        return None
    x = x / top
    return x / np.sqrt(x @ x)


def _hashed(seed: int, tables: int, projections: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, label, units = batch.column("cls").to_pylist(), batch.column("label").to_pylist(), [_unit(v) for v in batch.column("embedding").to_pylist()]
            sizes: dict[int, list[int]] = {}
            for i, u in enumerate(units):
                if u is not None:
                    sizes.setdefault(len(u), []).append(i)
            for rows in sizes.values():
                x = np.stack([units[i] for i in rows])
                keys = _keys(x, seed, tables, projections)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cls[i] for i in rows], pa.int64()), pa.array([label[i] for i in rows], pa.string()), pa.array([u.tobytes() for u in x], pa.binary()), pa.array(keys.tolist(), pa.list_(pa.int64()))],
                    ["cls", "label", "unit", "keys"],
                )

    return run


def _links(x: tuple, y: tuple, table: int, same: bool, cosine: float) -> Iterator[tuple[int, int, int]]:
    """(class, linked class, links) within one pair of blocks: counts, and a spanning set of links."""
    (ux, kx, cx, nx), (uy, ky, cy, ny) = x, y
    hit = ux @ uy.T >= cosine
    if same:
        np.fill_diagonal(hit, False)
    if not hit.any():
        return
    for t in range(table):
        hit &= kx[:, t, None] != ky[None, :, t]  # met in an earlier table
    links = hit @ ny
    for p in np.flatnonzero(hit.any(axis=1)).tolist():
        yield int(cx[p]), int(cy[hit[p].argmax()]), int(links[p])
    for p, q in zip(*_spanning(hit), strict=True):
        yield int(cx[p]), int(cy[q]), 0
    if not same:
        back = hit.T @ nx
        for q in np.flatnonzero(hit.any(axis=0)).tolist():
            yield int(cy[q]), int(cx[hit[:, q].argmax()]), int(back[q])


def _compare(cosine: float):
    """Pairs of blocks, sorted by ``pair``, to links."""

    def arrays(rows: list[pa.RecordBatch]) -> dict[str, np.ndarray]:
        table = pa.Table.from_batches(rows).combine_chunks()
        n = table.num_rows
        out = {c: table.column(c).to_numpy() for c in ("pair", "tbl", "block", "left_block", "right_block", "cls", "members")}
        out["keys"] = table.column("keys").combine_chunks().flatten().to_numpy().reshape(n, -1)
        out["unit"] = np.array(table.column("unit").to_pylist(), object)
        return out

    def group(c: dict[str, np.ndarray], a: int, b: int) -> Iterator[tuple[int, int, int]]:
        left, right = c["left_block"][a], c["right_block"][a]

        def side(block: int) -> tuple:
            at = a + np.flatnonzero(c["block"][a:b] == block)
            return np.stack([np.frombuffer(u) for u in c["unit"][at]]) if len(at) else None, c["keys"][at], c["cls"][at], c["members"][at]

        x = side(left)
        y = x if left == right else side(right)
        if x[0] is not None and y[0] is not None:
            yield from _links(x, y, int(c["tbl"][a]), left == right, cosine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def work(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            c = arrays(rows)
            cuts = np.flatnonzero(np.append(True, c["pair"][1:] != c["pair"][:-1])).tolist() + [len(c["pair"])]
            out = [link for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b - a > 1 for link in group(c, a, b)]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], ["a", "b", "links"])

        for batch in batches:
            if not batch.num_rows:
                continue
            pair = batch.column("pair").to_numpy()
            other = np.flatnonzero(pair != pair[-1])
            last = int(other[-1]) + 1 if len(other) else 0  # the last pair may go on in the next batch
            if held and held[-1].column("pair")[-1].as_py() != pair[0]:
                yield work(held)
                held = []
            if last:
                yield work([*held, batch.slice(0, last)])
                held = []
            held.append(batch.slice(last))
        if held:
            yield work(held)

    return run


def _spanning(hit: np.ndarray) -> tuple[list[int], list[int]]:
    """Links that connect what all links of ``hit`` (rows against columns) connect, at most one for each row and column."""
    parent = list(range(sum(hit.shape)))

    def root(v: int) -> int:
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    rows, cols = [], []
    for p in np.flatnonzero(hit.any(axis=1)).tolist():
        for q in np.flatnonzero(hit[p]).tolist():
            a, b = root(p), root(hit.shape[0] + q)
            if a != b:
                parent[a] = b
                rows.append(p)
                cols.append(q)
    return rows, cols


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, seed: int = 7, block: int = BLOCK) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each row of ``vectors`` (vec_id, embedding, label).

    Only vectors of equal, non-null label are compared. A vector that is null, empty or
    zero, or holds a null or non-finite component, links with nothing and is its own
    component. Equal vectors link with each other. Rows that repeat a vec_id count as
    separate vectors, each with its own links; vec_id must not be null. Other columns are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label"))
    rows = rows.withColumn("same", F.sha2(F.concat_ws("|", F.col("embedding").cast("string"), "label"), 256))
    fit = F.expr("label is not null and size(embedding) > 0 and forall(embedding, v -> v is not null and not isnan(v) and abs(v) < double('infinity')) and exists(embedding, v -> v <> 0)")
    ids = written(rows.withColumn("fit", F.coalesce(fit, F.lit(False))).select("vec_id", "same", "fit"), "vectors")
    # a class's members, its least vec_id and a number of its own, fixed once the table is written
    sizes = ids.where("fit").groupBy("same").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("members"))
    sizes = written(sizes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    chosen = rows.join(sizes, "same").where("vec_id = rep").dropDuplicates(["same"])
    members = chosen.select("cls", "members")
    hashed = written(chosen.select("cls", "label", "embedding").mapInArrow(_hashed(seed, *plan(sizes.count())), "cls long, label string, unit binary, keys array<long>").join(members, "cls"), "hashed")
    spots = hashed.select("cls", "members", "label", "unit", "keys", F.posexplode("keys").alias("tbl", "key"))
    crowd = spots.groupBy("tbl", "label", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("blocks", F.expr(f"cast((n + {block - 1}) div {block} as int)"))
    placed = spots.join(crowd, ["tbl", "label", "key"]).withColumn("block", F.expr("cast(pmod(xxhash64(cls), blocks) as int)"))
    # a member goes to every pair of blocks that its own belongs to
    pairs = placed.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumn("left_block", F.least("block", "other")).withColumn("right_block", F.greatest("block", "other"))
    pairs = pairs.withColumn("pair", F.xxhash64("tbl", "label", "key", "left_block", "right_block"))
    wanted = pairs.select("pair", "tbl", "block", "left_block", "right_block", "cls", "members", "keys", "unit")
    dealt = wanted.repartition(partitions(vectors.sparkSession), "pair").sortWithinPartitions("pair")
    met = written(dealt.mapInArrow(_compare(cosine), "a long, b long, links long"), "links")
    roots = components(met.select("a", "b"), "root")
    degree = met.groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("linked"))
    info = sizes.join(degree, "cls", "left").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    info = info.select("same", "rep", "members", F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("root", "cls").alias("root"))
    least = info.groupBy("root").agg(F.min("rep").alias("component"))
    info = info.join(least, "root").drop("root", "rep")
    out = ids.join(info.withColumn("fit", F.lit(True)), ["same", "fit"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce(F.col("linked") + F.col("members") - 1, F.lit(0)).alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def op10_embedding_lsh(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))
