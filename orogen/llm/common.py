"""Shared pieces of the operators: written tables, global row numbers, components.

Lineage is cut with Parquet tables in the shared folder that the cluster names in
``spark.checkpoint.dir``; nothing here keeps state on one executor.
"""

from __future__ import annotations

import ctypes
import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a folder of our own only where none is set (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        path = tempfile.mkdtemp(prefix="orogen-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


class Table:
    """A written intermediate table; ``drop`` removes it once nothing reads it any more."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """``df`` from a written table; Python functions in its plan get at most ``batch`` rows at a time (texts: memory in both processes)."""
    if batch is None:
        return Table(df, name).df
    conf = df.sparkSession.conf
    usual = conf.get(_BATCH)
    conf.set(_BATCH, str(batch))
    try:
        return Table(df, name).df
    finally:
        conf.set(_BATCH, usual)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def global_index(df: DataFrame, order: list[str | Column], name: str = "idx") -> DataFrame:
    """Add ``name``: the row's rank from 0 in ``order``, without a single-task sort.

    Rows are dealt by range, sorted, and written with their partition and place; the
    partitions' sizes (one row each) give the offsets. Keep ``df`` narrow. Ties in
    ``order`` are ranked in the order of the written table, so the rank is unique.
    """
    spark = df.sparkSession
    parts = partitions(spark)
    placed = (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("__at", F.monotonically_increasing_id())
        .withColumn("__part", F.shiftright("__at", 33).cast("int"))
        .withColumn("__at", F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
    )
    placed = written(placed, "ranked")
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    ends = {r["__part"]: r["n"] for r in sizes.collect()}  # one number for each partition
    start, before = {}, 0
    for part in sorted(ends):
        start[part], before = before, before + ends[part]
    offsets = spark.createDataFrame(list(start.items()) or [(0, 0)], "__part int, __start long")
    return (
        placed.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__start") + F.col("__at"))
        .drop("__part", "__at", "__start")
    )


def components(edges: DataFrame, name: str = "component") -> DataFrame:
    """Connected components of ``edges`` (a, b: long): rows (node, component), component the least node.

    Alternates large-star and small-star steps until nothing changes; between them each task
    replaces its edges by stars (``_contracted``), which saves most rounds. Hubs are first
    reduced to one minimum by partial aggregation; the joins back are plain sort-merge
    joins, whose skewed partitions Spark splits and of which the driver receives nothing.
    Nodes without an edge have no row.
    """
    pair = edges.where("a is not null and b is not null and a <> b")
    table = Table(_contracted(pair.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()), "edges")
    seen = _mark(table.df)
    while seen[0]:
        e = table.df
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low.hint("merge"), "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        step = Table(_contracted(small.union(low.select("hi", F.col("m").alias("lo"))).distinct()), "edges")
        mark = _mark(step.df)
        table.drop()
        table = step
        if mark == seen:
            break
        seen = mark
    return table.df.select(F.col("hi").alias("node"), F.col("lo").alias(name)).union(
        table.df.select(F.col("lo"), F.col("lo")).distinct()
    )


#: Edges that a task contracts at a time.
_EDGES = 1 << 18


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges (hi, lo) that connect what ``edges`` connect: each part of a task's edges as stars around least nodes."""

    def stars(part: list[pa.RecordBatch]) -> pa.RecordBatch:
        parent: dict[int, int] = {}

        def root(v: int) -> int:
            while parent.setdefault(v, v) != v:
                parent[v] = parent[parent[v]]
                v = parent[v]
            return v

        for batch in part:
            for hi, lo in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a, b = root(hi), root(lo)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        rows = [(v, r) for v, r in ((v, root(v)) for v in list(parent)) if v != r]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(2)], ["hi", "lo"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = [], 0
        for batch in batches:
            part.append(batch)
            held += batch.num_rows
            if held >= _EDGES:
                yield stars(part)
                part, held = [], 0
        if part:
            yield stars(part)

    return edges.mapInArrow(task(run), "hi long, lo long")


def _mark(e: DataFrame) -> tuple[int, int]:
    r = e.agg(F.count(F.lit(1)), F.expr("coalesce(bit_xor(xxhash64(hi, lo)), 0)")).first()
    return r[0], r[1]


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of each text of a batch; a null text is empty."""
    return [t or b"" for t in batch.column(column).cast(pa.large_binary()).to_pylist()]


def pack(value: object, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(pickle.dumps(value, protocol=5))


def unpack(blob: bytes) -> object:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def release() -> None:
    """Give memory that a finished task no longer uses back to the system; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not the C library that has it
        pass


_kept: dict[str, dict] = {}


def kept(kind: str) -> dict:
    """What a worker keeps from one task of a kind to the next; what it kept for other kinds goes."""
    for other in _kept.keys() - {kind}:
        del _kept[other]
    return _kept.setdefault(kind, {})


def task(run: Callable, kind: str = "") -> Callable:
    """An Arrow function that gives its memory back when its task ends, but for what is ``kept`` for its kind."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept(kind)
        yield from run(batches)
        release()

    return whole


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
