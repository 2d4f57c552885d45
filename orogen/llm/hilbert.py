"""Shards along a Hilbert curve through metadata.

Every dimension is quantised by its own quantiles, the cells are ordered by the Hilbert
curve, and the order is cut into runs of equal row counts. Rows near each other in all
dimensions lie in the same run, so the files' minima and maxima prune by any of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import global_index, read

BITS = 6


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of ``cells`` (unsigned, below 2**bits), by Skilling's transposition."""
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    q = np.uint64(1 << (bits - 1))
    one = np.uint64(1)
    while q > one:
        p = q - one
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= one
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = np.uint64(1 << (bits - 1))
    while q > one:
        t ^= np.where((x[-1] & q) != 0, q - one, np.uint64(0))
        q >>= one
    x ^= t
    out = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << one) | ((x[i] >> np.uint64(b)) & one)
    return out.view(np.int64)


def _number(df: DataFrame, name: str) -> Column:
    """A column as an order-preserving number: strings by the six bytes after their common beginning; nulls stay null."""
    kind = df.schema[name].dataType
    col = F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        low, high = df.agg(F.min(col), F.max(col)).first()
        low, high, same = (low or "").encode(), (high or "").encode(), 0
        while same < min(len(low), len(high)) and low[same] == high[same]:
            same += 1
        raw = F.substring(F.to_binary(F.hex(col.cast("binary")), F.lit("hex")), same + 1, 6)
        return F.conv(F.rpad(F.hex(raw), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    return col.cast("double")


def curve(df: DataFrame, dims: list[str], bits: int = BITS, name: str = "hilbert") -> DataFrame:
    """``df`` with the Hilbert index of ``dims`` (at most 63 bits in all); null and NaN values share the lowest cell."""
    if not dims or bits * len(dims) > 63:
        raise ValueError("dims * bits must be 1 to 63")
    cols = [_number(df, d) for d in dims]
    values = df.withColumn("__values", F.array(*[F.when(~F.isnan(c), c) for c in cols]))
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = values.agg(*[F.percentile_approx(F.col("__values")[i], steps, 10_000).alias(f"q{i}") for i in range(len(dims))]).first()
    cuts = [np.array(q or []) for q in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("__values")
        for batch in batches:
            flat = batch.column(at).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, len(dims))
            cells = np.stack([np.where(np.isnan(flat[:, i]), 0, np.searchsorted(cuts[i], np.nan_to_num(flat[:, i]), side="left")) for i in range(len(dims))], axis=1)
            index = hilbert_index(cells, bits)
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(batch.columns) if i != at), pa.array(index)], [*names[:at], *names[at + 1 :], name])

    values = values.drop(name) if name in df.columns else values
    names = values.columns
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in values.schema if f.name != "__values"]
    return values.mapInArrow(run, ", ".join([*fields, f"`{name}` long"]))


def shards(df: DataFrame, dims: list[str], count: int, tie: list[str], bits: int = BITS) -> DataFrame:
    """``df`` (narrow rows) with hilbert, shard and slot: runs of the curve whose row counts differ by one at most.

    ``tie`` orders the rows of a cell. Slots are gapless from 0 in every shard; an empty
    table gives no rows, and with fewer rows than shards some shards are empty. Repeated rows
    each take a slot.
    """
    placed = global_index(curve(df, dims, bits), ["hilbert", *tie], "__row")
    n = placed.count()
    # shard s holds rows from ceil(s * n / count) to ceil((s + 1) * n / count), the latter excluded
    shard = F.expr(f"cast((__row * {count}) div {max(n, 1)} as int)")
    out = placed.withColumn("shard", shard)
    return out.withColumn("slot", F.expr(f"__row - (cast(shard as long) * {n} + {count - 1}) div {count}")).drop("__row")


def digest(docs: DataFrame) -> DataFrame:
    """Narrow rows of documents: size (UTF-8 bytes and one; null: 1), text_crc32 (null: that of no bytes) and the metadata."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select("doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), "lang", "source", "n_chars")


def op1_hilbert(spark, sf_dir: str) -> DataFrame:
    out = shards(digest(read(spark, sf_dir, "documents")), ["lang", "source", "n_chars", "doc_id"], 8, ["doc_id", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert")
