"""Winnowing fingerprints: rolling k-gram hashes, the minimum of each window, rightmost on ties.

Two texts that share ``gram + window - 1`` characters share a selected gram; no shared run
shorter than ``gram`` is ever selected. Positions are kept, so matches can be located.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, read

GRAM, WINDOW = 12, 16
_SLICE = 1 << 19
_ODD = 0x9E3779B97F4A7C15
#: Text bytes that one block of neighbouring documents should hold.
BLOCK_BYTES = 16 << 20

_table: tuple[np.ndarray, np.ndarray] | None = None


def _powers() -> tuple[np.ndarray, np.ndarray]:
    global _table
    if _table is None:
        made = []
        for base in (_ODD, pow(_ODD, -1, 1 << 64)):
            p = np.full(_SLICE + GRAM + WINDOW + 1, base, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _table = made[0], made[1]
    return _table


def winnow(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the selected grams, positions in code points, increasing.

    A text shorter than a gram is one gram; an empty text has none; a text with fewer grams
    than a window selects the least gram.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if n < GRAM:
        return np.zeros(1, np.int64), np.array([xxhash.xxh3_64_intdigest(codes.tobytes())], np.uint64)
    up, down = _powers()
    places, hashes = [], []
    grams = n - GRAM + 1
    for at in range(0, max(1, grams - WINDOW + 1), _SLICE):
        part = codes[at : at + _SLICE + WINDOW + GRAM - 2]
        prefix = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=prefix[1:])
        h = (prefix[GRAM:] - prefix[:-GRAM]) * down[: len(part) - GRAM + 1]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
        low = np.uint64((1 << 20) - 1)
        key = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))  # ties in the high bits go to the rightmost
        span = 1
        while 2 * span <= min(WINDOW, len(h)):
            key = np.minimum(key[:-span], key[span:]) if span < len(key) else key
            span *= 2
        rest = min(WINDOW, len(h)) - span
        if rest:
            key = np.minimum(key[:-rest], key[rest:])
        found = (low - (key & low)).astype(np.int64)
        found = found[np.append(True, found[1:] != found[:-1])]
        places.append(found + at)
        hashes.append(h[found])
    place, hash_ = np.concatenate(places), np.concatenate(hashes)
    first = np.append(True, place[1:] != place[:-1])
    return place[first], hash_[first]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of selected hashes; 1 if both are empty."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def digest(place: np.ndarray, hashes: np.ndarray) -> str:
    return xxhash.xxh3_128_hexdigest(place.astype("<i8").tobytes() + hashes.astype("<u8").tobytes())


def fingerprints(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, positions, hashes): the selected grams of every whole text; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                both = [winnow(t or "") for t in part.column("text").to_pylist()]
                arrays = [part.column("doc_id"), pa.array([p.tolist() for p, _ in both], pa.list_(pa.int64())), pa.array([h.view(np.int64).tolist() for _, h in both], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "positions", "hashes"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, positions array<long>, hashes array<long>")


def edited(text: str, following: str) -> str:
    """The last half (rounded down) of ``text`` replaced by as many first characters of the next document, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _cuts_above(key: F.Column, cuts: list[int]) -> F.Column:
    """How many of the sorted ``cuts`` lie above a key: a scan of the groups' ends, then one of a group, twice the root of their number."""
    if not cuts:
        return F.lit(0)
    size = math.isqrt(len(cuts) - 1) + 1
    groups = [cuts[i : i + size] for i in range(0, len(cuts), size)]
    whole = F.size(F.filter(F.array(*[F.lit(own[-1]) for own in groups]), lambda c: c <= key))
    own = F.get(F.array(*[F.array(*map(F.lit, own)) for own in groups]), whole)
    below = whole * size + F.size(F.filter(own, lambda c: c <= key))
    return F.when(whole == len(groups), 0).otherwise(len(cuts) - below)


def with_next(docs: DataFrame, run, schema: str) -> DataFrame:
    """Apply ``run(rows)`` to the documents in descending doc_id order, ``rows``: (doc_id, text, next text).

    Documents are dealt to blocks of neighbouring ids; the first document of each block
    also goes to the block before it, and the very first one to the last block. Ids that
    repeat follow each other by text hash; null ids come last. The texts are shuffled once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("__key", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("__tie", F.xxhash64("text"))
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, partitions(spark), -(-size // BLOCK_BYTES))
    cuts = rows.agg(F.percentile_approx("__key", [i / blocks for i in range(1, blocks)] or [0.5], max(10_000, 20 * blocks))).first()[0] or []
    cuts = sorted(set(cuts)) if blocks > 1 else []
    rows = rows.withColumn("__block", _cuts_above(F.col("__key"), cuts))  # blocks from the highest ids down
    heads = rows.groupBy("__block").agg(F.max(F.struct("__key", -F.shiftright("__tie", 1), "__tie")).alias("h")).orderBy("__block").collect()  # a row for each block
    before = [(r["__block"], heads[i - 1]["__block"], r["h"]["__key"], r["h"]["__tie"]) for i, r in enumerate(heads)]
    to = spark.createDataFrame(before, "__block int, __to int, __key long, __tie long")
    ghosts = rows.join(F.broadcast(to), ["__block", "__key", "__tie"]).dropDuplicates(["__block"])
    every = rows.withColumn("__ghost", F.lit(0)).select("doc_id", "text", "__key", "__tie", "__block", "__ghost").union(
        ghosts.select("doc_id", "text", "__key", "__tie", F.col("__to").alias("__block"), F.lit(1))
    )
    dealt = every.repartitionById(blocks, F.col("__block")).sortWithinPartitions(F.col("__block"), "__ghost", F.col("__key").desc(), F.shiftright("__tie", 1), "__tie")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            doc, text, block, ghost = (batch.column(c).to_pylist() for c in ("doc_id", "text", "__block", "__ghost"))
            out = []
            for d, t, b, g in zip(doc, text, block, ghost, strict=True):
                if held is not None and held[2] == b:
                    out.append((held[0], held[1], t))
                held = None if g else (d, t, b)
            for k in range(0, len(out), 256):
                yield run(out[k : k + 256])

    return dealt.select("doc_id", "text", "__block", "__ghost").mapInArrow(stream, schema)


def edit_report(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, its edited text's, and their likeness (the query's digest columns)."""

    def run(rows: list[tuple]) -> pa.RecordBatch:
        out = []
        for doc, text, following in rows:
            changed = edited(text, following)
            own, other, neighbour = winnow(text), winnow(changed), winnow(following)
            sha = hashlib.sha256(changed.encode()).hexdigest()
            out.append((doc, len(text), sha, digest(*own), digest(*other), likeness(own[1], other[1]), likeness(own[1], neighbour[1])))
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return with_next(docs, run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op3_winnowing(spark, sf_dir: str) -> DataFrame:
    return edit_report(read(spark, sf_dir, "documents"))
