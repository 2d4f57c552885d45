"""Mixing sources to target weights by Pfair scheduling.

Time is counted in blocks. With weight w, a source's block j (from 0) is released at
floor(j / w) and due at ceil((j + 1) / w); serving the released block with the earliest
deadline keeps every source less than one block away from its share at every moment.
Weights are taken as exact fractions and blocks counted over the whole phase, so the bound
holds against the given weights however long the input. The driver places all blocks: three
numbers for each block of rows, no rows. When a source runs out, the others go on with
their weights scaled up (the next phase), so every document is placed exactly once.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import global_index, read

BLOCK = 64
#: Blocks in a row of the placement table.
PERIOD = 1000
#: Placement tables beyond this many entries are joined by a shuffle, not broadcast.
BROADCAST_SLOTS = 1 << 20


def shares(weights: dict[str, float], least: int = 1) -> dict[str, int]:
    """Whole numbers in the exact proportions of the weights, each ``least`` or more."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*(x.denominator for x in exact.values()))
    whole = {s: int(x * scale) for s, x in exact.items()}
    more = -(-least // min(whole.values()))
    return {s: n * more for s, n in whole.items()}


def phase_schedule(share: dict[str, int], left: dict[str, int]) -> dict[str, list[int]]:
    """The slots of each source's blocks until one has none left: earliest deadline first among released blocks."""
    whole = sum(share.values())
    slots: dict[str, list[int]] = {s: [] for s in share}
    waiting = [(0, s) for s in sorted(share)]  # (release, source) of each source's next block
    heapq.heapify(waiting)
    ready: list[tuple[int, str]] = []
    t = 0
    while True:
        while waiting and waiting[0][0] <= t:
            _, s = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(len(slots[s]) + 1) * whole // share[s]), s))
        _, s = heapq.heappop(ready)
        slots[s].append(t)
        if len(slots[s]) == left[s]:
            return slots
        heapq.heappush(waiting, (len(slots[s]) * whole // share[s], s))
        t += 1


def phases(blocks: dict[str, int], weights: dict[str, float], period: int = PERIOD) -> list[tuple]:
    """Rows (source, phase, first block, end block, start time, share, sum of shares, slots).

    The shares are in the proportions of the weights and beyond ``period`` and any source's blocks.
    """
    left, done, rows, start, phase = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0), [], 0, 0
    while left:
        share = shares({s: weights[s] for s in left}, max(period, *left.values()))
        whole, slots = sum(share.values()), phase_schedule(share, left)
        for s in list(left):
            n = len(slots[s])
            rows.append((s, phase, done[s], done[s] + n, start, share[s], whole, slots[s]))
            done[s] += n
            left[s] -= n
            if not left[s]:
                del left[s]
        start, phase = start + sum(map(len, slots.values())), phase + 1
    return rows


def placements(plan: list[tuple], period: int = PERIOD) -> list[tuple]:
    """Rows (source, chunk, phase, first block, end block, slots, releases, deadlines): those of ``phases``, cut at each ``period`` blocks of a source."""
    rows = []
    for s, phase, b0, b1, start, share, whole, slots in plan:
        for chunk in range(b0 // period, -(-b1 // period) if b1 > b0 else 0):
            lo, hi = max(b0, chunk * period), min(b1, (chunk + 1) * period)
            at = range(lo - b0, hi - b0)
            rows.append((
                s, chunk, phase, lo, hi, [start + slots[j] for j in at],
                [start + j * whole // share for j in at], [start - (-(j + 1) * whole // share) for j in at],
            ))
    return rows


def schedule(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK, period: int = PERIOD) -> DataFrame:
    """Rows (doc_id, source, key, phase, block, slot, rank, release, deadline), one for each row of ``docs``.

    ``slot`` is the time at which the row's block of its source is served, ``rank`` the
    row's place in the block; ``key`` is the row's hash. Within a source, rows are dealt
    to blocks in an order of hashes. ``weights`` (default: the square root of a source's
    rows) must name every source; a null source is the source ''. Only one count for each
    source reaches the driver; the number of sources is taken to be in the thousands at most.
    ``period``: blocks in a row of the placement table, without effect on the schedule.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.xxhash64("doc_id", "text", "source").alias("key"),
    )
    ranked = global_index(rows, ["source", "key", "doc_id"], "at")
    count = {r["source"]: (r["first"], r["n"]) for r in ranked.groupBy("source").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).collect()}
    weights = weights or {s: n**0.5 for s, (_, n) in count.items()}
    missing = sorted(set(count) - set(weights))
    if missing or any(weights[s] <= 0 for s in count):
        raise ValueError(f"no positive weight for sources {missing or 'given'}")
    plan = placements(phases({s: -(-n // block) for s, (_, n) in count.items()}, weights, period), period)
    table = spark.createDataFrame(
        plan,
        "of string, chunk long, phase int, b0 long, b1 long, slots array<long>, releases array<long>, deadlines array<long>",
    )
    if sum(len(r[-1]) for r in plan) <= BROADCAST_SLOTS:
        table = F.broadcast(table)
    starts = F.broadcast(spark.createDataFrame([(s, first) for s, (first, _) in count.items()], "name string, base long"))
    ranked = ranked.join(starts, F.col("source") == F.col("name")).withColumn("block", F.expr(f"(at - base) div {block}"))
    placed = ranked.join(table, (F.col("source") == F.col("of")) & F.expr(f"block div {period} = chunk and block >= b0 and block < b1"))
    j = "cast(block - b0 as int)"
    return placed.select(
        "doc_id", "source", "key", "phase", "block", F.expr(f"slots[{j}]").alias("slot"), F.expr(f"(at - base) % {block}").alias("rank"),
        F.expr(f"releases[{j}]").alias("release"), F.expr(f"deadlines[{j}]").alias("deadline"),
    )


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK, period: int = PERIOD) -> DataFrame:
    """All rows of ``docs``, their columns unchanged, in the order of ``schedule``.

    Rows are dealt by range of (slot, rank), so that the files hold the mixture in order.
    Rows equal in doc_id, text and source share their places in any order.
    """
    twin = "row_number() over (partition by __doc, __key order by {})"
    place = schedule(docs, weights, block, period).select(F.col("doc_id").alias("__doc"), F.col("key").alias("__key"), F.col("slot").alias("__slot"), F.col("rank").alias("__rank"))
    place = place.withColumn("__n", F.expr(twin.format("__slot, __rank"))).withColumnRenamed("__doc", "__doc2").withColumnRenamed("__key", "__key2")
    rows = docs.withColumn("__doc", F.col("doc_id").cast("long")).withColumn("__key", F.xxhash64("doc_id", "text", "source"))
    rows = rows.withColumn("__m", F.expr(twin.format("__key")))
    joined = rows.join(place, F.expr("__doc <=> __doc2 and __key = __key2 and __n = __m"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return joined.repartitionByRange(parts, "__slot", "__rank").sortWithinPartitions("__slot", "__rank").select(*[f"`{c}`" for c in docs.columns])


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    return schedule(read(spark, sf_dir, "documents")).drop("key")
