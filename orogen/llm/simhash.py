"""SimHash near-duplicates through a segment-popcount embedding.

A fingerprint's 16 segments of 4 bits become 16 bit counts. The Manhattan distance of two
such vectors never exceeds the Hamming distance of the fingerprints, so fingerprints at
most 2 bits apart lie at Manhattan distance 2 or less and share an integer point at
distance 1 or less from both. The range join is therefore an equi-join on those points
(33 for each distinct fingerprint at most), followed by the exact bit comparison.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, global_index, partitions, slices, task, texts, written

SEED = 42
SEGMENTS, SEGMENT_BITS = 16, 4
#: A grid point with more fingerprints than this is linked through one-bit flips, a band with more texts block by block, not by pairs.
CROWDED = 64
_SLICE = 1 << 16
#: Rows of an Arrow batch that holds texts.
_TEXTS = 1024


def simhash(text: bytes, words: int = 3, seed: int = SEED) -> int:
    """The unsigned 64-bit SimHash of a text's word shingles, repeats included; 0 without words."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        tokens = [b" ".join(tokens)]
        words = 1
    total, ones = len(tokens) - words + 1, np.zeros(64, np.int64)
    digest, join = xxhash.xxh64_digest, b" ".join
    for at in range(0, total, _SLICE):
        part = tokens[at : min(at + _SLICE, total) + words - 1]
        grams = map(join, zip(*(part[i:] for i in range(words)), strict=False))
        raw = np.frombuffer(b"".join([digest(g, seed) for g in grams]), np.uint8)
        bits = np.unpackbits(raw).reshape(-1, 64)
        for k in range(0, len(bits), 255):
            ones += np.add.reduce(bits[k : k + 255], axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """Rows (doc_id, fp): the SimHash of every whole text as a signed long. A null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fp = np.array([simhash(t, words) for t in texts(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(task(run), "doc_id long, fp long")


def _mask(pattern: int) -> Column:
    return F.lit(pattern - (1 << 64) if pattern >> 63 else pattern).cast("long")


def cell(fp: Column) -> Column:
    """The 16 bit counts, four bits each, as one long."""
    m5, m3 = _mask(0x5555555555555555), _mask(0x3333333333333333)
    odd, even = fp.bitwiseAND(m5), F.shiftrightunsigned(fp, 1).bitwiseAND(m5)
    two = odd.bitwiseXOR(even).bitwiseOR(F.shiftleft(odd.bitwiseAND(even), 1))  # a sum could overflow a signed long
    return two.bitwiseAND(m3) + F.shiftrightunsigned(two, 2).bitwiseAND(m3)


def _near_points(point: Column) -> Column:
    """The grid point and those at Manhattan distance 1 that a fingerprint can have."""
    around = [point]
    for i in range(SEGMENTS):
        count = F.shiftrightunsigned(point, SEGMENT_BITS * i).bitwiseAND(F.lit(15))
        step = _mask(1 << (SEGMENT_BITS * i))
        around += [F.when(count < SEGMENT_BITS, point + step), F.when(count > 0, point - step)]
    return F.array_compact(F.array(*around))


def _grid(fps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (a, b) and (fp, mid): all pairs at most 2 bits apart are among the pairs a < b or share a ``mid``, and no others.

    ``fps``: distinct fingerprints in a column fp. Points with more than CROWDED
    fingerprints spread each over the neighbours one bit away, of which two fingerprints
    at most 2 bits apart share one, so that no point's pairs are ever listed in full.
    """
    fps = fps.repartition(partitions(fps.sparkSession), "fp")  # each row makes 33
    points = fps.withColumn("point", cell(F.col("fp"))).select("fp", F.explode(_near_points(F.col("point"))).alias("point"))
    counts = points.groupBy("point").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(points.join(counts.hint("merge"), "point"), "points")
    calm = shared.where(F.col("n") <= CROWDED).select("point", "fp")
    near = (
        calm.withColumnRenamed("fp", "a")
        .join(calm.withColumnRenamed("fp", "b").hint("merge"), "point")
        .where("a < b and bit_count(a ^ b) <= 2")
        .select("a", "b")
    )
    crowd = shared.where(F.col("n") > CROWDED).select("fp").distinct()
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(_mask(1 << i)) for i in range(64)])
    return near, crowd.select("fp", F.explode(flips).alias("mid"))


def links(fps: DataFrame) -> DataFrame:
    """Rows (a, b): verified links (at most 2 differing bits) that connect what pairs would connect.

    ``fps``: distinct fingerprints in a column fp. Those of crowded points are linked to the
    least one within one bit of a common neighbour, 65 rows for each and exact as well.
    """
    near, mids = _grid(fps)
    hubs = mids.groupBy("mid").agg(F.min("fp").alias("hub"))
    through = mids.join(hubs.hint("merge"), "mid").where("fp <> hub").select(F.col("fp").alias("a"), F.col("hub").alias("b"))
    return near.union(through)


def _fingerprint_spots(classes: DataFrame) -> DataFrame:
    """Rows (node, spot): texts share a spot if their fingerprints (column fp) are at most 2 bits apart, and only then."""
    own = classes.select("node", "fp")
    near, mids = _grid(own.select("fp").distinct())
    pairs = near.distinct().select(F.xxhash64(F.lit(1), "a", "b").alias("spot"), F.explode(F.array("a", "b")).alias("fp"))
    apart = pairs.union(mids.select(F.xxhash64(F.lit(2), "mid").alias("spot"), "fp"))
    return own.select("node", F.xxhash64(F.lit(0), "fp").alias("spot")).union(own.join(apart, "fp").select("node", "spot"))


def near_duplicates(docs: DataFrame, words: int = 3) -> DataFrame:
    """Rows (doc_id, fp, component_id): component_id is the least doc_id reachable over links.

    Null and empty texts have fingerprint zero and are linked like any other; repeated
    rows each get a row; a null doc_id keeps its row and never becomes a component_id
    unless its component has no other. Other columns of ``docs`` are ignored. The driver
    receives no rows: every join is a sort-merge join, none a broadcast.
    """
    prints = written(fingerprints(docs, words), "prints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    roots = components(links(classes.select("fp")), "root").withColumnRenamed("node", "fp")
    rooted = classes.join(roots.hint("merge"), "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    member = rooted.join(least.hint("merge"), "root").select("fp", "component_id")
    return prints.join(member.hint("merge"), "fp").select("doc_id", "fp", "component_id")


#: Bands of ``similar_documents`` and least hashes in each: a pair of similarity 0.8 shares no band once in 300,000 times ((1 - 0.8^5)^32).
BANDS, BAND_ROWS = 32, 5
_ODD = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * BAND_ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_JOIN = np.random.default_rng(SEED + 1).integers(0, 1 << 63, (BANDS, BAND_ROWS + 1), np.uint64) * np.uint64(2) + np.uint64(1)
_PART = 256


def bands(own: set[bytes]) -> np.ndarray:
    """A text's bands: hashes of BAND_ROWS least values each, of its shingles' hashes under independent multipliers."""
    h = np.frombuffer(b"".join(own), np.uint64)
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(h), _PART):
        np.minimum(least, (h[at : at + _PART, None] * _ODD).min(axis=0), out=least)
    least ^= least >> np.uint64(29)
    return ((least.reshape(BANDS, BAND_ROWS) * _JOIN[:, 1:]).sum(axis=1, dtype=np.uint64) + _JOIN[:, 0]).view(np.int64)


def _band_prints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data = texts(batch)
            made = [(bands(own).tolist(), len(own)) for own in (shingles(t, words) for t in data)]
            rows = [pa.array([r[i] for r in made], pa.int64() if i else pa.list_(pa.int64())) for i in range(2)]
            rows.append(pa.array(np.array([simhash(t) for t in data], np.uint64).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("same"), *rows], ["doc_id", "same", "bands", "n", "fp"])

    return run


def shingles(text: bytes, words: int) -> set[bytes]:
    """The distinct word shingles of a text, as hashes; the whole text if it has fewer words."""
    tokens = text.lower().split()
    digest, join = xxhash.xxh3_64_digest, b" ".join
    return {digest(g) for g in map(join, zip(*(tokens[i:] for i in range(words)), strict=False))} or {digest(join(tokens))}


def _verified(words: int, least: float):
    """Pairs of texts whose shingle sets have a Jaccard similarity of ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int | None, set] = (None, set())
        for batch in slices(batches):
            out = []
            for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True):
                if last[0] != b:
                    last = (b, shingles((y or "").encode(), words))
                own = shingles((x or "").encode(), words)
                common = len(own & last[1])
                if common >= least * (len(own) + len(last[1]) - common):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(2)], ["a", "b"])

    return run


def _place(doc_id: Column) -> list[Column]:
    """A doc_id as two columns that joins and groups take as they are, null or not."""
    return [F.coalesce(doc_id, F.lit(0)).alias("at"), doc_id.isNull().alias("none")]


def _wanted(rows: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows (node, text) of ``nodes`` (node, distinct). Texts are shuffled once: copies meet where the join deals them."""
    ends = classes.join(nodes, "node").select("node", "same", *_place(F.col("rep")))
    key = ["same", "at", "none"]
    found = rows.select("same", *_place(F.col("doc_id")), "text").join(ends, key)
    return found.dropDuplicates(key).select("node", "text")


def _common(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many values each of the sets ``x`` shares with each of ``y``, by a product of their incidence matrices."""
    sides = [(np.concatenate(side), np.repeat(np.arange(len(side)), [len(v) for v in side])) for side in (x, y)]
    both = np.intersect1d(*(np.unique(values) for values, _ in sides), assume_unique=True)
    out = np.zeros((len(x), len(y)), np.float32)
    coded = []
    for values, owner in sides:
        at = np.searchsorted(both, values)
        known = at < len(both)
        known[known] = both[at[known]] == values[known]
        order = np.argsort(at[known], kind="stable")
        coded.append((at[known][order], owner[known][order]))
    for lo in range(0, len(both), _COLUMNS):
        factors = []
        for (at, owner), n in zip(coded, out.shape, strict=True):
            a, b = np.searchsorted(at, (lo, lo + _COLUMNS))
            m = np.zeros((n, min(_COLUMNS, len(both) - lo)), np.float32)
            m[owner[a:b], at[a:b] - lo] = 1
            factors.append(m)
        out += factors[0] @ factors[1].T
    return out


_COLUMNS = 4096


def _spanning(pairs: list[tuple[int, int]]) -> list[int]:
    """Places of those of ``pairs`` that connect what all connect, without a circle."""
    parent: dict[int, int] = {}

    def root(v: int) -> int:
        while parent.setdefault(v, v) != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    kept = []
    for i, (a, b) in enumerate(pairs):
        a, b = root(a), root(b)
        if a != b:
            parent[a] = b
            kept.append(i)
    return kept


def _compared(least: float):
    """Pairs of blocks of texts, sorted by ``pair``, to links of ``least`` similarity that connect different roots."""

    def group(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        low = min(r[1] for r in rows)
        sides = [[r for r in rows if (r[1] == low) == first] for first in (True, False)]
        if not sides[1]:
            if rows[0][2]:  # the other block of the pair is empty
                return
            sides[1] = sides[0]
        (node_a, root_a, sets_a), (node_b, root_b, sets_b) = (
            (np.array([r[3] for r in side]), np.array([r[4] for r in side]), [np.frombuffer(r[5], np.uint64) for r in side]) for side in sides
        )
        size_a, size_b = (np.array([len(v) for v in sets], np.float64) for sets in (sets_a, sets_b))
        common = _common(sets_a, sets_b)
        hit = (common >= least * (size_a[:, None] + size_b - common)) & (root_a[:, None] != root_b)
        i, j = np.nonzero(hit)
        if len(i):
            roots, at = np.unique(np.stack([root_a[i], root_b[j]], axis=1), axis=0, return_index=True)
            for k in _spanning(list(map(tuple, roots.tolist()))):
                yield int(node_a[i[at[k]]]), int(node_b[j[at[k]]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby

        rows = (r for batch in slices(batches) for r in zip(*(batch.column(c).to_pylist() for c in ("pair", "block", "mixed", "node", "root", "shingles")), strict=True))
        for _, own in groupby(rows, key=lambda r: r[0]):
            out = list(group(list(own)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(2)], ["a", "b"])

    return run


#: Texts and shingles of a block of ``_crowded_links``.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 18


def _crowded_links(rows: DataFrame, classes: DataFrame, placed: DataFrame, words: int, least: float, block: int) -> DataFrame:
    """Links of ``least`` similarity that connect what all pairs of different roots in a band connect, without listing pairs.

    ``placed``: spot, node, root. A band's texts are dealt to blocks of bounded size; two
    blocks at a time, a product of incidence matrices counts the shingles that texts share.
    """
    sizes = classes.select("node", "n")
    placed = placed.join(sizes, "node")
    blocks = placed.groupBy("spot").agg(F.expr(f"cast(greatest(ceil(count(1) / {block}), ceil(sum(n) / {BLOCK_SHINGLES})) as int)").alias("blocks"))
    own = placed.join(blocks, "spot").withColumn("block", F.expr("cast(pmod(xxhash64(node), blocks) as int)"))
    own = own.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    own = own.select("node", "root", "block", F.xxhash64("spot", F.least("block", "other"), F.greatest("block", "other")).alias("pair"), (F.col("block") != F.col("other")).alias("mixed"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [b"".join(shingles(t, words)) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(made, pa.binary())], ["node", "shingles"])

    found = _wanted(rows, classes, placed.select("node").distinct()).mapInArrow(task(sets), "node long, shingles binary")
    dealt = own.join(written(found, "shingles", _TEXTS), "node").repartition(partitions(rows.sparkSession), "pair").sortWithinPartitions("pair")
    return written(dealt.select("pair", "block", "mixed", "node", "root", "shingles").mapInArrow(task(_compared(least)), "a long, b long"), "similar", _TEXTS)


def _similar_pairs(rows: DataFrame, classes: DataFrame, pairs: DataFrame, words: int, least: float) -> DataFrame:
    """Those of ``pairs`` (a, b: nodes of classes) whose texts have a similarity of ``least`` or more."""
    kinds = classes.select("node", "n")
    for p in "ab":
        pairs = pairs.join(kinds.withColumnsRenamed({"node": p, "n": f"n{p}"}), p)
    fits = F.least("na", "nb") >= least * F.greatest("na", "nb")
    pairs = written(pairs.where(fits).select("a", "b"), "pairs")
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = written(_wanted(rows, classes, ends), "texts")
    first, second = (wanted.select(F.col("node").alias(p), F.col("text").alias(f"text_{p}")) for p in "ab")
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
    return written(both.mapInArrow(task(_verified(words, least)), "a long, b long"), "similar", _TEXTS)


def text_key(docs: DataFrame) -> Column:
    """128 bits that stand for a row's text (null: empty)."""
    return F.unhex(F.md5(F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary")))


def similar_documents(docs: DataFrame, words: int = 5, least: float = 0.8) -> DataFrame:
    """Rows (doc_id, same, component_id, first): groups of documents linked by a shingle similarity of ``least`` or more.

    Candidates are texts whose SimHash fingerprints are at most 2 bits apart, found by the
    grid range join as in ``links``. At a Jaccard similarity of 0.8 fingerprints lie
    farther apart (ten bits of 64 on average for word shingles), so texts that share a
    band of least hashes of their word shingles are candidates as well, the chance of which
    depends on the similarity alone, however it came about; the exact Jaccard similarity decides.
    Equal texts form one class (``same``). Every pair of candidates is
    decided or already connected: first all members of a band meet its least document, then
    those of a band or of near fingerprints that are not yet connected meet each other, as
    pairs in groups of up to CROWDED texts and block against block, without a list of pairs, in larger ones. Before texts
    meet, pairs whose shingle counts rule the similarity out are left.

    ``docs``: doc_id and text (null: empty). A document is a pair of id and text, so rows of
    one id with other texts, and rows without id, are documents of their own; ``first`` marks
    the group's document of least id (null ids last), on each of its rows if it is repeated.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(docs).alias("same"), F.col("text").cast("string").alias("text"))
    prints = written(rows.mapInArrow(task(_band_prints(words)), "doc_id long, same binary, bands array<long>, n long, fp long"), "prints", _TEXTS)
    kinds = prints.groupBy("same").agg(F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in ("bands", "n", "fp")])
    kinds = written(kinds, "kinds")
    nodes = global_index(kinds.select("same", "rep"), [F.col("rep").asc_nulls_last(), F.col("same")], "node")  # unique, in the order of rep
    classes = written(kinds.join(nodes.select("same", "node"), "same"), "classes")
    points = classes.select("node", F.explode("bands").alias("spot"))
    counts = points.groupBy("spot").agg(F.count(F.lit(1)).alias("met")).where("met > 1")
    shared = written(points.join(counts, "spot"), "points")
    hubs = shared.groupBy("spot").agg(F.min("node").alias("b"))
    stars = shared.join(hubs, "spot").where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    stars = written(stars, "stars")
    links = _similar_pairs(rows, classes, stars, words, least)
    roots = written(components(links, "root"), "roots")
    prone = _fingerprint_spots(classes)
    many = prone.groupBy("spot").agg(F.count(F.lit(1)).alias("met")).where("met > 1")
    shared = shared.select("node", "spot", "met").union(written(prone.join(many, "spot").select("node", "spot", "met"), "points"))
    placed = written(shared.join(roots, "node", "left").select("spot", "node", "met", F.coalesce("root", "node").alias("root")), "points")
    open_spots = placed.groupBy("spot").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("spot")
    placed = written(placed.join(open_spots, "spot"), "points")
    links = links.union(_crowded_links(rows, classes, placed.where(F.col("met") > CROWDED).drop("met"), words, least, BLOCK))
    placed = placed.where(F.col("met") <= CROWDED).drop("met")
    cells = placed.select("spot", "root").distinct()
    cells = cells.withColumnRenamed("root", "ra").join(cells.withColumnRenamed("root", "rb"), "spot").where("ra < rb")
    for p in "ab":
        cells = cells.join(placed.withColumnsRenamed({"node": p, "root": f"r{p}"}), ["spot", f"r{p}"])
    rest = cells.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().join(stars, ["a", "b"], "left_anti")
    links = links.union(_similar_pairs(rows, classes, rest, words, least))
    roots = components(links, "root")
    member = classes.select("same", "node", "rep").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    member = member.join(classes.select(F.col("node").alias("root"), F.col("rep").alias("component_id")), "root")
    first = (F.col("root") == F.col("node")) & F.col("doc_id").eqNullSafe(F.col("rep"))
    return prints.select("doc_id", "same").join(member, "same").select("doc_id", "same", "component_id", first.alias("first"))


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    from .common import read

    out = near_duplicates(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
