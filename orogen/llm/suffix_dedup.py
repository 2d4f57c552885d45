"""Exact removal of repeated substrings by a distributed merge sort of suffix runs.

A byte goes when some 50-byte string that covers it also starts in a document with a
smaller id. Sorting every suffix would move many times the corpus, so sampled suffixes
stand for the rest without loss:

1. Every 50-byte window belongs to its least 16-byte gram by hash (rightmost on ties), a
   choice that depends on the window's bytes alone. Consecutive windows of one gram form a
   *stretch* of at most 84 bytes, one for about 17 bytes of text. Equal windows are
   compared exactly when their stretches share the gram. Equal stretches that follow each
   other at 50 bytes or less (periodic text) count as one with a *reach*, the distance of the
   last from the first: whatever goes from each of them goes without a gap.
2. Tasks exchange the gram hashes of their stretches and short hashes of the 17 bytes before
   and the 18 bytes after the gram. A window has one or the other, as its gram's place in it
   tells, so this decides only which stretches stay out of the sort: those whose gram no other
   document has with either. Stretches equal, byte for byte, to one of an earlier document in
   the same part of a task go at once.
3. The suffixes at the grams of all others are sorted into runs, front-coded, exchanged, and
   merged by loser trees that never compare a known prefix again (``lcp.merge``). Entries
   that share the gram meet; the merge's common prefixes, continued by bytes to the left of
   the gram, tell which of their windows are equal. No byte goes on the word of a hash.
   Stretches of very common grams are sent window by window, so that no gram gathers in one
   task.
4. Texts, compressed, meet their removed intervals.

Whatever meets in a task is one partition's share of a hash. A stretch met in many documents
is reduced to its least document in each run before it is exchanged.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Table, pack, partitions, read, slices, task, texts, unpack
from .lcp import front_code, front_decode, merge, shared_prefix

SPAN, GRAM = 50, 16
#: A window has this many bytes before its gram, or else at least one more after it.
_BESIDE = (SPAN - GRAM) // 2
#: Stretches of one gram, after each run's own reduction, beyond which they are exchanged window by window.
CROWDED = 4096
_BUFFER = 1 << 19
#: Entries of a run.
_RUN = 250_000
#: Different stretches of one gram that are compared pair by pair, not by a table of windows.
_FEW = 8
#: Ranges of the gram hashes that a task sorts one after another.
_RANGES = 4
_FLUSH = 8 << 20
_SCHEMA = "part int, kind int, blob binary"
_ODD = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_table: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _table
    if len(_table[0]) < n:
        n = max(n, _BUFFER + 4096)
        _table = _powers(_ODD, n), _powers(pow(_ODD, -1, 1 << 64), n)
    return _table


def _equal(buf: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` (SPAN or more) bytes of ``buf`` at ``a`` and at ``b`` are the same."""
    words = np.lib.stride_tricks.as_strided(buf.view(np.uint8), (max(0, len(buf) - 7), 8), (1, 1))
    same = np.ones(len(a), bool)
    for k in range(0, 2 * SPAN - GRAM, 8):
        rows = np.flatnonzero(same & (size > k))
        at = np.minimum(k, size[rows].astype(np.int64) - 8)  # the last eight bytes overlap others
        same[rows] = (words[a[rows] + at] == words[b[rows] + at]).all(axis=1)
    return same


class Stretches:
    """The stretches of some texts, as parallel arrays: text number, start, bytes, reach, gram offset, hashes.

    ``before`` and ``after`` stand for the bytes beside the gram; they mean something only where a window has them (``_beside``).
    """

    def __init__(self, data: list[bytes], numbers: list[int], starts: list[int]):
        buf = np.frombuffer(b"".join(data), np.uint8)
        n, sizes = len(buf), np.array([len(d) for d in data])
        up, down = _power_tables(n + 1)
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:n], out=prefix[1:])
        grams = _mix((prefix[GRAM:] - prefix[:-GRAM]) * down[: n - GRAM + 1])
        low = np.uint64(0xFFFFFF)
        least = (grams & ~low) | (low - np.arange(len(grams), dtype=np.uint64))
        width, span = SPAN - GRAM + 1, 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
        at = (low - (least & low)).astype(np.int64)
        owner = np.repeat(np.arange(len(data)), sizes)
        inside = owner[: n - SPAN + 1] == owner[SPAN - 1 :]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (at[1:] != at[:-1]) | ~inside[:-1]
        first = np.flatnonzero(fresh & inside)
        stops = np.flatnonzero(np.append(fresh[1:] | ~inside[1:], True))
        end = stops[np.searchsorted(stops, first)] + SPAN
        own = owner[first]
        before = np.cumsum(sizes) - sizes
        self.number = np.array(numbers)[own]
        self.start = first - before[own] + np.array(starts)[own]
        self.size = (end - first).astype(np.uint8)
        self.offset = (at[first] - first).astype(np.uint8)
        self.gram = _mix(grams[at[first]] ^ np.uint64(_ODD))  # least hashes are small ones; these are spread evenly
        lo, hi = np.maximum(at[first] - _BESIDE, 0), np.minimum(at[first] + GRAM + _BESIDE + 1, n)
        self.before = (_mix((prefix[at[first]] - prefix[lo]) * down[lo]) >> np.uint64(48)).astype(np.uint16)
        self.after = (_mix((prefix[hi] - prefix[at[first]]) * down[at[first]]) >> np.uint64(48)).astype(np.uint16)
        self.content = _mix((prefix[end] - prefix[first]) * down[first] + self.size.astype(np.uint64) * np.uint64(_ODD))
        again = (self.content[1:] == self.content[:-1]) & (self.gram[1:] == self.gram[:-1]) & (own[1:] == own[:-1]) & (np.diff(first) <= SPAN) & (self.size[1:] == self.size[:-1])
        rows = np.flatnonzero(again)
        again[rows] = _equal(buf, first[rows], first[rows + 1], self.size[rows])
        self.reach = np.zeros(len(first), np.uint32)
        if len(rows):
            heads = np.flatnonzero(np.append(True, ~again))
            last = np.append(heads[1:], len(first)) - 1
            self.reach[heads] = first[last] - first[heads]
            for c in FIELDS:
                setattr(self, c, getattr(self, c)[heads])


FIELDS = ("number", "start", "size", "reach", "offset", "gram", "content", "before", "after")


def _beside(size: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a stretch has windows with _BESIDE bytes before the gram, and windows with fewer."""
    first = offset.astype(np.int64)  # the gram's place in the first window; in the last one, it is less by the other windows
    return first >= _BESIDE, first - (size.astype(np.int64) - SPAN) < _BESIDE


def _stretches(data: list[tuple[int, bytes]]) -> Iterator[Stretches]:
    """Stretches of numbered texts, in buffers of bounded size; a long text is cut, its windows are not."""
    part: list[bytes] = []
    numbers: list[int] = []
    starts: list[int] = []
    held = 0
    for number, text in data:
        for s in range(0, max(1, len(text) - SPAN + 1), _BUFFER):
            piece = text[s : s + _BUFFER + SPAN - 1]
            if len(piece) < SPAN:
                continue
            if part and held + len(piece) > _BUFFER:
                yield Stretches(part, numbers, starts)
                part, numbers, starts, held = [], [], [], 0
            part.append(piece)
            numbers.append(number)
            starts.append(s)
            held += len(piece)
    if part:
        yield Stretches(part, numbers, starts)


def _home(doc: np.ndarray, text_hash: np.ndarray, parts: int) -> np.ndarray:
    """The partition in which a text meets what is known of it."""
    return (_mix(doc.view(np.uint64) * np.uint64(_ODD) + text_hash) % np.uint64(parts)).astype(np.int64)


def _hashes(data: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(t) for t in data], np.uint64)


def _rows(parts: list[int], kind: int, blobs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(parts, pa.int32()), pa.array([kind] * len(parts), pa.int32()), pa.array(blobs, pa.binary())],
        ["part", "kind", "blob"],
    )


def _planes(values: np.ndarray) -> bytes:
    """Bytes of the values' differences, one plane for each byte, which compress well for sorted values."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return steps.view(np.uint8).reshape(len(steps), -1).T.tobytes()


def _from_planes(raw: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view(np.uint64).ravel(), dtype=np.uint64)


def _split(home: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The homes that occur, each with its rows."""
    order = np.argsort(home, kind="stable")
    cuts = np.flatnonzero(np.diff(home[order])) + 1
    for rows in np.split(order, cuts) if len(order) else ():
        yield int(home[rows[0]]), rows


def _intervals(doc, text_hash, start, size, parts: int, kind: int, *more: np.ndarray) -> pa.RecordBatch:
    """Intervals (with ``more`` columns), each to the home of its text."""
    homes, blobs = [], []
    for p, rows in _split(_home(doc, text_hash, parts)):
        homes.append(p)
        blobs.append(pack([x[rows] for x in (doc, text_hash, start.astype(np.uint32), size.astype(np.uint32), *more)]))
    return _rows(homes, kind, blobs)


def _gather(blobs: list[bytes]) -> list[np.ndarray]:
    """The columns of several interval blobs, sorted by text and place."""
    cols = [np.concatenate(c) for c in zip(*map(unpack, blobs), strict=True)]
    order = np.lexsort((cols[2], cols[1], cols[0]))
    return [c[order] for c in cols]


def _joined(blobs: list[bytes]) -> bytes:
    return blobs[0] if len(blobs) == 1 else pack([np.concatenate(c) for c in zip(*map(unpack, blobs), strict=True)])


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple[int, bytes]]]]:
    """Rows sorted by (part, kind), a part at a time."""
    from itertools import groupby

    rows = ((p, k, b) for batch in batches for p, k, b in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    for part, group in groupby(rows, key=lambda r: r[0]):
        yield part, ((k, b) for _, k, b in group)


KEEP, REMOVED, CANDIDATE, TEXT, RUN = 0, 1, 2, 3, 4


def _scan(parts: int):
    """Texts to sorted runs of stretches, by gram; what equals an earlier document of the same run is decided here, by bytes."""

    def flush(found: list[Stretches], docs: list[int], hashes: list[int], data: list[bytes]) -> Iterator[pa.RecordBatch]:
        if not found:
            return
        doc, th = np.array(docs, np.int64), np.array(hashes, np.uint64)
        number, start, size, reach, offset, gram, content, before, after = (np.concatenate([getattr(s, c) for s in found]) for c in FIELDS)
        found.clear()
        order = np.lexsort((doc[number], content, gram))
        number, start, size, reach, offset, gram, content, before, after = (x[order] for x in (number, start, size, reach, offset, gram, content, before, after))
        first = np.ones(len(gram), bool)
        first[1:] = (gram[1:] != gram[:-1]) | (content[1:] != content[:-1])
        head = np.flatnonzero(first)[np.cumsum(first) - 1]
        late = doc[number] > doc[number[head]]
        if late.any():
            base = np.cumsum([0, *map(len, data)])[:-1]
            at, rows = base[number] + start, np.flatnonzero(late)
            late[rows] = _equal(np.frombuffer(b"".join(data), np.uint8), at[rows], at[head[rows]], size[rows])
            yield _intervals(doc[number[late]], th[number[late]], start[late], size[late] + reach[late], parts, REMOVED)
        keep = ~late
        number, start, size, reach, offset, gram, before, after = (x[keep] for x in (number, start, size, reach, offset, gram, before, after))
        homes, blobs = [], []
        for p, rows in _split(_share(gram, parts)):
            used, local = np.unique(number[rows], return_inverse=True)
            kind = np.uint16 if len(used) < 65536 else np.uint32
            homes.append(p)
            blobs.append(pack([len(rows), doc[used], th[used], local.astype(kind), start[rows].astype(np.uint32), size[rows], reach[rows], offset[rows], before[rows], after[rows], _planes(gram[rows])]))
        yield _rows(homes, KEEP, blobs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, docs, hashes, kept, held, many = [], [], [], [], 0, 0
        for batch in slices(batches):
            ids, data = batch.column("doc_id").to_pylist(), texts(batch)
            at = 0
            while at < len(data):
                part, size = [], 0
                while at < len(data) and size < _BUFFER:
                    if ids[at] is not None:
                        part.append((len(docs), data[at]))
                        docs.append(ids[at])
                        hashes.append(xxhash.xxh3_64_intdigest(data[at]))
                        kept.append(data[at])
                        size += len(data[at])
                    at += 1
                for made in _stretches(part):
                    found.append(made)
                    many += len(made.start)
                held += size
                if held >= _FLUSH or many >= _FLUSH >> 4:
                    yield from flush(found, docs, hashes, kept)
                    found, docs, hashes, kept, held, many = [], [], [], [], 0, 0
        yield from flush(found, docs, hashes, kept)

    return run


def _share(gram: np.ndarray, parts: int) -> np.ndarray:
    """The partition in which a gram's stretches meet: contiguous shares of the hashes."""
    return ((gram >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _match(parts: int, crowded: int):
    """Runs of one share of the grams to the stretches left to compare: those whose gram, with the bytes beside it, another document has too."""

    def decide(blobs: list[bytes], part: int) -> Iterator[pa.RecordBatch]:
        runs = []
        for blob in blobs:
            n, doc, th, local, *cols, planes = unpack(blob)
            runs.append((_from_planes(planes, n), local, doc, th, *cols))
        low, high = -(-(part << 64) // parts), -(-((part + 1) << 64) // parts)
        left: list[tuple[np.ndarray, ...]] = []
        for k in range(_RANGES):
            a, b = (low + (high - low) * i // _RANGES for i in (k, k + 1))
            cols = [[] for _ in range(9)]
            for gram, local, doc, th, *more in runs:
                i = np.searchsorted(gram, np.uint64(a)) if k else 0
                j = np.searchsorted(gram, np.uint64(b)) if k < _RANGES - 1 else len(gram)
                own = local[i:j]
                for col, x in zip(cols, (gram[i:j], doc[own], th[own], *(x[i:j] for x in more)), strict=True):
                    col.append(x)
            if any(map(len, cols[0])):
                left.append(resolve([np.concatenate(c) for c in cols]))
        if any(len(found[0]) for found in left):
            doc, th, start, size, *more = (np.concatenate(c) for c in zip(*left, strict=True))
            del runs, left
            yield _intervals(doc, th, start, size, parts, CANDIDATE, *more)

    def resolve(cols: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        order = np.argsort(cols[0], kind="stable")
        gram, doc, th, start, size, reach, offset, *hashes = (x[order] for x in cols)
        new = np.ones(len(gram), bool)
        new[1:] = gram[1:] != gram[:-1]
        heads, group = np.flatnonzero(new), np.cumsum(new) - 1
        met = (np.minimum.reduceat(doc, heads) < np.maximum.reduceat(doc, heads))[group]
        left = np.zeros(len(gram), bool)
        for has, beside in zip(_beside(size, offset), hashes, strict=True):
            rows = np.flatnonzero(met & has)
            if len(rows):
                code = group[rows] << 16 | beside[rows]
                rows = rows[np.argsort(code, kind="stable")]
                code = group[rows] << 16 | beside[rows]
                starts = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
                several = np.minimum.reduceat(doc[rows], starts) < np.maximum.reduceat(doc[rows], starts)
                left[rows] |= np.repeat(several, np.diff(np.append(starts, len(rows))))
        apart = (np.bincount(group[left], minlength=len(heads)) > crowded)[group]
        return tuple(x[left] for x in (doc, th, start, size, reach, offset, apart))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _by_part(batches):
            blobs, home = [], []
            for kind, blob in rows:  # KEEP first
                if kind == KEEP:
                    blobs.append(blob)
                    continue
                if blobs:
                    yield from decide(blobs, part)
                    blobs = []
                home.append(blob)  # the scan has decided these; they are at home already
                if sum(map(len, home)) >= 1 << 20:
                    yield _rows([part], kind, [_joined(home)])
                    home = []
            if blobs:
                yield from decide(blobs, part)
            if home:
                yield _rows([part], REMOVED, [_joined(home)])

    return run


def _texts_home(parts: int):
    """Rows of documents, compressed, to the homes of their texts."""

    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        data = texts(table.to_batches()[0])
        docs = np.array([d or 0 for d in table.column("doc_id").to_pylist()], np.int64)
        homes, blobs = [], []
        for p, rows in _split(_home(docs, _hashes(data), parts)):
            sink = pa.BufferOutputStream()
            share = table.take(pa.array(rows))
            with pa.ipc.new_stream(sink, share.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(share)
            homes.append(p)
            blobs.append(sink.getvalue().to_pybytes())
        yield _rows(homes, TEXT, blobs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                held.append(part)
                size += part.nbytes
                if size >= _FLUSH:
                    yield from flush(held)
                    held, size = [], 0
        if size or held:
            yield from flush(held)

    return run


def _documents(blob: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(blob) as stream:
        return stream.read_all().combine_chunks().to_batches()[0]


class _Known:
    """Intervals of a partition's texts by (doc, text hash)."""

    def __init__(self, blobs: list[bytes]):
        self.cols = _gather(blobs) if blobs else None
        self.at: dict[tuple[int, int], tuple[int, int]] = {}
        if self.cols:
            doc, th = self.cols[:2]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (th[1:] != th[:-1])
            heads = np.flatnonzero(new)
            ends = np.append(heads[1:], len(doc))
            self.at = {(d, t): (a, b) for d, t, a, b in zip(doc[heads].tolist(), th[heads].tolist(), heads.tolist(), ends.tolist(), strict=True)}

    def of(self, doc: int | None, text: bytes) -> tuple[int, int]:
        return self.at.get((doc, xxhash.xxh3_64_intdigest(text)), (0, 0)) if self.at else (0, 0)


def _extract(parts: int):
    """Candidates and texts of a home to front-coded sorted suffix runs for the merging tasks.

    Equal stretches of a run (bytes and place of the gram) are one entry, that of the least
    document; those of its other documents go at once.
    """

    def flush(entries: dict[tuple[bytes, int], list[int]], home: int) -> Iterator[pa.RecordBatch]:
        runs, late = defaultdict(list), []
        for (whole, offset), at in entries.items():
            crowded = offset == _WINDOW
            suffix, left = (whole, b"") if crowded else (whole[offset:], whole[:offset])
            rows = runs[xxhash.xxh3_64_intdigest(suffix[:SPAN] if crowded else suffix[:GRAM]) % parts, crowded]
            if len(at) == 4:
                rows.append((suffix, left, *at))
                continue
            least = min(at[::4])
            for doc, th, start, reach in zip(at[::4], at[1::4], at[2::4], at[3::4], strict=True):
                if doc > least:
                    late.append((doc, th, start, len(whole) + reach))
                else:
                    rows.append((suffix, left, doc, th, start, reach))
        entries.clear()
        homes, blobs = [], []
        for (p, crowded), rows in runs.items():
            rows.sort(key=lambda r: r[0])
            tails, prefixes, lengths = front_code([r[0] for r in rows])
            left, doc, th, start, reach = zip(*(r[1:] for r in rows), strict=True)
            ends = np.cumsum([len(x) for x in left])
            homes.append(p)
            blobs.append(pack([crowded, tails, bytes(prefixes), bytes(lengths), b"".join(left), ends.astype(np.uint32), np.array(doc, np.int64), np.array(th, np.uint64), np.array(start, np.uint32), np.array(reach, np.uint32)]))
        if homes:
            yield _rows(homes, RUN, blobs)
        if late:  # these texts are at home here
            doc, th, start, size = zip(*late, strict=True)
            yield _rows([home], REMOVED, [pack([np.array(doc, np.int64), np.array(th, np.uint64), np.array(start, np.uint32), np.array(size, np.uint32)])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for home, rows in _by_part(batches):
            blobs, known, entries, held = [], None, {}, 0
            for kind, blob in rows:
                if kind == CANDIDATE:
                    blobs.append(blob)
                elif kind == TEXT and blobs:
                    known = known or _Known(blobs)
                    batch = _documents(blob)
                    for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                        a, b = known.of(doc, text)
                        for lo in range(a, b, _RUN):  # a long text's stretches need not fit into one run
                            hi = min(b, lo + _RUN)
                            th = int(known.cols[1][lo])
                            for start, size, reach, offset, crowded in zip(*(c[lo:hi].tolist() for c in known.cols[2:]), strict=True):
                                if crowded:
                                    for s in range(start, start + size - SPAN + 1):
                                        entries.setdefault((text[s : s + SPAN], _WINDOW), []).extend((doc, th, s, reach))
                                    held += size - SPAN
                                else:
                                    entries.setdefault((text[start : start + size], offset), []).extend((doc, th, start, reach))
                            held += hi - lo
                            if held >= _RUN:
                                yield from flush(entries, home)
                                held = 0
            yield from flush(entries, home)

    return run


#: Stands for the gram's offset in entries that are one window.
_WINDOW = 255


def _found(late: list[tuple[int, int, int, int]], parts: int) -> pa.RecordBatch:
    doc, th, start, size = zip(*late, strict=True)
    return _intervals(np.array(doc, np.int64), np.array(th, np.uint64), np.array(start), np.array(size), parts, REMOVED)


def _run(blob: bytes) -> tuple[bool, Iterator[tuple[int, bytes, object]]]:
    crowded, tails, prefixes, lengths, left, ends, doc, th, start, reach = unpack(blob)

    def rows() -> Iterator[tuple[int, bytes, object]]:
        begin = 0
        places = zip(doc.tolist(), th.tolist(), start.tolist(), reach.tolist(), strict=True)
        for (h, s), e, at in zip(front_decode(tails, prefixes, lengths), ends.tolist(), places, strict=True):
            yield h, s, (left[begin:e], at)
            begin = e

    return crowded, rows()


def _shared_suffix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[len(a) - n :] == b[len(b) - n :]:
        return n
    return shared_prefix(a[::-1], b[::-1])


def _repeated(group: list[tuple]) -> Iterator[tuple[int, int, int, int]]:
    """(doc, text hash, start, bytes) of the windows of a gram's stretches that an earlier document has.

    ``group``: (prefix shared with the entry before, suffix, left, (doc, text hash, start, reach)), sorted by suffix.
    """
    first = group[0][3][0]
    if all(e[3][0] == first for e in group):
        return
    # different stretches: least document, entries, prefix shared with the stretch before
    kinds: dict[tuple[bytes, bytes], list] = {}
    shared = 255
    for h, suffix, left, at in group:
        shared = min(shared, h)
        kind = kinds.get((suffix, left))
        if kind is None:
            kinds[suffix, left] = [at[0], [at], shared]
            shared = 255
        else:
            kind[0] = min(kind[0], at[0])
            kind[1].append(at)
    for (suffix, left), (least, at, _) in kinds.items():
        for doc, th, start, reach in at:
            if doc > least:
                yield doc, th, start, len(left) + len(suffix) + reach
    if len(kinds) > _FEW:
        yield from _by_windows(kinds)
        return
    each = list(kinds.items())
    for i, ((_, left), (least, at, _)) in enumerate(each):
        prefix = 255
        for j in range(i + 1, len(each)):
            (_, other), (rival, others, h) = each[j]
            prefix = min(prefix, h)
            if least == rival or prefix + min(len(left), len(other)) < SPAN:
                continue
            common = _shared_suffix(left, other)
            if common + prefix >= SPAN:
                late, before, place = (others, least, len(other)) if least < rival else (at, rival, len(left))
                for doc, th, start, reach in late:
                    if doc > before:
                        yield doc, th, start + place - common, common + prefix + reach


def _by_windows(kinds: dict[tuple[bytes, bytes], list]) -> Iterator[tuple[int, int, int, int]]:
    """The same for many different stretches, whose windows are looked up in a table."""
    earliest: dict[bytes, int] = {}
    for (suffix, left), (least, _, _) in kinds.items():
        whole = left + suffix
        for s in range(len(whole) - SPAN + 1):
            w = whole[s : s + SPAN]
            if earliest.get(w, least) >= least:
                earliest[w] = least
    for (suffix, left), (least, at, _) in kinds.items():
        whole = left + suffix
        hit = [s for s in range(len(whole) - SPAN + 1) if earliest[whole[s : s + SPAN]] < least]
        spans: list[list[int]] = []
        for s in hit:
            if spans and s == spans[-1][1] + 1:
                spans[-1][1] = s
            else:
                spans.append([s, s])
        for doc, th, start, reach in at:
            for lo, hi in spans:
                yield doc, th, start + lo, hi - lo + SPAN + reach


def _merge(parts: int):
    """Front-coded runs of one partition to removed intervals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _by_part(batches):
            runs, out = [], []
            for kind, blob in rows:
                if kind == RUN:
                    runs.append(_run(blob))
                else:  # decided where the runs were made
                    yield _rows([part], kind, [blob])
            for crowded, least in ((False, GRAM), (True, SPAN)):
                group: list = []
                for h, suffix, (left, at) in merge([r for c, r in runs if c == crowded]):
                    if h < least:
                        if len(group) > 1:
                            out += _repeated(group)
                            if len(out) >= 60_000:
                                yield _found(out, parts)
                                out = []
                        group = []
                    group.append((h, suffix, left, at))
                if len(group) > 1:
                    out += _repeated(group)
            if out:
                yield _found(out, parts)

    return run


def _apply(names: list[str], with_kept: bool):
    """Texts of a home and their removed intervals to result rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_part(batches):
            blobs, known = [], None
            for kind, blob in rows:
                if kind == REMOVED:
                    blobs.append(blob)
                elif kind == TEXT:
                    known = known or _Known(blobs)
                    batch = _documents(blob)
                    out = []
                    for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                        a, b = known.of(doc, text)
                        spans: list[list[int]] = []
                        if a < b:
                            for s, n in zip(known.cols[2][a:b].tolist(), known.cols[3][a:b].tolist(), strict=True):
                                if spans and s <= spans[-1][1]:
                                    spans[-1][1] = max(spans[-1][1], s + n)
                                else:
                                    spans.append([s, s + n])
                        at, kept = 0, []
                        for s, e in spans:
                            kept.append(text[at:s])
                            at = e
                        left = b"".join([*kept, text[at:]])
                        made = (left, left.decode("utf-8", "ignore")) if with_kept else ()
                        out.append((len(text), len(text) - len(left), len(spans), hashlib.sha256(left).hexdigest(), *made))
                    cols = list(zip(*out, strict=True))
                    made = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3])]
                    made += [pa.array(cols[4], pa.binary()), pa.array(cols[5], pa.string())] if with_kept else []
                    yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *made], [*names, *_MADE[: len(made)]])

    return run


_MADE = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "kept_text"]


def _dealt(df: DataFrame, parts: int) -> DataFrame:
    return df.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "kind")


def remove_repeats(docs: DataFrame, kept: bool = False, crowded: int = CROWDED) -> DataFrame:
    """The columns of ``docs`` with n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept
    (binary) and kept_text (string, without characters that were cut).

    Needs doc_id (integer) and text. A null text is empty; texts under 50 bytes lose
    nothing. "Smaller" is strict: rows that repeat a doc_id do not remove each other's
    bytes. A row without doc_id neither loses bytes nor takes any. Columns of ``docs``
    named like those added are replaced.
    """
    spark = docs.sparkSession
    parts = partitions(spark)
    docs = docs.drop(*_MADE).withColumn("doc_id", F.col("doc_id").cast("long"))
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    first = Table(_dealt(narrow.mapInArrow(task(_scan(parts)), _SCHEMA), parts).mapInArrow(task(_match(parts, crowded)), _SCHEMA), "stretches")
    homes = narrow.mapInArrow(task(_texts_home(parts)), _SCHEMA)
    suffixes = _dealt(first.df.where(F.col("kind") == CANDIDATE).union(homes), parts).mapInArrow(task(_extract(parts)), _SCHEMA)
    second = Table(_dealt(suffixes, parts).mapInArrow(task(_merge(parts)), _SCHEMA), "windows")
    removed = first.df.where(F.col("kind") == REMOVED).union(second.df)
    rows = docs.mapInArrow(task(_texts_home(parts)), _SCHEMA)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    made = ["n_bytes long", "n_removed long", "n_spans long", "kept_sha256 string"] + ["kept binary", "kept_text string"] * kept
    return _dealt(removed.union(rows), parts).mapInArrow(task(_apply(docs.columns, kept)), ", ".join(fields + made))


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
