"""Packing token sequences: first-fit decreasing over a tournament tree of bin capacities.

Documents are tokenized where they are read and cut into pieces of at most ``size``
tokens; only the pieces' lengths and checksums are shuffled, to randomised groups of
documents. Each group is packed by itself, so a group's work does not grow with the corpus.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, read, slices, task

SIZE = 2048
END = 1
GROUP_DOCS = 2048
#: Chunks that a task remembers; the memory is emptied when it is full.
REMEMBERED = 800_000
_SLICE = 2 << 20

#: Texts of these characters alone are in normal form C and have no white space that the two splits read differently.
_PLAIN = re.compile("[^\\t\\n\\r\\x20-\\x7e\\xa0-\\u024f]")
#: Fixed value: the tokenizer's own pattern of words.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Encoder:
    """Token ids of texts by a tokenizer file of the ``tokenizers`` library.

    The tokenizer drops white space, so a text's ids are those of its chunks between
    blanks. Chunks are remembered; each new one passes through the tokenizer's own model.
    Texts outside plain Latin characters, or with a special token's brackets, go through the
    tokenizer whole.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words = regex.compile(_WORDS).findall
        # the byte-level alphabet: printable bytes stand for themselves, the rest follow from 256 on
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in kept]
        self.alphabet = {b: b for b in kept} | {b: 256 + i for i, b in enumerate(rest)}
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 12, np.int64)
        self.used = 0
        self.starts[0] = 0

    def _word(self, word: str) -> list[int]:
        return [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.alphabet))]

    def _learn(self, chunk: str) -> None:
        core = chunk.rstrip(".,!?;:")
        parts = [core, chunk[len(core) :]] if core.isalpha() else self.words(chunk)
        ids: list[int] = []
        for part in parts:
            code = self.known.get(part) if part != chunk else None
            if not part:
                continue
            if code is None:
                made = self._word(part)
                if part != chunk:
                    self._put(part, made)
                ids += made
            else:
                ids += self.flat[self.starts[code] : self.starts[code + 1]].tolist()
        self._put(chunk, ids)

    def _put(self, chunk: str, ids: list[int]) -> None:
        code = len(self.known)
        if code + 2 > len(self.starts):
            self.starts = np.resize(self.starts, 2 * len(self.starts))
        if self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat) + len(ids))
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.known[chunk] = code
        self.starts[code + 1] = self.used

    def encode(self, data: list[str]) -> list[np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.forget()
        chunks: list[str] = []
        counts = []
        whole: dict[int, np.ndarray] = {}
        for i, text in enumerate(data):
            if _PLAIN.search(text) or "<|" in text:
                whole[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                counts.append(0)
            else:
                own = text.lower().replace("\n", " ").split(" ")
                chunks += own
                counts.append(len(own))
        for chunk in set(chunks).difference(self.known):
            if chunk not in self.known:
                self._learn(chunk)
        codes = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        starts, sizes = self.starts[codes], self.starts[codes + 1] - self.starts[codes]
        ends = np.cumsum(sizes)
        ids = self.flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.append(0, ends)[np.append(0, np.cumsum(counts))]
        return [whole[i] if i in whole else ids[a:b] for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))]


def encoder(path: str) -> Encoder:
    encoders = kept("encoders")
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens, salt) of all whole documents, cut at multiples of ``size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, copies = encoder(tokenizer), {}  # a row's copies go to different groups, and to the same ones if the task runs again
        end = np.array([END], "<u4").tobytes()
        for batch in slices(batches):
            docs, data, at = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()], 0
            while at < len(data):
                stop, held = at, 0
                while stop < len(data) and (stop == at or held + len(data[stop]) <= _SLICE):
                    held += len(data[stop])
                    stop += 1
                out = []
                for doc, ids in zip(docs[at:stop], enc.encode(data[at:stop]), strict=True):
                    raw, n = ids.astype("<u4").tobytes() + end, len(ids) + 1
                    row = (doc, zlib.crc32(raw))
                    copies[row] = copies.get(row, 0) + 1
                    salt = row[1] + (copies[row] << 32)
                    for s in range(0, n, size):
                        part = raw[4 * s : 4 * (s + size)]
                        out.append((doc, s, len(part) // 4, zlib.crc32(part), n, salt))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], _PIECES)
                at = stop

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return wanted.mapInArrow(task(run, "encoders"), ", ".join(f"{c} long" for c in _PIECES))


_PIECES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt"]


class Bins:
    """Open bins under a tournament tree: each inner node holds the largest capacity below it."""

    def __init__(self, size: int):
        self.size = size
        self.count = 0
        self.leaves = 1
        self.tree = [0, size]

    def place(self, length: int) -> int:
        """The first bin with room for ``length``; opens one if there is none."""
        tree = self.tree
        if self.count == self.leaves and tree[1] < length:
            self._grow()
            tree = self.tree
        node = 1
        while node < self.leaves:
            node *= 2
            if tree[node] < length:
                node += 1
        tree[node] -= length
        found = node - self.leaves
        self.count = max(self.count, found + 1)
        while node > 1:
            node >>= 1
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
        return found

    def _grow(self) -> None:
        leaves = self.tree[self.leaves :] + [self.size] * self.leaves
        self.leaves *= 2
        self.tree = [0] * self.leaves + leaves
        for node in range(self.leaves - 1, 0, -1):
            self.tree[node] = max(self.tree[2 * node], self.tree[2 * node + 1])


def first_fit_decreasing(lengths: list[int], size: int = SIZE) -> tuple[list[int], list[int]]:
    """(bin, offset) of each length, placed in the given order, which must not increase."""
    bins, fill = Bins(size), {}
    where, offsets = [], []
    for n in lengths:
        b = bins.place(n)
        where.append(b)
        offsets.append(fill.get(b, 0))
        fill[b] = fill.get(b, 0) + n
    return where, offsets


def pack_sequences(docs: DataFrame, tokenizer: str, size: int = SIZE, group_docs: int = GROUP_DOCS) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids end with id 1; a null or empty text is that id alone. Documents are
    cut at multiples of ``size``, so only a document's last piece shares a sequence.
    Repeated rows are packed each by itself; a null doc_id is kept.
    """
    groups = max(1, -(-docs.count() // group_docs))
    cut = pieces(docs, tokenizer, size)
    cut = cut.withColumn("grp", F.pmod(F.xxhash64("doc_id", "salt"), F.lit(groups)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable")
        where, offsets = first_fit_decreasing(pdf["length"].tolist(), size)
        base = int(pdf["grp"].iloc[0]) << 32
        return pdf.assign(sequence_id=np.array(where, np.int64) + base, offset=np.array(offsets, np.int64))[_RESULT]

    return cut.groupBy("grp").applyInPandas(run, ", ".join(f"{c} long" for c in _RESULT))


_RESULT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def op4_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_sequences(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
