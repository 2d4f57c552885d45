"""Toxicity by compression distance: zstandard dictionaries with word beginnings of toxic and words of ordinary text.

Two pairs of dictionaries are made from half of the training rows. A pair shares a base, a
dictionary that zstandard trains on ordinary text; one dictionary of the pair adds at most 64
beginnings of words that set toxic texts apart (in 3 % of the toxic sample or more), the other as
many bytes of common words. They stand in for dictionaries trained on toxic and on ordinary text,
which told the classes apart less well (README). Every whole text is cut into windows of words;
each window is compressed with both dictionaries of a pair, and the distribution of the
differences is turned into a probability by a logistic fit on the other half of the rows.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, slices, task
from .quality_crf import held_out, training_rows

THRESHOLD = 0.3
#: Bounds of the training sample: rows of each class, bytes of a text.
TRAIN_ROWS, TRAIN_BYTES = 2400, 1 << 16
#: (bytes of the shared base, words of a window)
PAIRS = ((4000, 48), (2000, 16))
STEMS = 64
_SAMPLE_WORDS = 12


def _trained(samples: list[bytes], size: int) -> bytes:
    """The last ``size`` bytes, the most useful, of a trained dictionary; of the samples where they are too few to train on."""
    try:
        content = zstd.train_dictionary(size + 1400, samples).as_bytes()
    except zstd.ZstdError:
        content = b"".join(samples)
    return content[-size:].rjust(size)


def _odds(toxic: Counter, ordinary: Counter, n1: int, n0: int, word: str) -> float:
    return math.log((toxic[word] + 0.5) / (n1 + 1)) - math.log((ordinary[word] + 0.5) / (n0 + 1))


def _counts(data: list[list[str]], prefixes: bool) -> Counter:
    found: Counter = Counter()
    for words in data:
        own = set(words)
        found.update({w[:n] for w in own for n in range(4, min(len(w), 12) + 1)} if prefixes else own)
    return found


class Model:
    """Dictionaries and calibration; plain bytes and arrays, so that it can be sent to tasks."""

    def __init__(self, data: list[str], labels: np.ndarray, weight: np.ndarray):
        half = np.array([zlib.crc32(t.encode()) & 1 for t in data], bool)
        words = [t.lower().split() for t in data]
        toxic = [w for w, y, h in zip(words, labels, half, strict=True) if y and h]
        ordinary = [w for w, y, h in zip(words, labels, half, strict=True) if not y and h]
        self.pairs = self._dictionaries(toxic, ordinary)
        rest = np.flatnonzero(~half)
        if len(set(labels[rest].tolist())) < 2:  # too few rows to set some apart
            rest = np.arange(len(data))
        x = np.array([self.features(data[i]) for i in rest])
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-6
        self.theta = _logistic((x - self.mean) / self.spread, labels[rest].astype(float), weight[rest])
        self._ready = None

    @staticmethod
    def _dictionaries(toxic: list[list[str]], ordinary: list[list[str]]) -> list[tuple]:
        n1, n0, o = len(toxic), len(ordinary), _counts(ordinary, False)
        base = [f" {' '.join(words[len(words) // 3 :][:_SAMPLE_WORDS])} ".encode() for words in ordinary] + [" ".join(words)[:400].encode() for words in ordinary[::2]]
        # beginnings of words that set toxic texts apart, without those that a longer or commoner one explains
        tp, op = _counts(toxic, True), _counts(ordinary, True)
        good = [p for p, c in tp.items() if c >= max(3, 0.03 * n1) and _odds(tp, op, n1, n0, p) >= 4]
        stems: list[str] = []
        for p in sorted(good, key=lambda p: (-tp[p], -len(p), p)):
            if not any(p.startswith(k) or (k.startswith(p) and tp[k] >= 0.9 * tp[p]) for k in stems):
                stems.append(p)
        mine = f" {' '.join(stems[:STEMS])} ".encode()
        common = f" {' '.join(w for w, _ in o.most_common(3000)[300:] if 5 <= len(w) <= 9)} ".encode()
        other = common[: len(mine)].ljust(len(mine))
        return [(window, base_ + mine, base_ + other) for size, window in PAIRS for base_ in [_trained(base, size)]]

    def _compressors(self) -> list[tuple]:
        if getattr(self, "_ready", None) is None:
            self._ready = []
            for window, toxic, ordinary in self.pairs:
                made = zstd.ZstdCompressionParameters.from_level(
                    5, source_size=7 * window, dict_size=len(toxic), strategy=zstd.STRATEGY_LAZY, min_match=4, write_content_size=False, write_dict_id=False, write_checksum=False
                )
                pair = [zstd.ZstdCompressor(compression_params=made, dict_data=zstd.ZstdCompressionDict(d, dict_type=zstd.DICT_TYPE_RAWCONTENT)).compress for d in (toxic, ordinary)]
                self._ready.append((window, *pair))
        return self._ready

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_ready": None}

    def features(self, text: str) -> list[float]:
        """Of each pair: mean, sum (log), highest, ninth decile and spread of the windows' differences a hundred bytes, and the ordinary length."""
        words, out = text.lower().split(), []
        for window, toxic, ordinary in self._compressors():
            gains, sizes, lengths = [], [], 0
            for k in range(0, max(1, len(words)), window):
                part = f" {' '.join(words[k : k + window])} ".encode()
                plain = len(ordinary(part))
                gains.append(plain - len(toxic(part)))
                sizes.append(len(part))
                lengths += plain
            gain, size = np.array(gains, float), np.array(sizes, float)
            rate = 100 * gain / (size + 20)
            total = gain.sum()
            out += [
                100 * total / (size.sum() + 20), math.copysign(math.log1p(abs(total)), total), rate.max(), float(np.quantile(rate, 0.9)),
                rate.std(), math.log1p(np.maximum(gain - 3, 0).sum()), lengths / size.sum(),
            ]
        return out + [math.log1p(len(words))]

    def score(self, text: str) -> float:
        z = float(np.append((np.array(self.features(text)) - self.mean) / self.spread, 1.0) @ self.theta)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic fit by Newton steps with a quadratic penalty; the last weight is the constant."""
    design = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(design.shape[1])
    ridge = np.diag([1.0] * x.shape[1] + [1e-3])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(hess, design.T @ (weight * (p - y)) + ridge @ w)
        w = w - np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, out: F.Column | None = None) -> Model | float:
    """A model of ``labels.toxic``; with fewer than two classes, the share of label 1 (0 without labels).

    It is fitted on at most TRAIN_ROWS texts of each class of at most TRAIN_BYTES bytes, those of least hash of the id.
    """
    data, y, weight = training_rows(docs, labels, "toxic", held_out(modulus=4, rest=2) if out is None else out, TRAIN_ROWS, TRAIN_BYTES)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.0
    return Model(data, y, weight)


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """``docs`` with a column toxic_score (0 to 1).

    A null text counts as empty; whole texts of any length are scored; equal texts score alike and repeated
    rows each stay; an empty table stays empty; a column of that name is replaced.
    """
    docs = docs.drop("toxic_score")
    if isinstance(model, float):
        return docs.withColumn("toxic_score", F.lit(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = [model.score(t or "") for t in batch.column("text").cast(pa.large_string()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], [*batch.schema.names, "toxic_score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(task(run), ", ".join([*fields, "toxic_score double"]))


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", held_out(modulus=4, rest=2).alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= THRESHOLD).cast("int").alias("predicted")
    )
