"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own features, its neighbours' features and
its neighbours' labels. Forward-backward gives each line's probability of being good; the
length-weighted mean over a document, calibrated on the training rows, is its quality.

Training labels are known for documents only. The first fit gives each line its
document's label; later fits relabel the lines of bad documents by their own marginals
(the worst line stays bad), so that good passages of bad documents stop counting as bad.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, slices, task

THRESHOLD = 0.3
#: Training rows of each class at most, and their text's bytes; the rows of least hash are taken.
TRAIN_ROWS, TRAIN_BYTES = 1200, 1 << 16
_SLICE = 1 << 20
_CLASSES = 9


def _class_table() -> np.ndarray:
    """Character class by code point below 0x250; the last entry stands for the rest."""
    table = np.full(0x251, 8, np.uint8)
    for c in range(0x250):
        ch = chr(c)
        if ch.isupper():
            table[c] = 0
        elif ch.isalpha():
            table[c] = 1
        elif ch.isdigit():
            table[c] = 2
        elif ch.isspace():
            table[c] = 3
        elif ch == "!":
            table[c] = 4
        elif ch == "|":
            table[c] = 5
        elif ch in ".,;:'\"-?()":
            table[c] = 6
        elif ch.isascii():
            table[c] = 7
    return table


_TABLE = _class_table()


def line_features(data: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of every line, characters of every line, lines of every text). An empty text has one empty line."""
    joined = "\n".join(data)
    lines = joined.split("\n")
    counts = np.zeros(len(lines) * _CLASSES, np.int64)
    base = 0
    for at in range(0, len(joined), _SLICE):
        codes = np.frombuffer(joined[at : at + _SLICE].encode("utf-32-le", "surrogatepass"), np.uint32)
        breaks = codes == 10
        line = base + np.cumsum(breaks) - breaks
        kind = _TABLE[np.minimum(codes, 0x250)]
        lo, hi = int(line[0]), int(line[-1])
        part = np.bincount(((line - lo) * _CLASSES + kind)[~breaks], minlength=(hi - lo + 1) * _CLASSES)
        counts[lo * _CLASSES : (hi + 1) * _CLASSES] += part
        base = hi + int(breaks[-1])
    sizes = np.array([d.count("\n") + 1 for d in data])
    words, distinct, again, at = np.zeros(len(lines)), np.zeros(len(lines)), np.zeros(len(lines)), 0
    for n in sizes.tolist():
        seen: set[str] = set()
        for i in range(at, at + n):
            own = lines[i].split()
            words[i], distinct[i] = len(own), len(set(own))
            if own and n > 1:
                again[i] = lines[i] in seen
                seen.add(lines[i])
        at += n
    c = counts.reshape(-1, _CLASSES).astype(float)
    chars = c.sum(axis=1)
    n = np.maximum(chars, 1)
    letters = c[:, 0] + c[:, 1]
    upper, digit, bang, pipe, plain, symbol = c[:, 0] / np.maximum(letters, 1), c[:, 2] / n, c[:, 4] / n, c[:, 5] / n, c[:, 6] / n, c[:, 7] / n
    own = np.stack(
        [
            upper, digit, bang, pipe, plain, symbol, c[:, 3] / n, c[:, 8] / n,
            upper > 0.5, digit > 0.2, bang > 0.02, pipe > 0.01, symbol > 0.02,
            np.log1p(chars) / 8, np.log1p(words) / 6, np.minimum(letters / np.maximum(words, 1), 40) / 10,
            distinct / np.maximum(words, 1), (distinct / np.maximum(words, 1) < 0.5) & (words > 8), again, chars == 0,
        ],
        axis=1,
    )
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    starts = np.cumsum(sizes) - sizes
    before[starts] = 0
    after[starts + sizes - 1] = 0
    edge = np.zeros((len(own), 2))
    edge[starts, 0] = edge[starts + sizes - 1, 1] = 1
    return np.concatenate([own, before, after, edge, np.ones((len(own), 1))], axis=1), chars, sizes


def marginals(odds: np.ndarray, sizes: np.ndarray, link: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward over chains laid end to end.

    ``odds``: log-odds of good by line; ``link``: 2 x 2 log-weights of neighbouring labels.
    Returns each line's probability of good, the expected label pairs and the log-partition.
    """
    emit = np.stack([1 / (1 + np.exp(np.clip(odds, -50, 50))), 1 / (1 + np.exp(-np.clip(odds, -50, 50)))], axis=1)
    weight = np.exp(link)
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    lengths = sizes[order]
    alpha, scale = np.zeros_like(emit), np.ones(len(emit))
    alive = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    now = None
    for t, k in enumerate(alive.tolist()):
        at = starts[:k] + t
        now = emit[at] if t == 0 else (now[:k] @ weight) * emit[at]
        total = now.sum(axis=1)
        now = now / total[:, None]
        alpha[at], scale[at] = now, total
    beta = np.ones_like(emit)
    pairs = np.zeros((2, 2))
    for t in range(len(alive) - 1, 0, -1):
        k = int(alive[t])
        at = starts[:k] + t
        right = emit[at] * beta[at] / scale[at][:, None]
        pairs += (alpha[at - 1].T @ right) * weight
        beta[at - 1] = right @ weight.T
    good = alpha * beta
    return good[:, 1] / good.sum(axis=1), pairs, float(np.log(scale).sum() + np.logaddexp(0, np.clip(odds, -50, 50)).sum())


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    theta: np.ndarray
    link: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def lines(self, data: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(probability of good of every line, its characters, lines of every text)."""
        x, chars, sizes = line_features(data)
        p, _, _ = marginals(((x - self.mean) / self.spread) @ self.theta, sizes, self.link)
        return p, chars, sizes

    def quality(self, data: list[str]) -> np.ndarray:
        """Length-weighted mean probability of good lines of every text."""
        if not data:
            return np.zeros(0)
        p, chars, sizes = self.lines(data)
        starts = np.cumsum(sizes) - sizes
        weight = chars + 1
        return np.add.reduceat(p * weight, starts) / np.add.reduceat(weight, starts)

    def score(self, data: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * _logit(self.quality(data)) + self.shift)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and shift of a weighted logistic fit by Newton steps, lightly regularised."""
    w = np.array([1.0, 0.0])
    design = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (weight * (p - y)) + 1e-2 * (w - [1.0, 0.0])
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w - np.clip(step, -2, 2)
        w[0] = max(w[0], 0.0)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


def train(data: list[str], labels: np.ndarray, weight: np.ndarray, rounds: int = 3, steps: int = 80) -> Model:
    """Fit on whole texts with labels 1 (good) or 0; ``weight``: how many corpus rows a text stands for."""
    x, chars, sizes = line_features(data)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-3
    mean[-1], spread[-1] = 0.0, 1.0
    x = (x - mean) / spread
    owner = np.repeat(np.arange(len(data)), sizes)
    starts = np.cumsum(sizes) - sizes
    inner = np.ones(len(x), bool)
    inner[starts] = False
    right = np.flatnonzero(inner)
    y = labels[owner].astype(float)
    theta, link = np.zeros(x.shape[1]), np.zeros((2, 2))
    for _ in range(rounds):
        z = y.astype(int)
        seen = np.zeros((2, 2))
        np.add.at(seen, (z[right - 1], z[right]), 1)
        m = [np.zeros_like(theta), np.zeros_like(link)]
        v = [np.zeros_like(theta), np.zeros_like(link)]
        for step in range(1, steps + 1):
            p, pairs, _ = marginals(x @ theta, sizes, link)
            grads = [(x.T @ (p - y)) / len(x) + 1e-4 * theta, (pairs - seen) / len(x) + 1e-3 * link]
            for i, (w, g) in enumerate(zip((theta, link), grads, strict=True)):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.99 * v[i] + 0.01 * g * g
                w -= 0.1 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-8)
        p, _, _ = marginals(x @ theta, sizes, link)
        y = np.where(labels[owner] == 1, 1.0, (p > 0.5).astype(float))
        low = np.full(len(data), np.inf)
        np.minimum.at(low, owner, p)
        y[(labels[owner] == 0) & (p <= low[owner])] = 0.0
    model = Model(mean, spread, theta, link)
    model.slope, model.shift = calibrate(_logit(model.quality(data)), labels.astype(float), weight)
    return model


def held_out(doc_id: str = "doc_id", modulus: int = 5, rest: int = 0) -> F.Column:
    """True where crc32 of the id as text leaves ``rest``; null ids count as the text ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus == rest


def training_rows(docs: DataFrame, labels: DataFrame, label: str, out: F.Column, per_class: int = TRAIN_ROWS, max_bytes: int = TRAIN_BYTES):
    """(texts, labels, weights) of a bounded sample of labelled rows outside ``out``: those of least hash in each class.

    At most ``per_class`` ids of a class, less those whose text is longer than ``max_bytes``. An id with
    both labels counts as 1; of an id with several texts the least is taken, so that the sample is always the same.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & ~out).groupBy("doc_id").agg(F.max("y").alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = known.withColumn("h", F.xxhash64("doc_id"))
    ids = [r for y in counts for r in picked.where(F.col("y") == y).orderBy("h", "doc_id").limit(per_class).select("doc_id", "y").collect()]
    small = docs.sparkSession.createDataFrame(ids, "doc_id long, y int")
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .join(F.broadcast(small), "doc_id")  # at most 2 * per_class rows
        .where(F.octet_length("text") <= max_bytes)
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.first("y").alias("y"))
        .orderBy("doc_id")
        .collect()
    )
    y = np.array([r["y"] for r in rows], int)
    weight = np.array([counts[k] / max(1, (y == k).sum()) for k in y.tolist()])
    return [r["text"] for r in rows], y, weight / max(weight.mean(), 1e-9) if len(y) else weight


def fit(docs: DataFrame, labels: DataFrame, out: F.Column | None = None) -> Model:
    """A model of ``labels.quality``; with fewer than two classes every text scores the share of label 1 or one half."""
    data, y, weight = training_rows(docs, labels, "quality", held_out() if out is None else out)
    if len(set(y.tolist())) < 2:
        k = line_features([""])[0].shape[1]
        share = float(y.mean()) if len(y) else 0.5
        return Model(np.zeros(k), np.ones(k), np.zeros(k), np.zeros((2, 2)), 0.0, float(_logit(np.array([share]))[0]))
    return train(data, y, weight)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column quality_score (0 to 1).

    A null text counts as empty; whole texts of any length are scored; equal texts score alike and repeated
    rows each stay; an empty table stays empty; a column of that name is replaced.
    """
    docs = docs.drop("quality_score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, out, at = [t or "" for t in batch.column("text").cast(pa.large_string()).to_pylist()], [], 0
            while at < len(data):
                stop, held = at, 0
                while stop < len(data) and (stop == at or held + len(data[stop]) <= _SLICE):
                    held += len(data[stop])
                    stop += 1
                out.append(model.score(data[at:stop]))
                at = stop
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out) if out else np.zeros(0))], [*batch.schema.names, "quality_score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(task(run), ", ".join([*fields, "quality_score double"]))


def op7_quality_crf(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted")
    )


def crc_text(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode())
