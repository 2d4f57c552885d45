"""Coordinate frames as a relation: rows (frame, parent, matrix), the matrix 16 doubles, row-major, for row vectors (p' = p M)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import cut

IDENTITY = [float(i % 5 == 0) for i in range(16)]


def identity() -> Column:
    return F.array(*map(F.lit, IDENTITY))


def product(a: Column, b: Column) -> Column:
    """``a`` followed by ``b``, without leaving the JVM; null if one is."""
    cell = lambda i: sum((a[i // 4 * 4 + k] * b[k * 4 + i % 4] for k in range(1, 4)), a[i // 4 * 4] * b[i % 4])
    return F.when(a.isNotNull() & b.isNotNull(), F.array(*[cell(i) for i in range(16)]))


def transform(m: Column, x: Column, y: Column, z: Column) -> Column:
    """struct<x, y, z> of a point carried by an affine matrix."""
    return F.struct(*[(x * m[i] + y * m[4 + i] + z * m[8 + i] + m[12 + i]).alias(n) for i, n in enumerate("xyz")])


def rigid_inverse(m: Column) -> Column:
    """Inverse of a turn and a shift: the turn transposed, the shift carried back."""
    turn = [[m[4 * j + i] for j in range(3)] for i in range(3)]
    shift = [-(m[12] * turn[0][j] + m[13] * turn[1][j] + m[14] * turn[2][j]) for j in range(3)]
    rows = [c for r in turn for c in (*r, F.lit(0.0))]
    return F.when(m.isNotNull(), F.array(*rows, *shift, F.lit(1.0)))


def from_quaternion(q: Column, shift: Column | None = None) -> Column:
    """The matrix of a unit quaternion struct<x, y, z, w> and a shift struct<x, y, z>."""
    x, y, z, w = (q[c] for c in "xyzw")
    t = [shift[c] for c in "xyz"] if shift is not None else [F.lit(0.0)] * 3
    zero = F.lit(0.0)
    return F.array(
        1 - 2 * (y * y + z * z), 2 * (x * y + z * w), 2 * (x * z - y * w), zero,
        2 * (x * y - z * w), 1 - 2 * (x * x + z * z), 2 * (y * z + x * w), zero,
        2 * (x * z + y * w), 2 * (y * z - x * w), 1 - 2 * (x * x + y * y), zero, *t, F.lit(1.0),
    )


def to_quaternion(m: Column) -> Column:
    """struct<x, y, z, w>, w not negative, of a matrix without scale: the signs come from the off-diagonal differences."""
    side = lambda a, b, c: F.sqrt(F.greatest(1 + a * m[0] + b * m[5] + c * m[10], F.lit(0.0))) / 2
    sign = lambda v: F.when(v < 0, -1.0).otherwise(1.0)
    w, x, y, z = side(1, 1, 1), side(1, -1, -1), side(-1, 1, -1), side(-1, -1, 1)
    half = w > 1e-9
    # without w (a half turn) the largest part is positive and the products of the parts give the other signs
    xs = F.when(half, sign(m[6] - m[9])).otherwise(1.0)
    ys = F.when(half, sign(m[8] - m[2])).when(x > 1e-9, sign(m[1] + m[4])).otherwise(1.0)
    zs = F.when(half, sign(m[1] - m[4])).when(x > 1e-9, sign(m[2] + m[8])).when(y > 1e-9, sign(m[6] + m[9])).otherwise(1.0)
    return F.struct((x * xs).alias("x"), (y * ys).alias("y"), (z * zs).alias("z"), w.alias("w"))


def decompose(m: Column) -> Column:
    """struct<scale, rotation, translation> of a turn and scales along the axes; null where a scale is 0."""
    sizes = [F.sqrt(m[4 * i] * m[4 * i] + m[4 * i + 1] * m[4 * i + 1] + m[4 * i + 2] * m[4 * i + 2]) for i in range(3)]
    det = m[0] * (m[5] * m[10] - m[6] * m[9]) - m[1] * (m[4] * m[10] - m[6] * m[8]) + m[2] * (m[4] * m[9] - m[5] * m[8])
    sizes[0] = sizes[0] * F.when(det < 0, -1.0).otherwise(1.0)
    flat = F.array(*[m[i] / F.nullif(sizes[i // 4], F.lit(0.0)) if i < 12 and i % 4 < 3 else F.lit(IDENTITY[i]) for i in range(16)])
    parts = F.struct(F.struct(*[s.alias(c) for s, c in zip(sizes, "xyz", strict=True)]).alias("scale"), to_quaternion(flat).alias("rotation"), F.struct(*[m[12 + i].alias(c) for i, c in enumerate("xyz")]).alias("translation"))
    return F.when((F.abs(sizes[0]) > 0) & (sizes[1] > 0) & (sizes[2] > 0), parts)


def inverse(df: DataFrame, matrix: str, name: str = "inverse") -> DataFrame:
    """``df`` with the general inverse of a matrix column, a batch at a time; null for a singular or null matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(matrix).to_pylist()
            out: list = [None] * len(rows)
            at = [i for i, r in enumerate(rows) if r is not None]
            if at:
                m = np.array([rows[i] for i in at], float).reshape(-1, 4, 4)
                good = np.abs(np.linalg.det(m)) > 1e-300
                for i, v in zip(np.array(at)[good].tolist(), np.linalg.inv(m[good]).reshape(-1, 16).tolist(), strict=True):
                    out[i] = v
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.float64()))], [*batch.schema.names, name])

    df = df.drop(name)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema]
    return df.mapInArrow(run, ", ".join([*fields, f"`{name}` array<double>"]))


def to_root(frames: DataFrame, depth: int = 64) -> DataFrame:
    """Rows (frame, root, matrix, steps): each frame's matrix to the top of its chain.

    Ancestor pointers double in each round, so chains of up to ``depth`` steps take log2 rounds;
    a longer chain or a circle raises. A parent that has no row of its own is the top.
    """
    at = frames.select("frame", F.col("parent").alias("up"), "matrix", F.when(F.col("parent").isNull(), 0).otherwise(1).alias("steps"))
    at = at.select("frame", "up", F.when(F.col("steps") == 0, identity()).otherwise(F.col("matrix")).alias("matrix"), "steps")
    done = 1
    while done < depth:
        above = at.select(F.col("frame").alias("of"), F.col("up").alias("up2"), F.col("matrix").alias("m2"), F.col("steps").alias("s2"))
        at = at.join(above.where("up2 is not null"), F.col("up") == F.col("of"), "left")
        at = cut(at.select(
            "frame", F.coalesce("up2", "up").alias("up"), F.coalesce(product(F.col("matrix"), F.col("m2")), F.col("matrix")).alias("matrix"), (F.col("steps") + F.coalesce("s2", F.lit(0))).alias("steps")
        ))
        done *= 2
    open_ = at.join(frames.select(F.col("frame").alias("up"), "parent"), "up", "left")
    checked = F.when(F.col("parent").isNotNull(), F.raise_error(F.lit(f"a chain of frames is longer than {depth} steps"))).otherwise(F.col("up"))
    return open_.select("frame", F.coalesce(checked, "frame").alias("root"), "matrix", "steps")


def relative(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (a, b, matrix): the rigid matrix from frame a to frame b through their common root; null if they have none."""
    a, b = (roots.select(F.col("frame").alias(n), F.col("root").alias(f"root_{n}"), F.col("matrix").alias(f"m_{n}")) for n in "ab")
    both = pairs.join(a, "a", "left").join(b, "b", "left")
    way = F.when(F.col("root_a") == F.col("root_b"), product(F.col("m_a"), rigid_inverse(F.col("m_b"))))
    return both.select("a", "b", way.alias("matrix"))


def best_transforms(candidates: DataFrame, order: list[str], source: str = "source") -> DataFrame:
    """One row for each frame: that of the source named first in ``order``; unnamed sources come last, by name."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), F.col(source)), F.lit(0)), F.lit(len(order) + 1))
    first = F.row_number().over(Window.partitionBy("frame").orderBy(rank, source))
    return candidates.withColumn("__n", first).where("__n = 1").drop("__n")


def chained_priors(priors: DataFrame) -> DataFrame:
    """Rows (frame, matrix, sources): a frame's candidate steps (frame, place, source, matrix) multiplied in order of place."""
    steps = priors.groupBy("frame").agg(F.sort_array(F.collect_list(F.struct("place", "source", "matrix"))).alias("s"))  # a frame has few steps
    merged = F.aggregate(F.col("s"), identity(), lambda acc, s: product(acc, s["matrix"]))
    return steps.select("frame", merged.alias("matrix"), F.transform("s", lambda s: s["source"]).alias("sources"))
