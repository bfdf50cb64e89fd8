"""Embedding whitening from exact sums, a pivoted Cholesky factor and one-sided Jacobi.

1. An entry c becomes the long x = floor(256 * c).  The fit list holds each
   distinct x vector once (copies are combined before the shuffle and stored).
2. Tasks add the fit list's entries exactly, per dimension, to the sums S.
3. Tasks centre the vectors, then multiply: each gives one scatter matrix, and
   the matrices are added row by row in a tree (``common.tree_sum``).
4. The scatter, dimension by dimension in size, is factored on the driver by
   Cholesky with pivoting, which stops at its rank.  One-sided Jacobi turns the
   columns of that triangular factor until they are orthogonal: their squared
   norms over n are the eigenvalues of the covariance, the columns divided by
   their norms its components (the largest entry positive).
5. Each vector is centred and projected.  The identity error is measured on the
   whitened fit list in a pass of its own.

Defined cases: rows whose vector is null, holds null or non-finite entries, an
entry whose x passes 2**62, or has another length than most rows (the longer
of equally frequent lengths) are dropped; null ids and repeated rows stay.
Dimensions without variance leave fewer components than asked for: a component
needs an eigenvalue above rounding, so a list of one vector gives no rows, like
an empty table.  A deviation beyond a long is null.  Columns not in ``carry``
do not matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm import common

SCALE = 256
COMPONENTS = 4
ROWS = 4096                           # vectors a task holds as one matrix
SWEEPS = 60
LONG = (1 << 63) - 1


def quantized(vectors: DataFrame, column: str, carry: list[str], scale: int = SCALE) -> DataFrame:
    """``carry`` columns as _c0, _c1, ... and ``x``, of the rows with a usable vector."""
    v = F.col(f"`{column}`")
    usable = F.forall(v, lambda c: c.isNotNull() & (F.abs(c.cast("double") * scale) < float(1 << 62)))   # not NaN either
    rows = vectors.filter(v.isNotNull() & F.coalesce(usable, F.lit(False)))
    return rows.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)],
                       F.transform(v, lambda c: F.floor(c.cast("double") * scale)).alias("x"))


def matrix(lists: pa.Array, d: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def matrices(batches: Iterator[pa.RecordBatch], d: int, i: int = 0) -> Iterator[np.ndarray]:
    for b in batches:
        for lo in range(0, b.num_rows, ROWS):
            yield matrix(b.column(i).slice(lo, ROWS), d)


def fits(x: np.ndarray, times: int) -> bool:
    """Whether sums of ``times`` entries like these stay within a long."""
    return not len(x) or max(-int(x.min()), int(x.max())) * max(times, 1) <= LONG


def totals(d: int):
    """Vectors to (dimension, sum), exact."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * d
        for x in matrices(batches, d):
            own = x.sum(axis=0) if fits(x, len(x)) else x.astype(object).sum(axis=0)
            total = [a + int(b) for a, b in zip(total, own)]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(total, pa.decimal128(38, 0))],
                                         ["dimension", "total"])
    return run


@dataclass
class Centre:
    """The fit list's mean S / n, as a whole part and the rest."""
    n: int
    sums: list[int]

    def __post_init__(self) -> None:
        self.whole = np.array([round(Fraction(s, self.n)) for s in self.sums], dtype=np.int64)
        self.rest = np.array([float(Fraction(s, self.n) - int(w)) for s, w in zip(self.sums, self.whole)])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n * x - S) squared, exact."""
        s = np.array(self.sums, dtype=object)
        largest = self.n * max(-int(x.min(initial=0)), int(x.max(initial=0))) + max(map(abs, self.sums), default=0)
        if largest * largest * len(s) <= LONG:
            q = self.n * x - s.astype(np.int64)
            return (q * q).sum(axis=1).tolist()
        q = self.n * x.astype(object) - s
        return [t if t <= LONG else None for t in (q * q).sum(axis=1)]


def scatter(centre: Centre, d: int):
    """Vectors to the rows of a task's scatter matrix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for x in matrices(batches, d):
            y = centre(x)
            total += y.T @ y
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d), pa.int64()), pa.array([part] * d, pa.int64()),
             pa.array([row.tobytes() for row in total], pa.binary())], ["key", "part", "vector"])
    return run


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order) with L @ L.T = a[order][:, order]; as many columns as the rank."""
    a, d = a.copy(), len(a)
    order, factor = np.arange(d), np.zeros((d, d))
    least = d * np.finfo(float).eps * a.diagonal().max(initial=0)
    for k in range(d):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if a[p, p] <= least:
            return factor[:, :k], order
        for t in (a, factor):
            t[[k, p]] = t[[p, k]]
        a[:, [k, p]] = a[:, [p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k:, k] = a[k:, k] / np.sqrt(a[k, k])
        a[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return factor, order


def rounds(r: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of r columns, in rounds of disjoint pairs (a round-robin)."""
    ring, out = list(range(r + r % 2)), []
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = [(a, b) for a, b in zip(ring[:half], ring[:half - 1:-1]) if a < r and b < r]
        out.append(tuple(np.array(pairs, dtype=np.int64).reshape(-1, 2).T))
        ring[1:] = ring[-1:] + ring[1:-1]
    return out


def jacobi(factor: np.ndarray) -> np.ndarray:
    """The columns of ``factor``, rotated until they are orthogonal."""
    m, turns = factor.copy(), rounds(factor.shape[1])
    for _ in range(SWEEPS):
        worst = 0.0
        for i, j in turns:
            a, b = m[:, i], m[:, j]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            norm = np.sqrt(aa * bb)
            off = np.abs(ab) > np.finfo(float).eps * norm
            worst = max(worst, (np.abs(ab)[off] / norm[off]).max(initial=0))
            safe = np.where(off, ab, 1.0)
            z = (bb - aa) / (2 * safe)
            t = np.where(z >= 0, 1.0, -1.0) / (np.abs(z) + np.hypot(1, z))
            c = np.where(off, 1 / np.sqrt(1 + t * t), 1.0)
            s = np.where(off, t * c, 0.0)
            m[:, i], m[:, j] = c * a - s * b, s * a + c * b
        if worst <= factor.shape[0] * np.finfo(float).eps:
            break
    return m


def eigen(scattered: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues of scatter / n, and their unit vectors as columns."""
    factor, order = pivoted_cholesky(scattered)
    m = jacobi(factor)
    norms = np.sqrt((m * m).sum(axis=0))
    by = np.argsort(-norms, kind="stable")
    vectors = np.empty_like(m)
    vectors[order] = m[:, by] / norms[by]
    top = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])] if m.size else np.zeros(0)
    return norms[by] ** 2 / n, vectors * np.where(top < 0, -1.0, 1.0)


@dataclass
class Whitening:
    centre: Centre
    values: np.ndarray                # eigenvalues of the components
    vectors: np.ndarray               # components as columns
    explained: np.ndarray
    identity_error: float = 0.0

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.centre(x) @ self.vectors / np.sqrt(self.values)


def moments(model, d: int):
    """Vectors to the sums and products of their whitened values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        total = np.zeros((k + 1, k))
        for x in matrices(batches, d):
            w = model(x)
            total[0] += w.sum(axis=0)
            total[1:] += w.T @ w
        yield pa.RecordBatch.from_arrays(
            [pa.array([0], pa.int64()), pa.array([TaskContext.get().partitionId()], pa.int64()),
             pa.array([total.tobytes()], pa.binary())], ["key", "part", "vector"])
    return run


VECTORS = "key long, part long, vector binary"


def fit(rows: DataFrame, d: int, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the distinct vectors ``x`` of d entries; None without variance."""
    listed = common.materialize(rows.select("x").distinct(), "whitening-list")
    n, parts = listed.count(), listed.rdd.getNumPartitions()
    if not n or not d:
        return None
    sums = (listed.mapInArrow(totals(d), "dimension int, total decimal(38,0)")
            .groupBy("dimension").agg(F.sum("total").alias("total")).orderBy("dimension").collect())   # d rows
    centre = Centre(n, [int(r.total) for r in sums])
    stored = common.tree_sum(listed.mapInArrow(scatter(centre, d), VECTORS), parts, "<f8").orderBy("key").collect()
    matrix_ = np.stack([np.frombuffer(r.vector, "<f8") for r in stored])                               # d by d
    values, vectors = eigen((matrix_ + matrix_.T) / 2, n)
    k = min(components, len(values))
    if not k:
        return None
    model = Whitening(centre, values[:k], vectors[:, :k], values[:k] * n / matrix_.trace())
    [own] = common.tree_sum(listed.mapInArrow(moments(model, d), VECTORS), parts, "<f8").collect()
    first, *second = np.frombuffer(own.vector, "<f8").reshape(k + 1, k) / n
    model.identity_error = float(np.abs(np.array(second) - np.outer(first, first) - np.eye(k)).max())
    return model


def projected(model, d: int, n_carry: int):
    """(carried columns..., x) to one row per vector and component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        k = len(m.values)
        for whole in batches:
            for b in (whole.slice(lo, ROWS) for lo in range(0, whole.num_rows, ROWS)):
                x = matrix(b.column(n_carry), d)
                take = pa.array(np.repeat(np.arange(len(x)), k))
                each = [np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)), np.full(len(x) * k, m.centre.n),
                        pa.array(m.centre.deviation(x), pa.int64()).take(take), m(x).ravel(),
                        np.tile(m.explained, len(x)), np.full(len(x) * k, m.identity_error)]
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(i).take(take) for i in range(n_carry)], *[pa.array(e) for e in each]],
                    [*b.schema.names[:n_carry], *[f.name for f in FIELDS]])
    return run


FIELDS = [T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
          T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
          T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())]


def whiten(vectors: DataFrame, carry: list[str], column: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE) -> DataFrame:
    """One row per vector and component: ``carry`` columns, component, n,
    deviation, whitened, explained and identity_error."""
    spark = vectors.sparkSession
    names = {f"_c{i}": c for i, c in enumerate(carry)}
    rows = quantized(vectors, column, carry, scale)
    length = F.size("x")
    common_ = (rows.groupBy(length.alias("d")).agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.desc("n"), F.desc("d")).limit(1).collect())
    d = common_[0].d if common_ else 0
    rows = rows.filter(length == d)
    model = fit(rows, d, components)
    schema = T.StructType([T.StructField(k, vectors.schema[c].dataType) for k, c in names.items()] + FIELDS)
    if model is None:
        return spark.createDataFrame([], schema).withColumnsRenamed(names)
    return rows.mapInArrow(projected(spark.sparkContext.broadcast(model), d, len(carry)),
                           schema).withColumnsRenamed(names)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(common.table(spark, sf_dir, "embeddings"), ["vec_id"])
