"""Whitening of embeddings by a bidiagonal qd solver (operator 11).

Entries become whole numbers x = floor(1024 c) + 100000, so sums over all rows are exact. Every task centres its rows
(x - S / n, from whole numbers, rounded once), takes them in blocks and folds each into an upper triangle by QR; the
tasks' triangles are folded by QR again in a tree of Spark jobs, until one triangle R of d x d is left, with R'R the centred
rows' product. No covariance matrix is formed, so no digits are lost by squaring.

The driver solves R, whose size is set by the dimensions and not by the rows: Householder reflections make it bidiagonal,
dqds with shifts that are lower bounds finds the singular values to high relative accuracy, and each direction is the null
vector of a twisted factorisation, begun where the twist's pivot is least and polished by inverse iteration with the same factors. Directions of
values that agree to three digits are kept orthogonal. A direction's sign makes its largest entry positive.

Vectors that are null, or hold null, NaN or infinite entries, are left out, and so are vectors of another length than the most
frequent (of equally frequent ones the longest). Entries beyond ``LARGEST`` in size count as that. Directions without variance up to rounding
have no component, so there may be fewer than asked for; without any vector there are none and no rows. Equal rows, null ids and
repeated ids are rows like others. Other columns stay whatever their names; the struct replaces a column of its name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import shared

COMPONENTS = 8
SCALE, SHIFT = 1024.0, 100_000
LARGEST = float(1 << 30)
#: Rows of one block, and triangles folded by one task of the tree.
BLOCK_ROWS, FAN_IN = 4096, 16

EPS = float(np.finfo(float).eps)
WHITENED = "deviation decimal(38,0), whitened array<double>"


@dataclass(frozen=True)
class Model:
    """n vectors of d entries with sums S: d x k directions with their variances, and the trace of all."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(v) / self.trace for v in self.variances]


def usable(vector: Column) -> Column:
    """Whether a vector and all its entries are there and finite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def _whole(column: pa.Array, d: int) -> np.ndarray:
    """The vectors as whole numbers, a row each."""
    flat = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    return np.floor(SCALE * np.clip(flat, -LARGEST, LARGEST)).astype(np.int64).reshape(-1, d) + SHIFT


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for low in range(0, len(batch), max(BLOCK_ROWS, 2 * d)):
            yield _whole(batch.column(0).slice(low, max(BLOCK_ROWS, 2 * d)), d)


def _offset(sums: tuple[int, ...], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole part and remainder (of n) of the means."""
    return np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)


def centred(x: np.ndarray, sums: tuple[int, ...], n: int) -> np.ndarray:
    """x - S / n, each entry rounded once from whole numbers."""
    whole, rest = _offset(sums, n)
    return (x - whole).astype(float) - rest / n


def _totals(vectors: DataFrame, d: int) -> tuple[int, tuple[int, ...]]:
    """Number and exact sums of the vectors."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _blocks(batches, d):
            at = pa.array(range(-1, d), pa.int32())
            yield pa.record_batch([at, pa.array(np.append(len(x), x.sum(axis=0)))], ["at", "total"])

    totals = vectors.mapInArrow(partial, "at int, total long").groupBy("at")
    by = dict(totals.agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())
    return int(by[-1]), tuple(int(by[i]) for i in range(d))


def _fold(parts: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(parts), mode="r")


def triangle(vectors: DataFrame, d: int, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """The upper triangle of the centred vectors, folded block by block and then in a tree."""

    def fold_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for x in _blocks(batches, d):
            r = _fold([r, centred(x, sums, n)])
        if len(r):
            part = TaskContext.get().partitionId()
            yield pa.record_batch([pa.array([part], pa.int64()), pa.array([r.ravel()])], ["part", "r"])

    def fold_parts(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        r = _fold([np.array(r).reshape(-1, d) for r in table["r"].to_pylist()])
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "r": pa.array([r.ravel()], pa.list_(pa.float64()))})

    parts = shared.stored(vectors.mapInArrow(fold_rows, "part long, r array<double>"))
    while parts.agg(F.max("part")).first()[0]:
        up = F.floor(F.col("part") / FAN_IN).cast("long").alias("up")
        parts = shared.stored(parts.groupBy(up).applyInArrow(fold_parts, "part long, r array<double>"))
    return np.array(parts.first().r).reshape(-1, d)


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """(v, beta, alpha): x - beta v (v'x) is alpha times the first unit vector."""
    norm = float(np.linalg.norm(x))
    if norm == 0 or not np.any(x[1:]):
        return np.zeros(len(x)), 0.0, float(x[0])
    alpha = -norm if x[0] > 0 else norm
    v = x.copy()
    v[0] -= alpha
    return v, 2.0 / float(v @ v), alpha


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V): r = U B V' by Householder reflections from both sides."""
    d = r.shape[1]
    a = np.zeros((d, d))
    a[: len(r)] = r
    right = np.eye(d)
    diagonal, above = np.zeros(d), np.zeros(max(d - 1, 0))
    for i in range(d):
        v, beta, diagonal[i] = _reflector(a[i:, i])
        a[i:, i:] -= beta * np.outer(v, v @ a[i:, i:])
        if i + 1 < d:
            v, beta, above[i] = _reflector(a[i, i + 1 :])
            a[i:, i + 1 :] -= beta * np.outer(a[i:, i + 1 :] @ v, v)
            right[:, i + 1 :] -= beta * np.outer(right[:, i + 1 :] @ v, v)
    return diagonal, above, right


def _lower_bound(q: list[float], e: list[float]) -> float:
    """A lower bound of the least eigenvalue: the inverse's trace is the sum of the reciprocals of dqd's d."""
    d, total = q[0], 0.0
    for i in range(len(q)):
        if d <= 0:
            return 0.0
        total += 1.0 / d
        if i + 1 < len(q):
            d *= q[i + 1] / (d + e[i])
    return (1.0 - 4 * EPS * len(q)) / total


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One differential qd step with a shift, or None if the shift was above the least eigenvalue."""
    d = q[0] - shift
    to_q, to_e = [], []
    for i in range(len(e)):
        if d < 0:
            return None
        top = d + e[i]
        ratio = q[i + 1] / top
        to_q.append(top)
        to_e.append(e[i] * ratio)
        d = d * ratio - shift
    return None if d < 0 else (to_q + [d], to_e)


def qd_values(q: list[float], e: list[float]) -> list[float]:
    """The eigenvalues of B'B, falling, for a bidiagonal B with squared diagonal q and squared superdiagonal e, by dqds."""
    found: list[float] = []
    todo = [(list(map(float, q)), list(map(float, e)), 0.0)]
    tiny = EPS * EPS
    while todo:
        q, e, moved = todo.pop()
        while q:
            if len(q) == 1:
                found.append(q.pop() + moved)
                break
            if e[-1] <= tiny * (moved + q[-1]) or e[-1] <= tiny * tiny * q[-2]:
                found.append(q.pop() + moved)
                e.pop()
                continue
            cut = next((i for i in range(len(e) - 1) if e[i] <= tiny * (moved + min(q[i], q[i + 1]))), None)
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            shift = _lower_bound(q, e)
            stepped = _dqds(q, e, shift)
            while stepped is None:
                shift = 0.0 if shift <= EPS * (moved + q[0]) else shift * (1 - 0.25)
                stepped = _dqds(q, e, shift)
            (q, e), moved = stepped, moved + shift
    return sorted(found, reverse=True)


class Twisted:
    """The factors N D N' of B'B - value, twisted where the pivot is least."""

    def __init__(self, a: np.ndarray, b: np.ndarray, value: float):
        n = len(a)
        q, e, off = a * a, b * b, a[:-1] * b
        small = EPS * EPS * max(float(q.max()), float(e.max()) if n > 1 else 0.0, 1e-300)
        s, p = np.zeros(n), np.zeros(n)
        down, up = np.zeros(n), np.zeros(n)  # pivots of the two factorisations
        self.low, self.high = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
        s[0] = -value
        for i in range(n - 1):
            down[i] = q[i] + s[i] or small
            self.low[i] = off[i] / down[i]
            s[i + 1] = e[i] * s[i] / down[i] - value
        p[n - 1] = q[n - 1] - value
        for i in range(n - 2, -1, -1):
            up[i + 1] = e[i] + p[i + 1] or small
            self.high[i] = off[i] / up[i + 1]
            p[i] = p[i + 1] * q[i] / up[i + 1] - value
        gamma = s + p + value
        gamma[n - 1] = s[n - 1] + q[n - 1]
        self.at = int(np.argmin(np.abs(gamma)))
        self.pivots = np.concatenate([down[: self.at], [gamma[self.at] or small], up[self.at + 1 :]])

    def solve(self, rhs: np.ndarray) -> np.ndarray:
        n, at, w = len(rhs), self.at, rhs.astype(float).copy()
        for i in range(1, at + 1):
            w[i] -= self.low[i - 1] * w[i - 1]
        for i in range(n - 2, at - 1, -1):
            w[i] -= self.high[i] * w[i + 1]
        w /= self.pivots
        for i in range(at - 1, -1, -1):
            w[i] -= self.low[i] * w[i + 1]
        for i in range(at + 1, n):
            w[i] -= self.high[i - 1] * w[i - 1]
        return w

    def null_vector(self) -> np.ndarray:
        start = np.zeros(len(self.pivots))
        start[self.at] = self.pivots[self.at]
        return self.solve(start)


def _unit(z: np.ndarray) -> np.ndarray:
    z = z / np.abs(z).max()
    return z / np.linalg.norm(z)


def _vector(a: np.ndarray, b: np.ndarray, value: float, near: list[np.ndarray]) -> np.ndarray:
    """The unit eigenvector of B'B to a value, orthogonal to those of values near to it."""
    factors = Twisted(a, b, value)
    z = _unit(factors.null_vector())
    for attempt in range(4):
        for other in near + near:
            z = z - other * (other @ z)
        if np.linalg.norm(z) < 0.1:  # the same direction again
            z = np.cos(np.arange(len(a)) * (attempt + 1.7) + 1.0)
            for other in near + near:
                z = z - other * (other @ z)
        if attempt < 3:
            solved = factors.solve(_unit(z))
            if not np.all(np.isfinite(solved)):
                break
            z = _unit(solved)
    return _unit(z)


def principal(r: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as columns) of r'r: the largest eigenvalues that aren't rounding, falling."""
    d = r.shape[1]
    largest = float(np.abs(r).max()) if r.size else 0.0
    if largest == 0:
        return np.zeros(0), np.zeros((d, 0))
    a, b, right = bidiagonal(r / largest)
    b[np.abs(b) <= EPS / 4 * (np.abs(a[:-1]) + np.abs(a[1:]))] = 0.0
    ends = [*(np.flatnonzero(b == 0) + 1).tolist(), d]
    found = []
    for low, high in zip([0, *ends[:-1]], ends, strict=True):
        q, e = a[low:high] ** 2, b[low : high - 1] ** 2
        found += [(value, low, high) for value in qd_values(q.tolist(), e.tolist())]
    found.sort(key=lambda x: -x[0])
    found = [x for x in found[:components] if x[0] > found[0][0] * (d * 4 * EPS) ** 2]
    vectors: list[np.ndarray] = []
    for k, (value, low, high) in enumerate(found):
        near = [vectors[j][low:high] for j in range(k) if found[j][1] == low and found[j][0] - value <= 1e-3 * value]
        z = np.zeros(d)
        z[low:high] = _vector(a[low:high], b[low : high - 1], value, near)
        vectors.append(z)
    out = right @ np.array(vectors).T
    out *= np.where(out[np.abs(out).argmax(axis=0), np.arange(len(found))] < 0, -1.0, 1.0)
    return np.array([x[0] for x in found]) * largest * largest, out


def _vectors(frame: DataFrame, column: str) -> DataFrame:
    vector = F.col(shared.quoted(column))
    return frame.filter(usable(vector)).select(vector.alias("vector"))


def fit(frame: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Model | None:
    """The model of all usable vectors, None if there are none."""
    vectors = _vectors(frame, column)
    sizes = vectors.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    size = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    if size is None:
        return None
    d = size.d
    if d == 0:
        return Model(size.n, (), np.zeros((0, 0)), np.zeros(0), 0.0)
    vectors = vectors.filter(F.size("vector") == d)
    n, sums = _totals(vectors, d)
    r = triangle(vectors, d, n, sums)
    values, directions = principal(r, components)
    return Model(n, sums, directions, values / n, float((r * r).sum()) / n)


def _projected(x: np.ndarray, model: Model) -> np.ndarray:
    return centred(x, model.sums, model.n) @ (model.directions / np.sqrt(model.variances))


def _deviations(x: np.ndarray, model: Model) -> pa.Array:
    """The sum over all entries of (n x - S) ** 2, exact."""
    whole, rest = _offset(model.sums, model.n)
    t = x - whole
    most = int(np.abs(t).max(initial=0)) + 1
    if len(whole) * (model.n * most) ** 2 < 1 << 63:
        scaled = model.n * t - rest
        return pa.array((scaled * scaled).sum(axis=1)).cast(pa.decimal128(38, 0))
    scaled = model.n * t.astype(object) - rest.astype(object)
    return pa.array([Decimal(int(v)) for v in (scaled * scaled).sum(axis=1)], pa.decimal128(38, 0))


def whiten(frame: DataFrame, model: Model | None, column: str = "embedding", into: str = "whitening") -> DataFrame:
    """The rows whose vector the model is for, all columns, and a struct WHITENED."""
    kept = [shared.quoted(c) for c in frame.columns if c != into]
    vector = F.col(shared.quoted(column))
    d = len(model.sums) if model else -1
    rows = frame.filter(usable(vector) & (F.size(vector) == d))

    @F.arrow_udf(WHITENED)
    def apply(vectors: pa.Array) -> pa.Array:
        if isinstance(vectors, pa.ChunkedArray):
            vectors = vectors.combine_chunks()
        x = _whole(vectors, d) if d else np.zeros((len(vectors), 0), np.int64)
        w = _projected(x, model)
        ends = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
        return pa.StructArray.from_arrays(
            [_deviations(x, model), pa.ListArray.from_arrays(ends, pa.array(w.ravel()))], ["deviation", "whitened"]
        )

    return rows.select(*kept, apply.asNondeterministic()(vector).alias(into))


def identity_error(frame: DataFrame, model: Model | None, column: str = "embedding") -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, over all rows of the fit."""
    k = len(model.variances) if model else 0
    if not k:
        return 0.0
    d = len(model.sums)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for x in _blocks(batches, d):
            w = _projected(x, model)
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        yield pa.record_batch([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["at", "total"])

    vectors = _vectors(frame, column).filter(F.size("vector") == d)
    sums = dict(vectors.mapInArrow(partial, "at int, total double").groupBy("at").agg(F.sum("total")).collect())
    total = np.array([sums[i] for i in range((k + 1) * k)]).reshape(k + 1, k) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())
