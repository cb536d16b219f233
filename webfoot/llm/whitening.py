"""Whitening of embeddings: distributed covariance, own eigenvectors, broadcast projection.

1. Components become integers, ``floor(scale * c) + shift``; the *fit list* holds
   each distinct integer vector once.
2. Spark sums the fit list, then the centred products: a task adds up one
   ``d x d`` matrix of its vectors, whose rows are summed by row number.
3. The driver gets that matrix (``d * d`` doubles, whatever the table) and takes
   it to tridiagonal form by Householder reflections, finds the leading
   eigenvalues by bisection on Sturm counts, their vectors by inverse iteration,
   orthogonalised again within clusters of close eigenvalues, and turns them back.
4. Mean and components (``d`` times ``TOP`` doubles) go to the tasks, which
   project every row.  A last pass measures the covariance of the projected fit list.

Vectors of different dimensions are different spaces, each with its own fit.

Precision: vectors are centred on the rounded mean in integers first, then by the
rest of the mean (below one half), so large shifts cost no digits.

Defined cases: rows whose vector is null or holds null or non-finite entries are
left out, as are entries whose integer does not fit a long and empty vectors; null
and repeated ids are rows like others; a space has at most as many components as
it has directions of variance (eigenvalues above ``LEAST`` of the largest), none
when its vectors are all equal: such rows return nothing; a deviation that does
not fit a long is null; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webfoot.llm.common import col, discard, materialize

SCALE = 64.0
SHIFT = 1_000_000
TOP = 16
LEAST = 1e-11  # of the largest eigenvalue; rounding makes smaller ones out of nothing
CLUSTER = 1e-3  # of the matrix's norm: closer eigenvalues share a cluster
ROWS = 1024  # vectors that are widened to doubles at once
_EPS = np.finfo(float).eps


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit Householder vectors that lead there from the symmetric ``v``."""
    a, n, reflectors = v.copy(), len(v), []
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        norm = np.linalg.norm(x)
        if norm > 0:
            x[0] += np.copysign(norm, x[0])
            x /= np.linalg.norm(x)
            block = a[k + 1:, k + 1:]
            p = block @ x
            w = 2 * (p - (x @ p) * x)
            block -= np.outer(x, w) + np.outer(w, x)
            a[k + 1, k] = -np.copysign(norm, a[k + 1, k])
        reflectors.append(x)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def turned_back(vectors: np.ndarray, reflectors: list[np.ndarray]) -> np.ndarray:
    """Eigenvectors (columns) of the tridiagonal form as those of the matrix itself."""
    out = vectors.copy()
    for k in range(len(reflectors) - 1, -1, -1):
        x = reflectors[k]
        out[k + 1:] -= 2 * np.outer(x, x @ out[k + 1:])
    return out


def sturm_count(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The number of eigenvalues below each of the places ``at``."""
    least = np.finfo(float).tiny * max(1.0, float((off ** 2).max(initial=0.0)))
    count, q = np.zeros(len(at), np.int64), None
    for i in range(len(diagonal)):
        q = diagonal[i] - at - (off[i - 1] ** 2 / q if i else 0.0)
        q = np.where(np.abs(q) < least, -least, q)  # a zero pivot counts as just below
        count += q < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected until its bracket cannot shrink."""
    n = len(diagonal)
    reach = np.append(np.abs(off), 0) + np.append(0, np.abs(off))
    norm = max(float(np.abs(diagonal).max() + reach.max()), np.finfo(float).tiny)
    low, high = np.full(k, float((diagonal - reach).min()) - norm * _EPS * n), np.full(k, float((diagonal + reach).max()) + norm * _EPS * n)
    below = n - np.arange(k)  # the j-th largest has n - 1 - j eigenvalues below it
    for _ in range(200):
        middle = (low + high) / 2
        if np.all((middle <= low) | (middle >= high) | (high - low <= 2 * _EPS * np.abs(middle))):
            break
        above = sturm_count(diagonal, off, middle) >= below
        high, low = np.where(above, middle, high), np.where(above, low, middle)
    return (low + high) / 2


class _Shifted:
    """The tridiagonal matrix minus a shift, factored with row exchanges."""

    def __init__(self, diagonal, off, shift, least):
        n = len(diagonal)
        d, self.up, self.up2 = (diagonal - shift).tolist(), off.tolist() + [0.0], [0.0] * n
        self.swap, self.factor, low = [False] * n, [0.0] * n, off.tolist()
        for i in range(n - 1):
            if abs(low[i]) > abs(d[i]):  # the row below has the larger pivot
                self.swap[i] = True
                f = d[i] / low[i]
                d[i], above, next_, beyond = low[i], self.up[i], d[i + 1], self.up[i + 1]
                self.up[i], self.up2[i] = next_, beyond
                d[i + 1], self.up[i + 1] = above - f * next_, -f * beyond
            else:
                if abs(d[i]) < least:
                    d[i] = least
                f = low[i] / d[i]
                d[i + 1] -= f * self.up[i]
            self.factor[i] = f
        if abs(d[-1]) < least:
            d[-1] = least
        self.pivot = d

    def solve(self, right: np.ndarray) -> np.ndarray:
        x, n = right.tolist(), len(right)
        for i in range(n - 1):
            if self.swap[i]:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= self.factor[i] * x[i]
        for i in range(n - 1, -1, -1):
            s = x[i]
            if i + 1 < n:
                s -= self.up[i] * x[i + 1]
            if i + 2 < n:
                s -= self.up2[i] * x[i + 2]
            x[i] = s / self.pivot[i]
            if abs(x[i]) > 1e150:  # only the direction counts
                x = [y * 1e-150 for y in x]
        return np.array(x)


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) for the eigenvalues ``values``, falling; clusters are kept orthogonal."""
    n = len(diagonal)
    norm = float(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0.0)) or 1.0
    out, first, rng = np.zeros((n, len(values))), 0, np.random.default_rng(1)
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            first = j
        shifted = _Shifted(diagonal, off, value - 2 * (j - first) * _EPS * norm, _EPS * norm)
        x = rng.standard_normal(n)
        for _ in range(8):
            before = x / np.linalg.norm(x)
            x = shifted.solve(before)
            x /= np.abs(x).max()
            for _ in range(2):  # once more, for what rounding left
                held = out[:, first:j]
                x = x - held @ (held.T @ x)
            x /= np.linalg.norm(x)
            if min(np.linalg.norm(x - before), np.linalg.norm(x + before)) <= 4 * _EPS * n ** 0.5:
                break
        out[:, j] = x
    return out


def leading_components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``k`` largest eigenvalues of the covariance ``v``, falling, and their unit vectors (columns)."""
    scale = float(np.abs(v).max())
    if not scale > 0:
        return np.zeros(0), np.zeros((len(v), 0))
    diagonal, off, reflectors = tridiagonal(v / scale)
    values = leading_eigenvalues(diagonal, off, min(k, len(v)))
    values = values[values > LEAST * values[0]]
    vectors = turned_back(inverse_iteration(diagonal, off, values), reflectors)
    return values * scale, vectors


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: float, shift: int) -> DataFrame:
    """``(vec_id, dim, x)`` of the rows that take part."""
    scaled = F.transform(col(vector_col).cast("array<double>"), lambda c: F.floor(c * scale))
    fits = F.forall(col(vector_col).cast("array<double>"), lambda c: F.coalesce(
        ~F.isnan(c) & (F.abs(c * scale) < F.lit(float(1 << 62))), F.lit(False)))
    return (vectors.where(col(vector_col).isNotNull() & (F.size(col(vector_col)) > 0)).where(fits)
            .select(col(id_col).cast("long").alias("vec_id"), F.size(col(vector_col)).alias("dim"),
                    F.transform(scaled, lambda c: c + F.lit(shift)).alias("x")))


def _spaces(batches, dim_at: int, x_at: int):
    """``(dimension, positions in the batch, rows of integers)``, some rows at a time."""
    for batch in batches:
        dims = batch.column(dim_at).to_numpy()
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            x = batch.column(x_at).take(pa.array(at)).flatten().to_numpy().reshape(-1, d)
            for lo in range(0, len(at), ROWS):
                yield batch, int(d), at[lo:lo + ROWS], x[lo:lo + ROWS]


def sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """For each dimension the number of vectors and their exact sums."""
    def run(batches):
        held: dict[int, list] = {}
        for _, d, _, x in _spaces(batches, 0, 1):
            count, total = held.get(d, (0, np.zeros(d, object)))
            small = np.abs(x).max() < 1 << 52  # ROWS of them fit a long
            held[d] = count + len(x), total + (x.sum(axis=0) if small else x.astype(object).sum(axis=0))
        for d, (count, total) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d], pa.int32()), pa.array([count], pa.int64()),
                 pa.array([[Decimal(int(t)) for t in total]], pa.list_(pa.decimal128(38, 0)))], names=["dim", "n", "s"])

    parts = fit.select("dim", "x").mapInArrow(run, "dim int, n long, s array<decimal(38,0)>")
    cells = parts.select("dim", "n", F.posexplode("s").alias("i", "s")).groupBy("dim", "i").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("dim", "i").collect()  # one row a dimension of the vectors
    out: dict[int, tuple[int, list[int]]] = {}
    for r in cells:
        out.setdefault(r["dim"], (r["n"], []))[1].append(int(r["s"]))
    return out


class Mean(NamedTuple):
    """The mean as a whole number and the rest of it, below one half."""
    n: int
    whole: np.ndarray
    rest: np.ndarray  # n times the rest, as integers

    @classmethod
    def of(cls, n: int, total: list[int]) -> Mean:
        whole = [(2 * s + n) // (2 * n) for s in total]
        return cls(n, np.array(whole, np.int64), np.array([s - n * w for s, w in zip(total, whole)], object))

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - (self.rest / self.n).astype(np.float64)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The sum of ``(n * x - s) ** 2`` of each row, exact; null where it does not fit a long."""
        z = x - self.whole
        bound = self.n * (int(np.abs(z).max(initial=0)) + 1)
        if bound * bound * x.shape[1] < 1 << 63:
            t = self.n * z - self.rest.astype(np.int64)
            return (t * t).sum(axis=1).tolist()
        t = self.n * z.astype(object) - self.rest
        return [s if s < 1 << 63 else None for s in (t * t).sum(axis=1)]


def covariances(fit: DataFrame, means: dict[int, Mean]) -> dict[int, np.ndarray]:
    """The covariance of each space, divisor ``n``, centred before multiplying."""
    def products(batches):
        from pyspark import TaskContext
        held: dict[int, np.ndarray] = {}
        for _, d, _, x in _spaces(batches, 0, 1):
            y = means[d].centred(x)
            held[d] = held.get(d, 0.0) + y.T @ y
        for d, m in held.items():
            for lo in range(0, d, 64):
                rows = range(lo, min(lo + 64, d))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d] * len(rows), pa.int32()), pa.array(rows, pa.int32()),
                     pa.array([TaskContext.get().partitionId()] * len(rows), pa.int32()),
                     pa.array([m[i].tobytes() for i in rows], pa.binary())], names=["dim", "i", "task", "row"])

    def add(batches):
        key, total = None, None
        for batch in batches:
            out = []
            for d, i, row in zip(*(batch.column(c).to_pylist() for c in (0, 1, 3))):
                if (d, i) != key:
                    if key:
                        out.append((*key, total.tobytes()))
                    key, total = (d, i), np.zeros(d)
                total = total + np.frombuffer(row)
            yield _matrix_rows(out)
        if key:
            yield _matrix_rows([(*key, total.tobytes())])

    def _matrix_rows(out):
        columns = list(zip(*out)) or [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary()))],
                                          names=["dim", "i", "row"])

    parts = fit.select("dim", "x").mapInArrow(products, "dim int, i int, task int, row binary")
    rows = parts.repartition("dim", "i").sortWithinPartitions("dim", "i", "task").mapInArrow(
        add, "dim int, i int, row binary").collect()  # d rows of d doubles
    out: dict[int, np.ndarray] = {}
    for r in rows:
        out.setdefault(r["dim"], np.zeros((r["dim"], r["dim"])))[r["i"]] = np.frombuffer(r["row"])
    return {d: (m + m.T) / (2 * means[d].n) for d, m in out.items()}


class Space(NamedTuple):
    mean: Mean
    values: np.ndarray
    components: np.ndarray  # columns, unit vectors
    trace: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.mean.centred(x) @ self.components / np.sqrt(self.values)


def identity_errors(fit: DataFrame, spaces: dict[int, Space]) -> dict[int, float]:
    """The largest absolute entry of the whitened fit list's covariance minus the identity, for each space."""
    def added(centre: dict[int, np.ndarray] | None) -> dict[int, np.ndarray]:
        def run(batches):
            held: dict[int, np.ndarray] = {}
            for _, d, _, x in _spaces(batches, 0, 1):
                w = spaces[d].whitened(x)
                if centre is not None:
                    w = w - centre[d]
                held[d] = held.get(d, 0.0) + (w.sum(axis=0) if centre is None else (w.T @ w).ravel())
            for d, s in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([s.tolist()], pa.list_(pa.float64()))],
                                                 names=["dim", "s"])
        cells = fit.select("dim", "x").mapInArrow(run, "dim int, s array<double>").select(
            "dim", F.posexplode("s").alias("i", "s")).groupBy("dim", "i").agg(F.sum("s").alias("s")).orderBy("dim", "i").collect()
        out: dict[int, list] = {}
        for r in cells:
            out.setdefault(r["dim"], []).append(r["s"] / spaces[r["dim"]].mean.n)
        return {d: np.array(s) for d, s in out.items()}

    errors = {}
    for d, c in added(added(None)).items():
        k = len(spaces[d].values)
        errors[d] = float(np.abs(c.reshape(k, k) - np.eye(k)).max())
    return errors


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = SCALE,
           shift: int = SHIFT, top: int = TOP) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` for each row and component."""
    rows = materialize(integer_vectors(vectors, id_col, vector_col, scale, shift), "integer-vectors")
    fit = materialize(rows.select("dim", "x").distinct(), "fit-list")
    means = {d: Mean.of(n, total) for d, (n, total) in sums(fit).items()}
    spaces = {}
    for d, v in covariances(fit, means).items():
        values, components = leading_components(v, top)
        if len(values):
            spaces[d] = Space(means[d], values, components, float(np.trace(v)))
    errors = identity_errors(fit.where(F.col("dim").isin(list(spaces))), spaces) if spaces else {}
    discard(fit)

    def run(batches):
        for batch, d, at, x in _spaces(batches, 1, 2):
            space = spaces[d]
            shares = (space.values / space.trace).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array([space.mean.n] * len(at), pa.int64()),
                 pa.array(space.mean.deviation(x), pa.int64()),
                 pa.array(space.whitened(x).tolist(), pa.list_(pa.float64())),
                 pa.array([shares] * len(at), pa.list_(pa.float64())), pa.array([errors[d]] * len(at), pa.float64())],
                names=["vec_id", "n", "deviation", "w", "shares", "identity_error"])

    return (rows.where(F.col("dim").isin(list(spaces))).mapInArrow(
        run, "vec_id long, n long, deviation long, w array<double>, shares array<double>, identity_error double")
        .select("vec_id", "n", "deviation", F.posexplode("w").alias("i", "whitened"), "shares", "identity_error")
        .select("vec_id", (F.col("i") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
                F.get("shares", F.col("i")).alias("explained"), "identity_error"))
