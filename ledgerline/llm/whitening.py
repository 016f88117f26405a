"""Embedding whitening by spectral divide and conquer.

Every entry c of a vector becomes the whole number x = floor(1024 * c) + 100000.
Two passes over the vectors give the exact moments of all of them: first the
sums S of every dimension, then the products of y = x - m, where m is the whole
number next to the mean S / n. The products are whole numbers too, summed
exactly in tasks and as DECIMAL(38) between them, so the covariance does not
depend on how rows are dealt and is rounded once, at its end.

The covariance is small (dimension squared, at most ``MAX_DIM``) and is split on
the driver: the polar factor of the matrix less a shift, found by the QDWH
iteration, is +1 on the invariant subspace above the shift and -1 below, so
(I + U) / 2 projects on the upper one. An orthonormal basis of both subspaces
turns the matrix into two blocks, and the blocks that hold leading components
are split again until they are diagonal. The components, of the same bounded
size, go to all tasks, which whiten the rows where they are. A last pass sums
the whitened products of all rows and reports how far they are from the identity.

Defined results: rows whose vector is null or empty, or holds a null, NaN or
infinite entry, or one beyond 2**40 (its x would not leave room for exact sums),
are dropped; so are vectors of another length than most have (of equally
frequent lengths the longest counts). Repeated rows, rows with equal ids and
rows with a null id each count and each come back. A component without variance
(at most 1e-13 of the total) is left out, so constant vectors, a single vector
and an empty table give no rows. ``deviation`` is null where it exceeds a long.
Other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.common import written

SCALE, LIFT = 1024, 100_000
LARGEST = 2.0**40
MAX_DIM = 4096
ROWS = 4096  # products of so many rows of 20-bit limbs are exact in a double
LIMB = 20
EPS = np.finfo(float).eps


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that have a vector of finite entries."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    return vectors.select(F.col(id_col).alias("id"), v.alias("v")).filter((F.size("v") > 0) & fine)


def _whole(batch: pa.RecordBatch, dim: int | None = None):
    """(rows, x) of the vectors of one length in a batch, in pieces of ROWS rows;
    all lengths in turn where ``dim`` is None."""
    v = batch.column(batch.schema.get_field_index("v"))
    n = v.value_lengths().to_numpy(zero_copy_only=False)
    flat = v.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(n, dtype=np.int64) - n
    for length in np.unique(n) if dim is None else [dim]:
        rows = np.flatnonzero(n == length)
        for k in range(0, len(rows), ROWS):
            at = rows[k:k + ROWS]
            c = flat[starts[at][:, None] + np.arange(length)]
            yield at, np.floor(c * SCALE).astype(np.int64) + LIFT


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(x)) for x in values], pa.decimal128(38))


def _sums(batches):
    """A row for each length and dimension that a task meets: rows and sum."""
    total: dict[int, list] = {}
    for batch in batches:
        for at, x in _whole(batch):
            own = total.setdefault(x.shape[1], [0, np.zeros(x.shape[1], object)])
            own[0] += len(at)
            own[1] += x.sum(0).astype(object)
    for length, (n, s) in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([length] * length, pa.int32()), pa.array(range(length), pa.int32()),
             pa.array([n] * length, pa.int64()), _decimals(s)], names=["length", "dim", "n", "s"])


def exact_products(y: np.ndarray) -> np.ndarray:
    """y.T @ y of whole numbers as Python integers, through products of limbs
    that doubles hold exactly; one limb is enough below 2**LIMB."""
    limbs, rest = [], y
    while True:
        rest, low = (np.zeros_like(rest), rest) if np.abs(rest).max(initial=0) < 1 << LIMB else (rest >> LIMB, rest & (1 << LIMB) - 1)
        limbs.append(low.astype(float))
        if not rest.any():
            break
    out = np.zeros((y.shape[1], y.shape[1]), object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            out += (a.T @ b).astype(np.int64).astype(object) << LIMB * (i + j)
    return out


def _products(dim: int, mid: np.ndarray):
    """Of a task's rows: the sums of the products of x - mid, a row for each pair of dimensions."""
    def run(batches):
        total = np.zeros((dim, dim), object)
        for batch in batches:
            for _, x in _whole(batch, dim):
                total += exact_products(x - mid)
        i, j = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays([pa.array((i * dim + j).astype(np.int32)), _decimals(total[i, j])], names=["pair", "s"])
    return run


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix: dynamically weighted
    Halley steps, by QR while the weights are large and by a linear solve after."""
    eye, x, low = np.eye(len(a)), a / np.linalg.norm(a), EPS / 2
    for _ in range(20):
        d = np.cbrt(4 * (1 - low * low) / low**4)
        p = np.sqrt(1 + d) + np.sqrt(8 - 4 * d + 8 * (2 - low * low) / (low * low * np.sqrt(1 + d))) / 2
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        if r > 100:
            o = np.linalg.qr(np.vstack([np.sqrt(r) * x, eye]))[0]
            new = q / r * x + (p - q / r) / np.sqrt(r) * o[:len(a)] @ o[len(a):].T
        else:
            new = q / r * x + (p - q / r) * np.linalg.solve(eye + r * x @ x, x)
        new = (new + new.T) / 2
        low = min(1.0, low * (p + q * low * low) / (1 + r * low * low))
        moved, x = np.linalg.norm(new - x), new
        if moved < 1e-11 and 1 - low < 1e-8:
            break
    return x


def _halves(a: np.ndarray, shift: float) -> tuple[int, np.ndarray, float] | None:
    """(rank, basis, coupling): the first ``rank`` columns of the basis span the
    components above the shift; coupling is what the basis leaves between both."""
    m = len(a)
    moved = a - shift * np.eye(m)
    if not moved.any():
        return None
    upper = (np.eye(m) + polar(moved)) / 2
    k = round(np.trace(upper))
    if not 0 < k < m:
        return None
    # bases of the projector's range and of its complement, by two sweeps over random starts
    start = np.linalg.qr(np.random.default_rng(m).standard_normal((m, m)))[0]
    for _ in range(2):
        start = np.linalg.qr(np.hstack([upper @ start[:, :k], start[:, k:] - upper @ start[:, k:]]))[0]
    return k, start, np.linalg.norm(start[:, :k].T @ a @ start[:, k:])


def components(a: np.ndarray, most: int, scale: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of a symmetric matrix, falling, and their
    unit eigenvectors as columns, by spectral divide and conquer."""
    m, scale = len(a), np.linalg.norm(a) if scale is None else scale
    diagonal = np.diag(a)
    if m == 1 or np.linalg.norm(a - np.diag(diagonal)) <= 2 * EPS * scale:
        order = np.argsort(-diagonal, kind="stable")[:most]
        return diagonal[order], np.eye(m)[:, order]
    best, spread = None, diagonal.max() - diagonal.min() or np.abs(a).max()
    # eigenvalues lie on both sides of their mean; the others avoid one that is too near
    for shift in (np.median(diagonal), diagonal.mean(), *(diagonal.mean() + f * spread for f in (0.07, -0.07, 0.31, -0.31))):
        found = _halves(a, shift)
        if found and (best is None or found[2] < best[2]):
            best = found
        if best and best[2] <= 50 * EPS * scale:
            break
    if best is None:  # equal to rounding
        order = np.argsort(-diagonal, kind="stable")[:most]
        return diagonal[order], np.eye(m)[:, order]
    k, basis, _ = best
    values, vectors = [], []
    for own, wanted in ((basis[:, :k], min(most, k)), (basis[:, k:], most - k)):
        if wanted > 0:
            block = own.T @ a @ own
            e, v = components((block + block.T) / 2, wanted, scale)
            values.append(e), vectors.append(own @ v)
    return np.concatenate(values), np.hstack(vectors)


@dataclass(frozen=True)
class Whitening:
    """What whitening needs of all vectors; its size depends on ``dim`` alone."""

    n: int
    dim: int
    mid: np.ndarray       # whole numbers next to the mean
    rest: np.ndarray      # S - n * mid, whole
    values: np.ndarray    # eigenvalues, falling
    vectors: np.ndarray   # unit eigenvectors, in columns
    trace: float

    @property
    def matrix(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mid) - self.rest / self.n) @ self.matrix


def fit(vectors: DataFrame, most: int) -> Whitening | None:
    """Moments and leading components of all usable vectors; None without any."""
    sums = written(vectors.select("v").mapInArrow(_sums, "length int, dim int, n long, s decimal(38,0)"), "vector-sums")
    top = sums.filter("dim = 0").groupBy("length").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    if top is None:
        return None
    n, dim = top.n, top.length
    if dim > MAX_DIM:
        raise ValueError(f"vectors have {dim} entries; a covariance of at most {MAX_DIM} is split on the driver")
    s = np.zeros(dim, object)
    for r in sums.filter(F.col("length") == dim).groupBy("dim").agg(F.sum("s").cast("decimal(38,0)").alias("s")).collect():
        s[r.dim] = int(r.s)
    mid = np.array([(2 * x + n) // (2 * n) for x in s], np.int64)
    rest = s - n * mid.astype(object)
    products = vectors.select("v").mapInArrow(_products(dim, mid), "pair int, s decimal(38,0)").groupBy("pair").agg(
        F.sum("s").cast("decimal(38,0)").alias("s")).toPandas()
    v = np.zeros((dim, dim))
    for pair, total in zip(products["pair"], products["s"]):
        i, j = divmod(int(pair), dim)
        v[i, j] = v[j, i] = (n * int(total) - rest[i] * rest[j]) / (n * n)
    if not v.any():
        return None
    values, vectors_ = components(v, min(most, dim))
    kept = values > 1e-13 * np.trace(v)
    return Whitening(n, dim, mid, rest.astype(np.int64), values[kept], vectors_[:, kept], float(np.trace(v)))


def _whitened_sums(model: Whitening):
    def run(batches):
        k = len(model.values)
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            for _, x in _whole(batch, model.dim):
                w = np.hstack([model.whiten(x), np.ones((len(x), 1))])
                total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range((k + 1) ** 2), pa.int32()), pa.array(total.ravel())], names=["at", "s"])
    return run


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest entry of (covariance of the whitened rows - identity), without sign."""
    k, total = len(model.values), {r.at: r.s for r in vectors.select("v").mapInArrow(
        _whitened_sums(model), "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).collect()}
    s = np.array([total[i] for i in range((k + 1) ** 2)]).reshape(k + 1, k + 1) / model.n
    return float(np.abs(s[:k, :k] - np.outer(s[:k, k], s[k, :k]) - np.eye(k)).max())


def deviations(x: np.ndarray, model: Whitening) -> pa.Array:
    """Sum over the dimensions of (n*x - S)**2, exact; null beyond a long."""
    y = x - model.mid
    most = model.n * (int(np.abs(y).max(initial=0)) + 1)
    if most * most * model.dim < 2**63:
        return pa.array(((model.n * y - model.rest) ** 2).sum(1))
    exact = ((model.n * y.astype(object) - model.rest.astype(object)) ** 2).sum(1)
    return pa.array([int(e) if e < 2**63 else None for e in exact], pa.int64())


def whiten(vectors: DataFrame, most: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each usable row and component up to ``most``: the id, component
    (from 1), n, deviation, whitened, explained, identity_error."""
    rows = usable(vectors, id_col, vector_col)
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"{id_col} {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(rows, most)
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    shared = vectors.sparkSession.sparkContext.broadcast((model, identity_error(rows, model)))

    def run(batches):
        own, error = shared.value
        k = len(own.values)
        for batch in batches:
            for at, x in _whole(batch, own.dim):
                each = pa.array(np.repeat(np.arange(len(at)), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                     pa.array(np.full(len(each), own.n)), deviations(x, own).take(each), pa.array(own.whiten(x).ravel()),
                     pa.array(np.tile(own.values / own.trace, len(at))), pa.array(np.full(len(each), error))],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
