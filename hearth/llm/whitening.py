"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Vectors are put on a lattice, ``x = floor(scale * c)``; the fit list holds each
distinct lattice vector once.  With ``A`` the fit list's rows less their mean,
the bidiagonalisation builds orthonormal ``v_1, v_2, ...`` and ``u_1, u_2,
...`` with

    alpha_k u_k = A v_k - beta_(k-1) u_(k-1)        beta_k v_(k+1) = A' u_k - alpha_k v_k

and the singular values of the small bidiagonal matrix of the alphas and betas
approach those of ``A``, the largest first.  The rows of ``A`` stay where they
are.  A left vector has an entry per row and is never stored: ``u_k = A w_k``
for a short ``w_k``, so one pass over the rows gives both products of a step
(each row's entry of ``A v`` is used at once for ``A' u``), and the inner
products that full reorthogonalisation needs are those of short vectors:
``<A p, u_j> = p . (A' u_j)``.

A start vector finds one direction of each eigenspace.  So when the leading
values have settled, the process starts anew with a direction orthogonal to
all before, until such a start brings no value among the leading ones; repeated
eigenvalues are found that way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import bound_batches, stored

COMPONENTS = 4
SCALE = 256
SETTLED = 1e-14          # residual of a singular value, of the largest one
NOTHING = 1e-12          # a singular value below this share of the largest is none
_EXACT = 2.0 ** 62       # integers up to here are summed as longs


@dataclass
class Whitening:
    """What is learned from the fit list: ``n`` distinct vectors, their exact sums, and the leading components."""

    n: int
    sums: list[int]
    components: np.ndarray       # (dimensions, components), unit columns
    eigenvalues: np.ndarray      # of the covariance, falling
    trace: float
    steps: int                   # passes over the rows that the bidiagonalisation took
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Lists of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def lattice(embeddings: DataFrame, vector: str = "embedding", scale: int = SCALE, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` and the lattice vector ``x`` of the rows whose vector is whole.

    Rows whose vector is null, empty, or holds a null or non-finite entry go.
    """
    entry = F.col(vector).cast("array<double>")
    whole = F.forall(entry, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))     # NaN is above infinity
    return (embeddings.where(F.coalesce(whole & (F.size(vector) > 0), F.lit(False)))
                      .select(*keep, F.transform(entry, lambda c: F.floor(c * scale)).alias("x")))


def _summed(df: DataFrame, task, width: int) -> np.ndarray:
    """The sum over all tasks of the ``width`` numbers that each makes of its rows: one short row a task is exchanged."""
    partial = df.mapInArrow(task, "v array<double>")
    row = partial.agg(*[F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(width)]).first()
    return np.array([0.0 if r is None else r for r in row])


def _sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Rows and exact sums per dimension; high and low halves are summed apart, so nothing overflows."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros((2, dims), object)
        for batch in batches:
            x = _matrix(batch.column(0))
            if len(x):
                n += len(x)
                total = total + np.array([(x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)]).astype(object)
        if n:
            exact = [Decimal(int(t)) for t in total[0] * 2 ** 32 + total[1]]
            yield pa.record_batch({"n": pa.array([n]), "s": pa.array([exact], pa.list_(pa.decimal128(38, 0)))})

    rows = fit.mapInArrow(task, "n long, s array<decimal(38,0)>")
    got = rows.agg(F.sum("n"), *[F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(dims)]).first()
    return int(got[0] or 0), [int(s or 0) for s in got[1:]]


def _products(fit: DataFrame, mean: np.ndarray, p: np.ndarray) -> tuple[float, np.ndarray, float]:
    """|A p|^2, A'A p and |A|^2 (the sum of all squares), in one pass over the centred rows."""
    d = len(mean)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(d + 2)
        for batch in batches:
            if batch.num_rows:
                a = _matrix(batch.column(0)) - mean
                y = a @ p
                out += np.r_[a.T @ y, y @ y, np.einsum("ij,ij->", a, a)]
        yield pa.record_batch({"v": pa.array([out.tolist()], pa.list_(pa.float64()))})

    got = _summed(fit, task, d + 2)
    return got[d], got[:d], got[d + 1]


def bidiagonalise(products, dims: int, rank: int, want: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray, int]:
    """The ``want`` largest singular values of ``A`` and their right vectors (columns), and the steps taken.

    ``products(p)`` gives ``|A p|^2`` and ``A'A p``; ``rank`` bounds A's rank.
    """
    rng = np.random.default_rng(seed)
    v, w, g = np.empty((dims, 0)), np.empty((dims, 0)), np.empty((dims, 0))    # v_k, w_k and A'u_k as columns
    alphas: list[float] = []
    betas: list[float] = []                                                    # betas[k] couples step k to k + 1
    largest = 0.0

    def orthogonal(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - v @ (v.T @ x)
        return x

    def triplets():
        left, sigma, right = np.linalg.svd(np.diag(alphas) + np.diag(betas[:len(alphas) - 1], 1))
        return left, sigma, right.T

    while len(alphas) < min(dims, rank):
        # a start orthogonal to all before
        start, beta = len(alphas), 0.0
        nxt = orthogonal(rng.standard_normal(dims))
        nxt /= np.linalg.norm(nxt)
        known = triplets()[1] if alphas else np.empty(0)
        while len(alphas) < min(dims, rank):
            v = np.c_[v, nxt]
            p = nxt - (beta * w[:, -1] if beta else 0.0)
            for _ in range(2):
                p = p - w @ (g.T @ p)                      # full reorthogonalisation of the left vectors
            square, ap = products(p)
            alpha = float(np.sqrt(max(square, 0.0)))
            largest = max(largest, alpha)
            if alpha <= NOTHING * largest:                 # A has nothing in this direction
                alphas.append(0.0)
                betas.append(0.0)
                w, g = np.c_[w, np.zeros(dims)], np.c_[g, np.zeros(dims)]
                break
            alphas.append(alpha)
            w, g = np.c_[w, p / alpha], np.c_[g, ap / alpha]
            nxt = orthogonal(g[:, -1] - alpha * v[:, -1])  # full reorthogonalisation of the right vectors
            beta = float(np.linalg.norm(nxt))
            if beta <= SETTLED * largest:                  # an invariant space
                betas.append(0.0)
                break
            betas.append(beta)
            nxt /= beta
            left, sigma, _ = triplets()
            residual = beta * np.abs(left[-1])
            leading = min(want, len(sigma))
            mine = np.flatnonzero(np.linalg.norm(left[start:], axis=0) > 0.5)      # values of this start
            needed = np.union1d(np.arange(leading), mine[:1])
            if len(sigma) > want and (residual[needed] <= SETTLED * sigma[0]).all():
                betas[-1] = 0.0
                break
        # values this start brought into the leading ones?
        left, sigma, _ = triplets()
        mine = np.flatnonzero(np.linalg.norm(left[start:], axis=0) > 0.5)
        if len(known) >= want and (not len(mine) or mine[0] >= want):
            break
    if not alphas:
        return np.empty(0), np.empty((dims, 0)), 0
    _, sigma, right = triplets()
    keep = np.flatnonzero(sigma[:want] > NOTHING * max(sigma[0], 1e-300))
    return sigma[keep], v @ right[:, keep], len(alphas)


def fit_whitening(fit: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a table of distinct lattice vectors ``x`` of ``dims`` entries; None without rows.

    ``fit`` is read once a step: pass a written table.
    """
    bound_batches(fit.sparkSession)
    n, sums = _sums(fit, dims)
    if not n:
        return None
    model = Whitening(n, sums, np.empty((dims, 0)), np.empty(0), 0.0, 0)
    mean, squares = model.mean, []

    def products(p: np.ndarray) -> tuple[float, np.ndarray]:
        yy, z, total = _products(fit, mean, p)
        squares.append(total)
        return yy, z

    sigma, right, model.steps = bidiagonalise(products, dims, n - 1, components)
    if len(sigma):
        model.trace = squares[0] / n
        model.eigenvalues = sigma ** 2 / n
        model.components = right / np.linalg.norm(right, axis=0)
        # either sign will do: the largest entry is positive
        at = np.abs(model.components).argmax(0)
        model.components *= np.sign(model.components[at, np.arange(len(at))])
        model.identity_error = _identity_error(fit, model)
    return model


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest entry by which the fit list's whitened covariance differs from the identity."""
    mean, turn = model.mean, model.components / np.sqrt(model.eigenvalues)
    r = turn.shape[1]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(r + r * r)
        for batch in batches:
            if batch.num_rows:
                y = (_matrix(batch.column(0)) - mean) @ turn
                out += np.r_[y.sum(0), (y.T @ y).ravel()]
        yield pa.record_batch({"v": pa.array([out.tolist()], pa.list_(pa.float64()))})

    got = _summed(fit, task, r + r * r) / model.n
    return float(np.abs(got[r:].reshape(r, r) - np.outer(got[:r], got[:r]) - np.eye(r)).max())


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[Decimal]:
    """Per row the exact sum of (n x - S)^2: longs where they suffice, else whole numbers of any size."""
    most = float(n) * float(np.abs(x).max(initial=0)) + max(abs(s) for s in sums)
    if most * most * x.shape[1] < _EXACT:
        off = x * n - np.array(sums, np.int64)
        return [Decimal(v) for v in np.einsum("ij,ij->i", off, off).tolist()]
    off = x.astype(object) * n - np.array(sums, object)
    return [Decimal(int(v)) for v in (off * off).sum(1)]


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector: str = "embedding",
           scale: int = SCALE) -> DataFrame:
    """Every whole row's whitened coordinates, one row per component.

    ``<id>, component`` (from 1, by falling eigenvalue), ``n`` (distinct
    lattice vectors), ``deviation`` (sum over dimensions of (n x - S)^2,
    exact, decimal(38,0)), ``whitened``, ``explained`` (eigenvalue / trace) and
    ``identity_error``.  Components of no variance are left out, so fewer
    than ``components`` rows, or none, come of vectors that lie in a smaller
    space or are all alike.  Null vectors and those holding null or non-finite
    entries go, as do vectors whose length is not the most frequent one (of
    equally frequent lengths the greatest).  Repeated rows and ids are each
    given out; null ids too; other columns are ignored; an empty table gives
    no rows.
    """
    spark = embeddings.sparkSession
    bound_batches(spark)
    rows = lattice(embeddings, vector, scale, keep=(id_col,))
    length = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    schema = f"{id_col} long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if length is None:
        return spark.createDataFrame([], schema)
    dims = length["d"]
    rows = rows.where(F.size("x") == dims)
    model = fit_whitening(stored(rows.select("x").distinct(), "lattice"), dims, components)
    r = len(model.eigenvalues)
    if not r:
        return spark.createDataFrame([], schema)
    mean, turn, explained = model.mean, model.components / np.sqrt(model.eigenvalues), model.eigenvalues / model.trace
    n, sums, error = model.n, model.sums, model.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x = _matrix(batch.column(1))
            each = np.repeat(np.arange(m), r)
            yield pa.record_batch({
                id_col: batch.column(0).take(pa.array(each)),
                "component": pa.array(np.tile(np.arange(1, r + 1, dtype=np.int32), m)),
                "n": pa.array(np.full(m * r, n, np.int64)),
                "deviation": pa.array(_deviations(x, n, sums), pa.decimal128(38, 0)).take(pa.array(each)),
                "whitened": pa.array(((x - mean) @ turn).ravel()),
                "explained": pa.array(np.tile(explained, m)),
                "identity_error": pa.array(np.full(m * r, error))})

    return rows.select(F.col(id_col).cast("long").alias(id_col), "x").mapInArrow(run, schema)
