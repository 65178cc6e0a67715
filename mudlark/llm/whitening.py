"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows X are brought to upper bidiagonal form, X V = U B, one column a step: u = X v, and the next v from X'u. Rows are
spread over tasks and never gathered. A left vector u has an entry for each row; as every u is X p for a short vector p, p is kept in its
place, and one pass over the rows gives all that a step needs: X p, its squared norm and X'(X p). Full
reorthogonalisation is done on both sides: for the right vectors directly, twice, and for the left ones through their products with
the new one, which are p_i'X'(X p). The singular values and right singular vectors of the small B are the deviations and, turned by V,
the components. Steps end when the residuals of all wanted components are at rounding, or when V spans all dimensions.

What goes to the driver are vectors of as many entries as there are dimensions, summed by Spark first.

Entries c are made integers x = floor(64 c) + 1000000, so sums are exact and do not hang on the order of rows; a row is centred as
(x - q) - r / n, with S = q n + r, before it is multiplied, so that the great common part costs no digits.

Defined results: rows whose vector is null or holds null, NaN or infinite entries are dropped; vectors of different lengths are an
error, and so is a deviation beyond a 64-bit integer; rows of equal or null ids are rows of their own; directions
without variance (up to a part in 1e12 of the greatest) are no components, so equal vectors alone give no rows, as does an empty
table; further columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mudlark.llm.common import materialise, read_table

COMPONENTS = 32
SCALE, OFFSET = 64.0, 1_000_000
#: Residual of a component, as part of the greatest singular value, at which it is done; variance, as part of the greatest, that counts as none.
DONE, NONE = 1e-14, 1e-12
SEED = 11


class Fit(NamedTuple):
    """Rows, sums of each dimension, components (one in each row), eigenvalues, and the total variance."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def whole_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is there and has finite entries only, with ``x``, its integers."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    v = F.col(column).cast("array<double>")
    rows = vectors.where(F.col(column).isNotNull() & F.forall(v, finite))
    return rows.withColumn("x", F.transform(v, lambda c: F.floor(c * SCALE) + OFFSET))


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column as a matrix of integers."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    q, r = np.divmod(sums, n)
    return (x - q).astype(np.float64) - r / n


def _total(rows: DataFrame, task, kind: str) -> np.ndarray:
    """Sums over all tasks of the arrays that ``task`` gives one of for each; only sums reach the driver."""
    parts = rows.select("x").mapInArrow(task, f"part array<{kind}>").select(F.posexplode("part").alias("i", "s"))
    got = parts.groupBy("i").agg(F.sum("s").alias("s")).collect()  # as many rows as the array has entries
    out = np.zeros(len(got), dtype=np.int64 if kind == "bigint" else np.float64)
    for i, s in got:
        out[i] = s
    return out


def _one(values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values], type=pa.list_(pa.from_numpy_dtype(values.dtype)))], names=["part"])


def _sums(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[pa.RecordBatch]:
    out = np.zeros(dimensions, dtype=np.int64)
    for b in batches:
        out += _matrix(b.column(0)).sum(axis=0)
    yield _one(out)


def _product(batches: Iterator[pa.RecordBatch], n: int, sums: np.ndarray, p: np.ndarray) -> Iterator[pa.RecordBatch]:
    """X'(X p), |X p|^2 and |X|^2 of the task's rows."""
    out = np.zeros(len(p) + 2)
    for b in batches:
        x = _centred(_matrix(b.column(0)), n, sums)
        u = x @ p
        out[:-2] += x.T @ u
        out[-2] += u @ u
        out[-1] += np.einsum("ij,ij->", x, x)
    yield _one(out)


def _orthogonal(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """``v`` without its parts along the basis; a second turn takes what rounding left."""
    for _ in range(2):
        for b in basis:
            v = v - (b @ v) * b
    return v


def fitted(rows: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """The components of ``rows(x)``, written rows; None where there are no rows or no entries."""
    size = rows.agg(F.count("*").alias("n"), F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).head()
    n, d = size["n"], size["most"]
    if not n or not d:
        return None
    if size["least"] != d:
        raise ValueError(f"vectors have from {size['least']} to {d} entries")
    sums = _total(rows, partial(_sums, dimensions=d), "bigint")
    rng = np.random.default_rng(SEED)
    basis, left, back, alphas, betas = [], [], [], [], []  # V, the p of each u, X'u, and the two diagonals of B
    v, beta, trace, turns = rng.standard_normal(d), 0.0, 0.0, None
    v /= np.linalg.norm(v)
    while len(basis) < d:
        p = v - beta * left[-1] if left else v
        got = _total(rows, partial(_product, n=n, sums=sums, p=p), "double")
        g, square, trace = got[:-2], float(got[-2]), float(got[-1])
        for q, r in zip(left, back, strict=True):  # the parts of X p along the earlier u, and so of all that comes from it
            c = float(q @ g)
            p, g, square = p - c * q, g - c * r, square - c * c
        alpha = float(np.sqrt(max(square, 0.0)))
        basis.append(v)
        if alpha <= np.sqrt(NONE * trace):  # no variance along v
            alphas.append(0.0)
            left.append(np.zeros(d))
            back.append(np.zeros(d))
        else:
            alphas.append(alpha)
            left.append(p / alpha)
            back.append(g / alpha)
        v = _orthogonal(back[-1] - alphas[-1] * v, basis)
        beta = float(np.linalg.norm(v))
        if len(basis) == d:
            break
        if beta <= 1e-13 * max(alphas):  # an invariant subspace: go on in a direction outside of it
            v, beta = _orthogonal(rng.standard_normal(d), basis), 0.0
            betas.append(0.0)
            v /= np.linalg.norm(v)
            if trace - sum(a * a for a in alphas) - sum(b * b for b in betas) <= NONE * trace:
                break  # all variance is found
            continue
        v /= beta
        betas.append(beta)
        if len(basis) >= components:
            turns = np.linalg.svd(np.diag(alphas) + np.diag(betas[:-1], 1))
            if beta * np.abs(turns[0][-1, :components]).max() <= DONE * turns[1][0]:
                break
    k = len(basis)
    _, deviations, right = np.linalg.svd(np.diag(alphas) + np.diag(betas[: k - 1], 1))
    eigenvalues = deviations**2 / n
    some = np.flatnonzero(eigenvalues > NONE * max(eigenvalues[0], 1e-300))[:components] if trace > 0 else np.zeros(0, dtype=int)
    return Fit(n, sums, right[some] @ np.array(basis), eigenvalues[some], trace / n)


def _whitened(x: np.ndarray, fit: Fit) -> np.ndarray:
    return _centred(x, fit.n, fit.sums) @ (fit.components / np.sqrt(fit.eigenvalues)[:, None]).T


def _moments(batches: Iterator[pa.RecordBatch], fit: Fit) -> Iterator[pa.RecordBatch]:
    """Sums and products of the whitened rows."""
    k = len(fit.eigenvalues)
    out = np.zeros(k + k * k)
    for b in batches:
        w = _whitened(_matrix(b.column(0)), fit)
        out[:k] += w.sum(axis=0)
        out[k:] += (w.T @ w).ravel()
    yield _one(out)


def identity_error(rows: DataFrame, fit: Fit) -> float:
    """The largest entry of the whitened rows' covariance less the identity."""
    k = len(fit.eigenvalues)
    got = _total(rows, partial(_moments, fit=fit), "double") / fit.n
    return float(np.abs(got[k:].reshape(k, k) - np.outer(got[:k], got[:k]) - np.eye(k)).max())


ROWS_AT_ONCE = 4096


def _placed(batches: Iterator[pa.RecordBatch], fit: Fit, error: float) -> Iterator[pa.RecordBatch]:
    k = len(fit.eigenvalues)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for whole in batches:
        for start in range(0, len(whole), ROWS_AT_ONCE):
            b = whole.slice(start, ROWS_AT_ONCE)
            x = _matrix(b.column(1))
            far = fit.n * x - fit.sums
            if float(np.abs(far).max()) ** 2 * far.shape[1] >= 2.0**63:
                raise OverflowError("a deviation is greater than a 64-bit integer")
            at, component = np.repeat(np.arange(len(b)), k), np.tile(np.arange(1, k + 1, dtype=np.int32), len(b))
            columns = [b.column(0).take(pa.array(at)), component, np.full(len(at), fit.n), np.repeat((far * far).sum(axis=1), k), _whitened(x, fit).ravel(), np.tile(fit.eigenvalues / fit.trace, len(b)), np.full(len(at), error)]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, components: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """A row for each vector that is whole and each component."""
    rows = materialise(whole_vectors(vectors, column).select(F.col("vec_id").cast("long").alias("vec_id"), "x"), "vectors")
    fit = fitted(rows, components)
    if fit is None or not len(fit.eigenvalues):
        return vectors.sparkSession.createDataFrame([], WHITENED)
    return rows.mapInArrow(partial(_placed, fit=fit, error=identity_error(rows, fit)), WHITENED)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(read_table(spark, sf_dir, "embeddings"))


QUERIES = {"op12_embedding_whitening": op12_embedding_whitening}
