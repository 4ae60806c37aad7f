"""Whitening of vectors by shifted CholeskyQR over distributed Gram matrices.

The centred rows X are never gathered. A pass sums the Gram matrix of the rows in their tasks and adds the tasks' sums up;
its Cholesky factor R makes the rows nearly orthonormal through triangular solves, and the next pass measures what is
left. The first factor is shifted, so that it exists whatever the condition of X. After two or three passes X = Q R with
the composed R, and the singular values and right vectors of R are those of X: the components, and the eigenvalues of the
covariance with the divisor n. The driver sees sums of `dims` and Gram matrices of `dims` squared numbers, never rows.

Entries are taken as whole numbers, floor(64 * c) + 1,000,000: sums and deviations are exact, and rows are centred by
n * x - S before they are divided by n.

Edge cases: null vectors, and those with a null, NaN or infinite entry, are left out, as are vectors with fewer entries
than the longest. Null keys are kept. Repeated rows count as often as they are there. A direction without any variance is
no component, so equal vectors, a single one, empty ones and an empty table give no rows. Where eigenvalues tie, any unit
vectors of their space are the components. Entries beyond 2^40 fail with a message, and deviations beyond a long
with Spark's overflow error. Other columns are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwarden.session import cut_lineage

SCALE = 64
ORIGIN = 1_000_000
MOST = 32
#: Passes after which directions that are still not orthonormal have no variance.
PASSES = 6
WIDEST = 2.0**40
EPS = np.finfo(float).eps


@dataclass
class Fit:
    """What the rows of the table gave. `vectors` has a component per column, largest eigenvalue first."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.eigenvalues))


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (n * x - sums) / n


def solve_right(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q with Q @ r = rows, for an upper triangular r, column by column."""
    q = np.empty_like(rows)
    for j in range(r.shape[1]):
        q[:, j] = (rows[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def whole_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, x): the vectors that count, as whole numbers."""
    entries = F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double"))
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    sound = df.select(F.col(f"`{key}`").alias(key), entries.alias("c")).where(F.col("c").isNotNull() & ~F.exists("c", odd))
    wide = F.raise_error(F.lit("an entry of a vector is beyond 2^40"))
    whole = lambda c: F.when(F.abs(c) > WIDEST, wide.cast("long")).otherwise(F.floor(c * SCALE) + ORIGIN)
    return sound.select(key, F.transform("c", whole).alias("x"))


def _matrix(column, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _total(rows: DataFrame, dims: int, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...], kind: str) -> np.ndarray:
    """The sum of `of(x)` over the rows, added up in the tasks and then by entry."""
    dtype = {"long": np.int64, "double": np.float64}[kind]

    def part(batches):
        total = np.zeros(shape, dtype)
        for batch in batches:
            if batch.num_rows:
                total += of(_matrix(batch.column("x"), dims))
        yield pa.record_batch({"v": pa.array([total.ravel()], pa.list_(pa.from_numpy_dtype(dtype)))})

    parts = rows.select("x").mapInArrow(part, f"v array<{kind}>")
    entries = parts.select(F.posexplode("v").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v"))
    total = np.zeros(int(np.prod(shape)), dtype)
    for row in entries.collect():
        total[row["at"]] = row["v"]
    return total.reshape(shape)


def fit(rows: DataFrame, most: int = MOST) -> Fit | None:
    """The mean and the components of a stored table with the column `x`; None without any variance. All rows have one length."""
    longest = rows.agg(F.max(F.size("x"))).first()[0]
    if not longest:
        return None
    dims = int(longest)
    n = rows.count()
    sums = _total(rows, dims, lambda x: x.sum(0), (dims,), "long")
    factors: list[np.ndarray] = []

    def orthogonal(x):
        q = centred(x, n, sums)
        for r in factors:
            q = solve_right(q, r)
        return q

    for number in range(PASSES):
        gram = _total(rows, dims, lambda x: (q := orthogonal(x)).T @ q, (dims, dims), "double")
        if not gram.any():
            return None
        spread = np.linalg.eigvalsh(gram)
        if number == PASSES - 1 or factors and np.abs(gram - np.eye(dims)).max() < 100 * dims * EPS:
            break
        shift = 11 * (n * dims + dims * (dims + 1)) * EPS * spread[-1]
        poor = not factors or spread[0] < 1e-10 * spread[-1]
        factors.append(np.linalg.cholesky(gram + (shift * np.eye(dims) if poor else 0)).T)

    # X'X = R' G R, with the last Gram matrix G in place of the identity it is close to.
    r = np.eye(dims)
    for factor in factors:
        r = factor @ r
    values, turned = np.linalg.eigh(gram)
    root = np.sqrt(np.maximum(values, 0))[:, None] * turned.T
    _, lengths, directions = np.linalg.svd(root @ r)
    real = np.flatnonzero(lengths > lengths[0] * max(n, dims) * EPS)[:most]
    return Fit(n, sums, directions[real].T, lengths[real] ** 2 / n, float((lengths**2).sum() / n))


def identity_error(rows: DataFrame, found: Fit) -> float:
    """The largest entry, without sign, of the covariance of the whitened rows less the identity."""
    dims, size = found.vectors.shape
    mean = _total(rows, dims, lambda x: found.whitened(x).sum(0), (size,), "double") / found.n
    covariance = _total(rows, dims, lambda x: (w := found.whitened(x) - mean).T @ w, (size, size), "double") / found.n
    return float(np.abs(covariance - np.eye(size)).max())


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = MOST) -> DataFrame:
    """For each vector that counts, and each component: key, component (from 1), n, deviation, whitened, explained, identity_error.

    `deviation` is the sum of (n * x - S) squared, exact; `explained` the share of the variance.
    """
    stored = cut_lineage(whole_vectors(df, key, vector))
    longest = stored.agg(F.max(F.size("x"))).first()[0]
    rows = stored.where(F.size("x") == F.lit(longest))
    found = fit(rows, most)
    if found is None:
        kind = df.select(F.col(f"`{key}`").alias(key)).schema[0].dataType.simpleString()
        return df.sparkSession.createDataFrame(
            [], f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        )
    dims = len(found.sums)
    error = identity_error(rows, found)

    @F.arrow_udf("array<double>")
    def whitened(x: pa.Array) -> pa.Array:
        values = found.whitened(_matrix(x, dims))
        return pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), values.shape[1]).cast(pa.list_(pa.float64()))

    apart = F.zip_with("x", F.array(*[F.lit(int(s)) for s in found.sums]), lambda x, s: x * F.lit(found.n).cast("long") - s)
    deviation = F.aggregate(apart, F.lit(0).cast("long"), lambda total, d: total + d * d)
    shares = F.array(*[F.lit(float(e / found.trace)) for e in found.eigenvalues])
    each = rows.select(key, deviation.alias("deviation"), F.posexplode(F.arrays_zip(whitened("x").alias("w"), shares.alias("share"))).alias("place", "value"))
    return each.select(
        key,
        (F.col("place") + 1).alias("component"),
        F.lit(found.n).cast("long").alias("n"),
        "deviation",
        F.col("value.w").alias("whitened"),
        F.col("value.share").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
