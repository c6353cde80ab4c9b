"""Whitening of embeddings by shifted CholeskyQR.

Entries become integers, ``floor(64 * c) + 1000000``. The fit list, each distinct vector once, is written to the shared
folder; n, the sums S and every Gram matrix come from passes over it. With A the centred rows of the fit list:

1. G = Q'Q is summed by the tasks, one matrix each, starting with Q = A. The driver takes the Cholesky factor of G, at
   first with a small shift on its diagonal, so that it exists whatever A's condition is.
2. The next pass applies the triangular solve, Q = A R^-1, to its rows, and the factors are composed, R = R_k ... R_1,
   until Q'Q is the identity to double precision. A = QR holds for any shift, so the shift costs no accuracy.
3. The singular values s and right vectors of R (as many rows as dimensions) are those of A: eigenvalues s^2 / n and
   components of the covariance. The covariance itself is never formed, so its squared condition number hurts nothing.
4. All rows are projected, and one more pass measures the covariance of the whitened fit list.

Centring is exact: with S = n q + r, a centred entry is (x - q) - r / n, whose first part is a small integer.

Memory: a task holds a batch and one d x d matrix, the driver a few d x d matrices, whatever the number of rows.
A third of all rows may be one vector: copies combine before the shuffle.

Defined results: rows without a vector, or with a null, NaN or infinite entry, are left out, as are vectors of another
length than most distinct ones have (the longest of equally frequent lengths) and empty ones. Rows without an id stay,
repeated rows give repeated results. Directions without variance (fewer distinct vectors than dimensions, constant
entries) give no component, so a single distinct vector gives no rows, as does an empty table. Entries beyond 2^61 / 64
are taken as that. A deviation that no long can hold is null. Other columns of any name are ignored; there are no texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.tables import staged

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Shift of the first Gram matrices, as a share of their trace (a direction counts from that share of A on); singular
#: values under FLAT of the largest are none.
SHIFT, FLAT = 1e-10, 1e-12
MAX_PASSES = 8


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                                         & (F.abs(c.cast("double")) < float("inf")))


def integers(vector: Column) -> Column:
    """The entries as longs."""
    bound = float(1 << 61)
    return F.transform(vector, lambda c: F.floor(F.greatest(F.least(SCALE * c.cast("double"), F.lit(bound)), F.lit(-bound)))
                       .cast("bigint") + OFFSET)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass(frozen=True)
class Centre:
    """Rows and column sums of the fit list, exactly."""

    n: int
    sums: tuple[int, ...]

    def parts(self) -> tuple[np.ndarray, np.ndarray]:
        q, r = zip(*(divmod(s, self.n) for s in self.sums))
        return np.array(q, np.int64), np.array(r, np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        q, r = self.parts()
        return (x - q).astype(np.float64) - r / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2 over the dimensions; null where no long can hold one."""
        q, r = self.parts()
        apart = x - q
        if x.size and (self.n * (float(np.abs(apart).max()) + 1)) ** 2 * x.shape[1] >= 2.0**62:
            whole = [sum((self.n * int(a) - int(b)) ** 2 for a, b in zip(row, r)) for row in apart]
            return [d if d < 1 << 63 else None for d in whole]
        return ((self.n * apart - r) ** 2).sum(axis=1).tolist()


def _summed(fit: DataFrame, values, size: int) -> np.ndarray:
    """Sum over all tasks of ``values(x)``, an array of ``size`` doubles for each batch of rows."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += values(batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["at", "v"])

    rows = fit.mapInArrow(partial, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros(size)
    out[rows["at"].to_numpy(np.int64)] = rows["v"].to_numpy()
    return out


def gram(fit: DataFrame, centre: Centre, solve: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Q'Q and the column sums of Q = A ``solve`` over the fit list."""
    width, d = len(centre.sums), solve.shape[1]

    def values(column: pa.Array) -> np.ndarray:
        q = centre.centred(_matrix(column, width)) @ solve
        return np.concatenate([(q.T @ q).ravel(), q.sum(axis=0)])

    total = _summed(fit, values, d * d + d)
    matrix = total[: d * d].reshape(d, d)
    return (matrix + matrix.T) / 2, total[d * d:]


def measure(fit: DataFrame, width: int) -> Centre:
    """Rows and exact column sums."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), width)
                high = x >> 32  # halves, so that no sum of a batch can overflow
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(width, dtype=np.int32)), pa.array(high.sum(axis=0)), pa.array((x - (high << 32)).sum(axis=0)),
                     pa.array(np.full(width, len(x)))], ["at", "high", "low", "n"])

    whole = F.sum(F.col("high").cast("decimal(38,0)")), F.sum(F.col("low").cast("decimal(38,0)"))
    rows = (fit.mapInArrow(partial, "at int, high bigint, low bigint, n bigint").groupBy("at")
            .agg(whole[0].alias("high"), whole[1].alias("low"), F.sum("n").alias("n")).orderBy("at").collect())
    return Centre(rows[0]["n"], tuple((int(r["high"]) << 32) + int(r["low"]) for r in rows))


def triangle(fit: DataFrame, centre: Centre) -> np.ndarray:
    """R of A = QR by shifted CholeskyQR passes; where A has no variance in some direction, as many rows fewer."""
    d = len(centre.sums)
    composed, solve = np.eye(d), np.eye(d)
    for turn in range(MAX_PASSES):
        product, _ = gram(fit, centre, solve)
        trace = float(np.trace(product))
        if trace == 0:
            return np.zeros((d, d))
        values, vectors = np.linalg.eigh(product)
        flat = values < 0.25
        if turn == 0 or flat.any() and turn < 2:  # small directions come up in the next pass; a third would lift rounding
            factor, done = np.linalg.cholesky(product + SHIFT * trace * np.eye(d)).T, False
        else:  # what is still flat has no variance: it keeps its place, and has no part in the end
            whole = product + vectors[:, flat] @ vectors[:, flat].T
            factor, done = np.linalg.cholesky(whole).T, np.abs(whole - np.eye(d)).max() < 1e-12 * d
        if done and flat.any():
            return np.sqrt(values[~flat])[:, None] * (vectors[:, ~flat].T @ composed)
        composed = factor @ composed
        if done:
            break
        solve = np.linalg.solve(composed, np.eye(d))
    return composed


@dataclass(frozen=True)
class Whitening:
    centre: Centre
    components: np.ndarray  # d x k, unit columns
    eigenvalues: np.ndarray
    trace: float

    @property
    def projection(self) -> np.ndarray:
        return self.components / np.sqrt(self.eigenvalues)


def fit_whitening(fit: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    centre = measure(fit, width)
    _, singular, right = np.linalg.svd(triangle(fit, centre))
    # no variance at all gives no component
    rank = int((singular > FLAT * singular[0]).sum()) if singular[0] > 0 else 0
    kept = min(components, rank)
    eigenvalues = singular**2 / centre.n
    return Whitening(centre, right[:kept].T.copy(), eigenvalues[:kept], float(eigenvalues[:rank].sum()))


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity."""
    product, sums = gram(fit, model.centre, model.projection)
    n = model.centre.n
    return float(np.abs(product / n - np.outer(sums / n, sums / n) - np.eye(len(sums))).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per usable row and component: the id, component, n, deviation, whitened, explained and identity_error."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("c")).filter(usable(F.col("c")))
    rows = rows.select("vec_id", integers(F.col("c")).alias("x"))
    fit = staged(rows.filter(F.size("x") > 0).select("x").distinct(), "vectors")
    of_length = fit.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if of_length is None:
        return vectors.sparkSession.createDataFrame([], schema)
    width = of_length["d"]
    fit = fit.filter(F.size("x") == width)
    model = fit_whitening(fit, width, components)
    k = len(model.eigenvalues)
    if not k:
        return vectors.sparkSession.createDataFrame([], schema)
    error, explained = identity_error(fit, model), model.eigenvalues / model.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            x = _matrix(batch.column("x"), width)
            whitened = model.centre.centred(x) @ model.projection
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, model.centre.n)), pa.array(model.centre.deviation(x), pa.int64()).take(each),
                 pa.array(whitened.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.filter(F.size("x") == width).mapInArrow(project, schema)
