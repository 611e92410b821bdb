"""Whitening of embeddings by shifted CholeskyQR.

Vectors are first made integers on a fixed grid, so equality, counts and sums are exact. The components are fitted on each
distinct vector once. With A the centred rows, A = Q R is found without gathering rows: a pass over the rows adds up the
Gram matrix of A times the inverses of the triangles so far (a triangular solve for each block of rows), its Cholesky
factor is the next triangle, and R is the product of all. The first pass shifts the Gram matrix's diagonal a little, so
that the factor exists however badly A is conditioned; the passes after it bring Q to orthogonality. The singular value
decomposition of the small R gives the components: A'A = R'R, but the condition of A is never squared in R.

Only matrices of the vectors' dimension reach the driver. Partial Gram matrices are added up in two steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossledger.sources.tables import materialise

GRID = 256
COMPONENTS = 4
#: Passes after the shifted one: until Q'Q is the identity to this, or its part of the space that A spans is.
ORTHOGONAL, MOST_PASSES = 1e-13, 6
#: Components whose variance is below this share of the largest one's are rounding, not variance.
NO_VARIANCE = 1e-18
#: Partial Gram matrices are first added up in so many groups.
GROUPS = 64


def grid_vector(vector: Column, grid: int = GRID) -> Column:
    """Entries as integers, floor(grid * entry); null if the vector or an entry is null or an entry isn't finite."""
    values = vector.cast("array<double>")
    sound = ~F.exists(values, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(values.isNotNull() & sound, F.transform(values, lambda c: F.floor(c * F.lit(float(grid))).cast("long") + 0))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


@dataclass(frozen=True)
class Fit:
    """n distinct vectors, their sums in each dimension, and the components: directions (one a column), variances (e) and
    their shares of the whole variance."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    variances: np.ndarray
    shares: np.ndarray

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact in 64 bits, or in Python's integers where those don't suffice."""
        if self.n * (int(np.abs(x).max(initial=0)) + 1) < 2**61 and np.abs(self.sums).max(initial=0) < 2**61:
            return x * self.n - self.sums.astype(np.int64)
        return x.astype(object) * self.n - self.sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(np.float64) / self.n

    def whitened(self, x: np.ndarray, most: int) -> np.ndarray:
        """Rows projected on the components and scaled to unit variance."""
        return self.centred(x) @ self.directions[:, :most] / np.sqrt(self.variances[:most])


def _gram(rows: DataFrame, dimension: int, of) -> np.ndarray:
    """Sum of of(x)' of(x) over all rows; ``of`` takes a block of vectors."""
    width = of(np.zeros((1, dimension), np.int64)).shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                y = of(_matrix(batch.column(0), dimension))
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])

    def rows_up(table: pa.Table) -> pa.Table:
        total = _matrix(table["row"].combine_chunks(), width).sum(axis=0)
        return pa.table([table["i"].slice(0, 1), pa.array([total], pa.list_(pa.float64()))], ["i", "row"])

    partial = rows.select("x").mapInArrow(add, "i long, row array<double>").withColumn("part", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
    sums = partial.groupBy("i", "part").applyInArrow(rows_up, "i long, row array<double>").groupBy("i").applyInArrow(rows_up, "i long, row array<double>")
    out = np.zeros((width, width))
    for row in sums.collect():  # as many rows as the vectors have dimensions
        out[row["i"]] = row["row"]
    return (out + out.T) / 2


def _triangle(gram: np.ndarray, shift: float) -> np.ndarray:
    """The upper triangular factor of gram, its diagonal shifted if need be."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, np.finfo(float).eps * np.trace(gram))


def fit(rows: DataFrame) -> Fit | None:
    """Components of the distinct vectors in ``x`` (arrays of one length, written: they are read once a pass). None if no
    vector is there, or none differs."""
    # a short sum for each dimension; counts and sums in decimals, so they are exact
    counted = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(20,0)")).alias("s"))
    found = sorted(counted.collect(), key=lambda r: r["i"])  # as many rows as the vectors have dimensions
    if not found:
        return None
    n, dimension = found[0]["n"], len(found)
    base = Fit(n, np.array([int(r["s"]) for r in found], object), np.eye(dimension), np.ones(dimension), np.ones(dimension))

    triangles: list[np.ndarray] = []
    for step in range(MOST_PASSES + 1):

        def orthogonal(x: np.ndarray, done=tuple(triangles)) -> np.ndarray:
            q = base.centred(x)
            for r in done:
                q = np.linalg.solve(r.T, q.T).T
            return q

        gram = _gram(rows, dimension, orthogonal)
        if step == 0:
            total = np.trace(gram)
            if not total > 0:
                return None
            # the shift that makes the factor exist whatever rounding did to the sums
            shift = 11 * (n * dimension + dimension * (dimension + 1)) * np.finfo(float).eps * total
            shift = min(shift, 1e-3 * total / dimension)
        else:
            # what A doesn't span has dwindled to nothing; the rest must be orthonormal
            values = np.linalg.eigvalsh(gram)
            if np.all((np.abs(values - 1) < ORTHOGONAL * dimension) | (np.abs(values) < ORTHOGONAL * dimension)):
                break
            shift = 0.0
        triangles.append(_triangle(gram, shift))

    whole = np.eye(dimension)
    for r in triangles:
        whole = r @ whole
    _, singular, right = np.linalg.svd(whole)
    variances = singular**2 / n
    there = variances > NO_VARIANCE * variances[0]
    return Fit(n, base.sums, right[there].T, variances[there], (variances / variances.sum())[there])


def _project(model: Fit, most: int, identity_error: float):
    most = min(most, len(model.variances))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), len(model.sums))
            gaps = model.deviations(x)
            if gaps.dtype == np.int64 and len(model.sums) * float(np.abs(gaps).max(initial=0)) ** 2 < 2**62:
                squares = (gaps * gaps).sum(axis=1).tolist()
            else:
                squares = [sum(int(v) ** 2 for v in row) for row in gaps]
            squares = [s if s < 2**63 else None for s in squares]
            count, place = len(x), np.repeat(np.arange(len(x)), most)
            columns = [
                batch.column(0).take(pa.array(place)),
                pa.array(np.tile(np.arange(1, most + 1, dtype=np.int32), count)),
                pa.array(np.full(count * most, model.n)),
                pa.array(squares, pa.int64()).take(pa.array(place)),
                pa.array(model.whitened(x, most).ravel()),
                pa.array(np.tile(model.shares[:most], count)),
                pa.array(np.full(count * most, identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return work


_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS, grid: int = GRID, identifier: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per row with a sound vector, and component up to ``components``: vec_id, component (from 1, by falling variance),
    n (distinct vectors), deviation (sum of (n * x - S) squared, exact; null beyond 64 bits), whitened, explained (share
    of the variance) and identity_error (largest entry of the whitened covariance minus the identity, over the fit list).

    Rows with a null vector, or null or non-finite entries, are dropped; so are empty vectors. Vectors are of the length
    that most distinct vectors have (of equally common lengths, the longer); others are dropped. Equal vectors count once
    in the fit and have a row each in the result; so have rows that repeat an id; a null id stays null. Components without
    variance are left out, so a table whose vectors are all equal, or an empty one, gives no rows. Components of equal
    variance are any basis of their plane. Other columns are ignored.
    """
    sound = vectors.select(vectors[identifier].cast("long").alias("vec_id"), grid_vector(vectors[vector], grid).alias("x")).where(F.size("x") > 0)
    distinct = materialise(sound.select("x").distinct(), "distinct-vectors")
    # as many rows as there are lengths, then one
    lengths = distinct.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is not None:
        distinct = distinct.where(F.size("x") == lengths["d"])
        sound = sound.where(F.size("x") == lengths["d"])
    model = fit(distinct) if lengths is not None else None
    if model is None:
        return vectors.sparkSession.createDataFrame([], _RESULT)
    most = min(components, len(model.variances))
    covariance = _gram(distinct, len(model.sums), lambda x: model.whitened(x, most)) / model.n
    error = float(np.abs(covariance - np.eye(most)).max())
    return sound.select("vec_id", "x").mapInArrow(_project(model, most, error), _RESULT)
