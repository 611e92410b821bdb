"""Sums over rows of what numpy makes of a batch, for fits that need a matrix and not the rows.

Each task adds up its own batches; its sum travels as blocks of lines, which are added in two steps, so no task receives
every other task's sum at once. Only the total reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Numbers in a block that travels.
BLOCK = 1 << 16
PARTS = 32
#: Non-zeros that a worker expands at a time.
CHUNK = 1 << 15
#: Numbers of a product, or of filled-in rows, that are made at a time.
CACHED = 1 << 16
#: Rows are filled in for a product if at least one place in so many has a value.
FILLED = 8


@dataclass(frozen=True)
class Rows:
    """Sparse rows: places and values of row i stand from at[i] to at[i + 1]."""

    at: np.ndarray
    places: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.at) - 1

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.at))

    def chunks(self, most: int = CHUNK) -> Iterator[Rows]:
        """Consecutive rows with at most ``most`` non-zeros, or one row."""
        first = 0
        while first < len(self):
            last = max(first + 1, int(np.searchsorted(self.at, self.at[first] + most, "right")) - 1)
            a, b = self.at[first], self.at[last]
            yield Rows(self.at[first : last + 1] - a, self.places[a:b], self.values[a:b])
            first = last

    def blocks(self, width: int) -> Iterator[Rows]:
        """Consecutive rows, as many as CACHED numbers hold when filled in to ``width`` places."""
        step = max(1, CACHED // max(1, width))
        for first in range(0, len(self), step):
            at = self.at[first : first + step + 1]
            yield Rows(at - at[0], self.places[at[0] : at[-1]], self.values[at[0] : at[-1]])

    def dense(self, width: int) -> np.ndarray:
        """The rows filled in with zeros."""
        return np.bincount(self.row * width + self.places, self.values, len(self) * width).reshape(len(self), width)

    def times(self, matrix: np.ndarray) -> np.ndarray:
        """The rows times a matrix with one line for every place, in parts that fit a cache."""
        out, done, matrix = np.zeros((len(self), matrix.shape[1])), 0, np.ascontiguousarray(matrix)
        if len(self) * len(matrix) <= FILLED * len(self.places):
            for part in self.blocks(len(matrix)):
                out[done : done + len(part)] = part.dense(len(matrix)) @ matrix
                done += len(part)
            return out
        for part in self.chunks(max(1, CACHED // max(1, matrix.shape[1]))):
            filled = np.flatnonzero(np.diff(part.at))
            if len(filled):
                out[done + filled] = np.add.reduceat(part.values[:, None] * matrix[part.places], part.at[filled], axis=0)
            done += len(part)
        return out

    def transposed_times(self, matrix: np.ndarray, out: np.ndarray) -> None:
        """Adds the transposed rows times a matrix with one line for every row."""
        if len(self.places):
            order = np.argsort(self.places, kind="stable")
            places = self.places[order]
            first = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
            out[places[first]] += np.add.reduceat((self.values[:, None] * matrix[self.row])[order], first, axis=0)


def sparse_column(df: DataFrame, column: str) -> Column:
    """(indices, values) of an ml vector, an array of numbers, or a struct of both; zeros of dense ones count as places."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StructType):
        return F.struct(F.col(column)["indices"].cast("array<int>").alias("indices"), F.col(column)["values"].cast("array<double>").alias("values"))
    if isinstance(kind, T.ArrayType):
        values, places = F.col(column).cast("array<double>"), F.lit(None).cast("array<int>")
    else:
        inner = F.unwrap_udt(F.col(column))
        values, places = inner["values"], inner["indices"]
    dense = F.sequence(F.lit(0), F.size(values) - 1)
    found = F.struct(F.coalesce(places, F.when(F.size(values) > 0, dense), F.array().cast("array<int>")).alias("indices"), values.alias("values"))
    return F.when(F.col(column).isNotNull(), found)


def sparse_rows(column: pa.Array) -> Rows:
    """A batch of ``sparse_column``; a null row has no places."""
    places, values = column.field("indices"), column.field("values")
    lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), places.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0)
    at = np.r_[0, np.cumsum(lengths)].astype(np.int64)
    return Rows(at, places.flatten().to_numpy(zero_copy_only=False).astype(np.int64), values.flatten().to_numpy(zero_copy_only=False).astype(float))


def sum_matrix(rows: DataFrame, shape: tuple[int, int], add: Callable[[pa.RecordBatch, np.ndarray], None]) -> np.ndarray:
    """The sum over all batches of what ``add(batch, total)`` adds to a matrix of zeros."""
    size = shape[0] * shape[1]

    def total_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros(shape), False
        for batch in batches:
            if batch.num_rows:
                any_rows = True
                add(batch, total)
        flat = total.ravel()
        blocks = [(i, flat[a : a + BLOCK]) for i, a in enumerate(range(0, size, BLOCK))] if any_rows else []
        blocks = [(i, b) for i, b in blocks if b.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in blocks], pa.int32()), pa.array([b.tobytes() for _, b in blocks], pa.binary())], ["block", "data"])

    def add_up(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(d.as_py(), float) for d in table["data"])
        return pa.table([table["block"].slice(0, 1), pa.array([total.tobytes()], pa.binary())], ["block", "data"])

    sums = rows.mapInArrow(total_of, "block int, data binary").withColumn("part", F.spark_partition_id() % PARTS)
    for keys in (("block", "part"), ("block",)):
        sums = sums.groupBy(*keys).applyInArrow(add_up, "block int, data binary")
    out = np.zeros(size)
    for row in sums.collect():  # the matrix itself
        out[row["block"] * BLOCK : row["block"] * BLOCK + len(row["data"]) // 8] = np.frombuffer(row["data"], float)
    return out.reshape(shape)
