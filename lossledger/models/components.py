"""Text vectors over many hashed slots, and principal components of wide vectors.

Word slots come from md5, so any engine can recompute them. Document frequencies are a table with a row for each slot in
use. Components are found by subspace iteration: every pass multiplies the centred rows by a matrix as narrow as the
components wanted (and some more), so nothing of the vectors' width squared exists anywhere. Only of few places (EXACT)
one pass adds up all products.
"""

from __future__ import annotations

import hashlib
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossledger.models.linalg import Rows, sparse_column, sparse_rows, sum_matrix
from lossledger.models.stages import StoredModel, stored_table
from lossledger.sources.tables import materialise

SLOTS = 1 << 18
#: Up to so many places with values one pass adds up the products of all pairs: a matrix of 512 KB.
EXACT = 256
SPARSE = "struct<indices:array<int>,values:array<double>>"


def words_of(text: Column) -> Column:
    """Runs of letters and digits, in lower case; none for NULL."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)), F.array().cast("array<string>"))


def word_slot(word: str, slots: int) -> int:
    """The first 15 hex digits of the word's md5, modulo the number of slots."""
    return int(hashlib.md5(word.encode()).hexdigest()[:15], 16) % slots


def _slot_counts(words: pa.Array, slots: int) -> Rows:
    """How often each row has each slot."""
    lengths = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    coded = words.flatten().dictionary_encode()
    slot = np.array([word_slot(w, slots) for w in coded.dictionary.to_pylist()], np.int64)
    key = np.repeat(np.arange(len(lengths)), lengths) * slots + (slot[coded.indices.to_numpy(zero_copy_only=False)] if len(slot) else 0)
    key, counts = np.unique(key, return_counts=True)
    return Rows(np.searchsorted(key, np.arange(len(lengths) + 1) * slots), key % slots, counts.astype(float))


def _as_array(rows: Rows) -> pa.StructArray:
    at = pa.array(rows.at.astype(np.int32))
    return pa.StructArray.from_arrays(
        [pa.ListArray.from_arrays(at, pa.array(rows.places.astype(np.int32))), pa.ListArray.from_arrays(at, pa.array(rows.values))], ["indices", "values"]
    )


class _WordParams(HasInputCol, HasOutputCol):
    slots = Param(Params._dummy(), "slots", "number of slots", TypeConverters.toInt)

    def _defaults(self) -> None:
        self._setDefault(inputCol="content", outputCol="words", slots=SLOTS)


class WordVectors(Estimator, _WordParams, DefaultParamsReadable, DefaultParamsWritable):
    """Words hashed into slots, counted, weighted by log((rows + 1) / (rows with the slot + 1)), scaled to unit length."""

    def __init__(self, **params: Any):
        super().__init__()
        self._defaults()
        self._set(**params)

    def _fit(self, dataset: DataFrame) -> WordVectorModel:
        slots = self.getOrDefault(self.slots)

        @F.arrow_udf("array<int>")
        def distinct_slots(words: pa.Array) -> pa.Array:
            return _as_array(_slot_counts(words, slots)).field("indices")

        texts = dataset.where(F.col(self.getInputCol()).isNotNull())
        found = texts.select(distinct_slots(words_of(F.col(self.getInputCol()))).alias("slots"))
        frequencies = found.select(F.explode("slots").alias("slot")).groupBy("slot").agg(F.count(F.lit(1)).alias("n_rows"))
        return self._copyValues(WordVectorModel(materialise(frequencies, "slot-frequencies"), texts.count()))


class WordVectorModel(StoredModel, _WordParams):
    """``frequencies`` has (slot, n_rows). A NULL text gives a NULL vector, a text without words an empty one."""

    def __init__(self, frequencies: DataFrame | None = None, n: int = 0):
        super().__init__()
        self._defaults()
        self.frequencies, self.n = frequencies, n

    def _transform(self, dataset: DataFrame) -> DataFrame:
        slots = self.getOrDefault(self.slots)
        weight = np.full(slots, np.log(self.n + 1.0))
        for row in self.frequencies.toLocalIterator():  # at most as many rows as slots
            weight[row["slot"]] = np.log((self.n + 1) / (row["n_rows"] + 1))

        @F.arrow_udf(SPARSE)
        def vectors(words: pa.Array) -> pa.Array:
            rows = _slot_counts(words, slots)
            values = rows.values * weight[rows.places]
            length = np.sqrt(np.bincount(rows.row, values * values, len(rows)))
            scaled = np.divide(values, length[rows.row], out=np.zeros_like(values), where=length[rows.row] > 0)
            return _as_array(Rows(rows.at, rows.places, scaled))

        text = F.col(self.getInputCol())
        return dataset.withColumn(self.getOutputCol(), F.when(text.isNotNull(), vectors(words_of(text))))

    def state(self) -> dict[str, Any]:
        return {"n": self.n}

    def tables(self) -> dict[str, DataFrame]:
        return {"frequencies": self.frequencies}

    def restore(self, spark: SparkSession, path: str, state: dict[str, Any]) -> None:
        self.frequencies, self.n = stored_table(spark, path, "frequencies"), state["n"]


class _ComponentParams(HasInputCol, HasOutputCol):
    k = Param(Params._dummy(), "k", "number of components", TypeConverters.toInt)
    size = Param(Params._dummy(), "size", "width of the vectors", TypeConverters.toInt)
    passes = Param(Params._dummy(), "passes", "most passes over the rows", TypeConverters.toInt)
    tolerance = Param(Params._dummy(), "tolerance", "relative change of the wanted variances that ends the passes", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the first subspace", TypeConverters.toInt)

    def _defaults(self) -> None:
        self._setDefault(inputCol="words", outputCol="principal_component_", k=32, size=SLOTS, passes=20, tolerance=1e-7, seed=5)


class PrincipalComponents(Estimator, _ComponentParams, DefaultParamsReadable, DefaultParamsWritable):
    """Centred, unscaled principal components. The subspace has twice as many dimensions as components are wanted, at
    least 16 more; if that is the whole width, or at most EXACT places have values, one pass finds them exactly. Rows
    without a vector don't count."""

    def __init__(self, **params: Any):
        super().__init__()
        self._defaults()
        self._set(**params)

    def _fit(self, dataset: DataFrame) -> ComponentModel:
        size, k = self.getOrDefault(self.size), self.getOrDefault(self.k)
        k = min(k, size)
        rows = dataset.where(F.col(self.getInputCol()).isNotNull()).select(sparse_column(dataset, self.getInputCol()).alias("x"))

        def moments(batch: pa.RecordBatch, total: np.ndarray) -> None:
            found = sparse_rows(batch.column(0))
            total[:size, 0] += np.bincount(found.places, found.values, size)
            total[:size, 1] += np.bincount(found.places, minlength=size)
            total[size] += len(found), found.values @ found.values

        first = sum_matrix(rows, (size + 1, 2), moments)
        n = max(first[size, 0], 1.0)
        live = np.flatnonzero(first[:size, 1])
        mean = first[live, 0] / n
        whole, width = first[size, 1] / n - mean @ mean, len(live)
        k = min(k, width)
        if width <= max(EXACT, k + max(16, k)):
            components, variances = self._whole(rows, live, mean, n, k)
        else:
            components, variances = self._subspace(rows, live, mean, n, k)
        if width:
            components *= np.where(components[np.abs(components).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
        return self._copyValues(ComponentModel(live, mean, components, np.maximum(variances, 0.0), float(whole)))

    @staticmethod
    def _whole(rows: DataFrame, live: np.ndarray, mean: np.ndarray, n: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Components and variances from the products of all pairs of places, in one pass."""
        width = len(live)
        if not width:
            return np.zeros((0, 0)), np.zeros(0)

        def products(batch: pa.RecordBatch, total: np.ndarray) -> None:
            for part in _only(sparse_rows(batch.column(0)), live).blocks(width):
                centred = part.dense(width) - mean
                total += centred.T @ centred

        variances, components = np.linalg.eigh(sum_matrix(rows, (width, width), products) / n)
        return components[:, ::-1][:, :k], variances[::-1][:k]

    def _subspace(self, rows: DataFrame, live: np.ndarray, mean: np.ndarray, n: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Components and variances by passes with a narrow basis."""
        width, narrow = len(live), k + max(16, k)
        basis, _ = np.linalg.qr(np.random.default_rng(self.getOrDefault(self.seed)).normal(size=(width, narrow)))
        before, variances, turn = np.zeros(k), np.zeros(k), np.zeros((narrow, k))
        for _ in range(self.getOrDefault(self.passes)):

            def image(batch: pa.RecordBatch, total: np.ndarray, basis: np.ndarray = basis) -> None:
                shift = mean @ basis
                for part in _only(sparse_rows(batch.column(0)), live).chunks():
                    seen = part.times(basis) - shift
                    part.transposed_times(seen, total[:width])
                    total[width] += seen.sum(axis=0)

            total = sum_matrix(rows, (width + 1, narrow), image)
            product = (total[:width] - np.outer(mean, total[width])) / n
            small = basis.T @ product
            variances, turn = np.linalg.eigh((small + small.T) / 2)
            variances, turn = variances[::-1][:k], turn[:, ::-1][:, :k]
            if np.abs(variances - before).max() <= self.getOrDefault(self.tolerance) * max(variances[0], 0.0):
                break
            before = variances
            basis, _ = np.linalg.qr(product)
        return basis @ turn, variances


def _only(rows: Rows, live: np.ndarray) -> Rows:
    """The rows with places numbered among the live ones (sorted), without any other."""
    if not len(live):
        return Rows(rows.at * 0, rows.places[:0], rows.values[:0])
    number = np.minimum(np.searchsorted(live, rows.places), len(live) - 1)
    there = live[number] == rows.places
    return Rows(np.r_[0, np.cumsum(there)][rows.at], number[there], rows.values[there])


class ComponentModel(StoredModel, _ComponentParams):
    """``live`` are the places that training had, ``mean`` and the lines of ``components`` (a column each) theirs; other
    places add nothing. ``variances`` are the components', ``whole`` is the variance of all places."""

    def __init__(self, live: np.ndarray | None = None, mean: np.ndarray | None = None, components: np.ndarray | None = None, variances: np.ndarray | None = None, whole: float = 0.0):
        super().__init__()
        self._defaults()
        self.live, self.mean, self.components, self.variances, self.whole = live, mean, components, variances, whole

    def columns(self) -> list[str]:
        return [f"{self.getOutputCol()}{i + 1}" for i in range(self.components.shape[1])]

    def project(self, rows: DataFrame, out: str) -> DataFrame:
        """Adds the coordinates as one array; NULL where there is no vector."""
        live, components, shift = self.live, self.components, self.mean @ self.components

        @F.arrow_udf("array<double>")
        def coordinates(x: pa.Array) -> pa.Array:
            found = _only(sparse_rows(x), live)
            there = [part.times(components) - shift for part in found.chunks()]
            values = np.concatenate(there) if there else np.zeros((0, components.shape[1]))
            at = pa.array(np.arange(len(found) + 1, dtype=np.int32) * components.shape[1])
            return pa.ListArray.from_arrays(at, pa.array(values.ravel()))

        return rows.withColumn(out, F.when(F.col(self.getInputCol()).isNotNull(), coordinates(sparse_column(rows, self.getInputCol()))))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Adds a column for each component."""
        rows = self.project(dataset, "_coordinates")
        return rows.withColumns({c: F.col("_coordinates")[i] for i, c in enumerate(self.columns())}).drop("_coordinates")

    def state(self) -> dict[str, Any]:
        return {"whole": self.whole}

    def tables(self) -> dict[str, DataFrame]:
        spark = SparkSession.getActiveSession()
        rows = [(0, 0.0, self.mean.tolist())] + [(i + 1, float(v), self.components[:, i].tolist()) for i, v in enumerate(self.variances)]
        live = spark.createDataFrame([(self.live.tolist(),)], "places array<long>")
        return {"components": spark.createDataFrame(rows, "component int, variance double, direction array<double>"), "live": live}

    def restore(self, spark: SparkSession, path: str, state: dict[str, Any]) -> None:
        rows = sorted(stored_table(spark, path, "components").collect(), key=lambda r: r["component"])
        self.live = np.array(stored_table(spark, path, "live").first()["places"], np.int64)
        self.mean, self.whole = np.array(rows[0]["direction"]), state["whole"]
        self.components, self.variances = np.array([r["direction"] for r in rows[1:]]).T, np.array([r["variance"] for r in rows[1:]])
