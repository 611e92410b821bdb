"""k-means over assembled features, and reports on the clusters."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossledger.functions.rules import nonempty, round_ratio, thousands
from lossledger.models.linalg import Rows, sparse_column, sparse_rows, sum_matrix
from lossledger.models.stages import StoredModel, stored_table
from lossledger.operators.aggregates import distinct_lengths
from lossledger.sources.tables import save_table, work_folder


def cluster_stages(features: str = "features", k: int = 40, iterations: int = 30, seed: int = 7, scale: bool = True) -> Pipeline:
    """Scaled features, parallel seeding, at most ``iterations`` rounds, early stop by tolerance."""
    stages, column = [], features
    if scale:
        stages, column = [StandardScaler(inputCol=features, outputCol="_scaled", withStd=True)], "_scaled"
    return Pipeline(stages=[*stages, KMeans(featuresCol=column, predictionCol="_cluster", k=k, maxIter=iterations, seed=seed)])


def assign_cluster(df: DataFrame, model: PipelineModel, out: str = "centroid_id") -> DataFrame:
    """Cluster number from 1 on."""
    return model.transform(df).withColumn(out, F.col("_cluster") + 1).drop("_cluster", "_scaled")


#: Rows for each cluster in the sample that the first centres are chosen from.
SEED_ROWS = 50
#: Up to so many places of all centres together the sums of a chunk are counted in one array; of more only those that occur.
CELLS = 1 << 14


class _ClusterParams(HasFeaturesCol, HasPredictionCol):
    k = Param(Params._dummy(), "k", "number of clusters", TypeConverters.toInt)
    iterations = Param(Params._dummy(), "iterations", "most rounds", TypeConverters.toInt)
    progress = Param(Params._dummy(), "progress", "a round that lowers the cost by a smaller share is the last", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the first centres", TypeConverters.toInt)
    folder = Param(Params._dummy(), "folder", "where the rounds are written; a fit that finds some there goes on from the last", TypeConverters.toString)

    def _defaults(self) -> None:
        self._setDefault(featuresCol="features", predictionCol="centroid_id", k=40, iterations=30, progress=0.01, seed=7, folder="")


class CostClusters(Estimator, _ClusterParams, DefaultParamsReadable, DefaultParamsWritable):
    """k-means over places scaled to unit deviation, round by round.

    The first centres are chosen (each with a probability that grows with the squared distance to those before) from a
    hash sample of SEED_ROWS * k rows; everything after reads all rows. The centres of each round are written with the cost of the
    round before them, so a fit that lost its driver goes on where it was when it is given the same folder.
    """

    def __init__(self, **params: Any):
        super().__init__()
        self._defaults()
        self._set(**params)

    def _fit(self, dataset: DataFrame) -> ClusterModel:
        spark, k = dataset.sparkSession, self.getOrDefault(self.k)
        deviation = dataset.select(Summarizer.metrics("std").summary(F.col(self.getFeaturesCol())).alias("s")).first()[0][0].toArray()
        scale = np.divide(1.0, deviation, out=np.zeros_like(deviation), where=deviation > 0)
        rows = dataset.select(sparse_column(dataset, self.getFeaturesCol()).alias("x"))
        folder = self.getOrDefault(self.folder) or os.path.join(work_folder(spark), f"rounds-{uuid.uuid4().hex}")
        found, costs = self._last_round(spark, folder)
        centres = found if found is not None else self._first(rows, scale, k)
        size = len(scale)
        while len(costs) < self.getOrDefault(self.iterations):

            def add(batch: pa.RecordBatch, total: np.ndarray, centres: np.ndarray = centres) -> None:
                for part in _scaled(sparse_rows(batch.column(0)), scale).chunks():
                    which, distance = _nearest(part, centres)
                    cell = which[part.row] * size + part.places
                    if len(centres) * size <= CELLS:
                        total[:, :size] += np.bincount(cell, part.values, len(centres) * size).reshape(-1, size)
                    else:
                        key, place = np.unique(cell, return_inverse=True)
                        np.add.at(total, (key // size, key % size), np.bincount(place.ravel(), part.values, len(key)))
                    total[: len(centres), size] += np.bincount(which, minlength=len(centres))
                    total[0, size + 1] += distance.sum()

            total = sum_matrix(rows, (len(centres), size + 2), add)
            counts = total[:, size]
            means = np.divide(total[:, :size], counts[:, None], out=centres.copy(), where=counts[:, None] > 0)
            costs = [*costs, float(total[0, size + 1])]
            self._write(spark, folder, len(costs), means, counts, costs)
            before, centres = centres, means
            if len(costs) > 1 and costs[-2] - costs[-1] < self.getOrDefault(self.progress) * costs[-2]:
                break
        else:
            before = centres
        return self._copyValues(ClusterModel(centres, scale, costs, before))

    def _first(self, rows: DataFrame, scale: np.ndarray, k: int) -> np.ndarray:
        seed = self.getOrDefault(self.seed)
        sample = rows.distinct().orderBy(F.xxhash64("x.indices", "x.values", F.lit(seed)), "x").limit(SEED_ROWS * k).collect()
        points = np.zeros((len(sample), len(scale)))
        for i, r in enumerate(sample):
            points[i, r["x"]["indices"]] = np.array(r["x"]["values"]) * scale[r["x"]["indices"]]
        rng = np.random.default_rng(seed)
        chosen = [int(rng.integers(len(points)))]
        near = ((points - points[chosen[0]]) ** 2).sum(axis=1)
        while len(chosen) < k and near.sum() > 0:
            chosen.append(int(rng.choice(len(points), p=near / near.sum())))
            near = np.minimum(near, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
        return points[chosen]

    @staticmethod
    def _write(spark: SparkSession, folder: str, number: int, centres: np.ndarray, counts: np.ndarray, costs: list[float]) -> None:
        rows = [(i, int(n), c.tolist(), costs) for i, (c, n) in enumerate(zip(centres, counts))]
        save_table(spark.createDataFrame(rows, "centre int, n long, place array<double>, costs array<double>").coalesce(1), os.path.join(folder, f"round-{number}"))

    @staticmethod
    def _last_round(spark: SparkSession, folder: str) -> tuple[np.ndarray | None, list[float]]:
        """Centres and costs of the last round that was written whole."""
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        number = 0
        while files.exists(spark._jvm.org.apache.hadoop.fs.Path(folder, f"round-{number + 1}/_SUCCESS")):
            number += 1
        if not number:
            return None, []
        rows = sorted(spark.read.parquet(os.path.join(folder, f"round-{number}")).collect(), key=lambda r: r["centre"])
        return np.array([r["place"] for r in rows]), list(rows[0]["costs"])


def _scaled(rows: Rows, scale: np.ndarray) -> Rows:
    return Rows(rows.at, rows.places, rows.values * scale[rows.places])


def _nearest(rows: Rows, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row (the first of several) and its squared distance."""
    own = np.bincount(rows.row, rows.values**2, len(rows))
    apart = (centres**2).sum(axis=1) - 2 * rows.times(centres.T) + own[:, None]
    which = apart.argmin(axis=1)
    return which, np.maximum(apart[np.arange(len(rows)), which], 0.0)


class ClusterModel(StoredModel, _ClusterParams):
    """Centres (in scaled places), the scale, the cost of each round, and the centres that the last round assigned by:
    ``centres`` are the means of that assignment."""

    def __init__(self, centres: np.ndarray | None = None, scale: np.ndarray | None = None, costs: list[float] | None = None, before: np.ndarray | None = None):
        super().__init__()
        self._defaults()
        self.centres, self.scale, self.costs, self.before = centres, scale, costs or [], before

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Adds the cluster number, from 1 on."""
        return self.assign(dataset, self.centres, self.getPredictionCol())

    def assign(self, dataset: DataFrame, centres: np.ndarray, out: str) -> DataFrame:
        scale = self.scale

        @F.arrow_udf("int")
        def nearest(x: pa.Array) -> pa.Array:
            parts = [_nearest(p, centres)[0] for p in _scaled(sparse_rows(x), scale).chunks()]
            return pa.array((np.concatenate(parts) if parts else np.zeros(0)).astype(np.int32) + 1)

        return dataset.withColumn(out, nearest(sparse_column(dataset, self.getFeaturesCol())))

    def scaled(self, dataset: DataFrame, out: str) -> DataFrame:
        """Adds the scaled places as an array."""
        scale = self.scale

        @F.arrow_udf("array<double>")
        def dense(x: pa.Array) -> pa.Array:
            found = _scaled(sparse_rows(x), scale)
            whole = np.zeros((len(found), len(scale)))
            whole[found.row, found.places] = found.values
            return pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * len(scale)), pa.array(whole.ravel()))

        return dataset.withColumn(out, dense(sparse_column(dataset, self.getFeaturesCol())))

    def centre_table(self, spark: SparkSession, centres: np.ndarray | None = None) -> DataFrame:
        """(centroid_id, centre)."""
        rows = [(i + 1, c.tolist()) for i, c in enumerate(self.centres if centres is None else centres)]
        return spark.createDataFrame(rows, "centroid_id int, centre array<double>")

    def state(self) -> dict[str, Any]:
        return {"costs": self.costs, "scale": self.scale.tolist()}

    def tables(self) -> dict[str, DataFrame]:
        return {"centres": self.centre_table(SparkSession.getActiveSession())}

    def restore(self, spark: SparkSession, path: str, state: dict[str, Any]) -> None:
        rows = sorted(stored_table(spark, path, "centres").collect(), key=lambda r: r["centroid_id"])
        self.centres, self.scale, self.costs = np.array([r["centre"] for r in rows]), np.array(state["scale"]), state["costs"]
        self.before = None


def nearest_centre(df: DataFrame, vector: str, centres: DataFrame, centre_id: str, centre: str, out: str, distance: str) -> DataFrame:
    """Closest given centre by squared distance; the smallest id wins a tie.

    The centres (k rows, a model's size) go to every task, so no pairs are made. The distance to a centre of another length,
    or with a NULL on either side, is NULL and comes first; NaN comes last.
    """
    ids = centres.schema[centre_id].dataType
    pairs = F.struct(F.col(centre_id).alias("id"), F.col(centre).cast("array<double>").alias("c"))
    table = centres.agg(F.array_sort(F.collect_list(pairs)).alias("t")).first()["t"]
    if not table:
        return df.withColumns({out: F.lit(None).cast(ids), distance: F.lit(None).cast("double")})
    lines = [None if r["c"] is None or None in r["c"] else np.array(r["c"], float) for r in table]
    same = all(c is not None and len(c) == len(lines[0]) for c in lines)
    places = np.array(lines).T.copy() if same else np.zeros((0, len(lines)))

    @F.arrow_udf("struct<at:int,gap:double>")
    def nearest(v: pa.Array) -> pa.Array:
        sizes = v.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
        values = v.flatten().to_numpy(zero_copy_only=False).astype(float)
        whole = sizes >= 0
        if v.flatten().null_count:
            holes = np.r_[0, np.cumsum(v.flatten().is_null().to_numpy(zero_copy_only=False))]
            end = np.cumsum(np.maximum(sizes, 0))
            whole &= holes[end] == holes[end - np.maximum(sizes, 0)]
        at, gap = np.zeros(len(sizes), np.int32), np.zeros(len(sizes))
        known = whole & same & (sizes == len(places))
        for n in np.unique(sizes[whole & ~known]):
            at[whole & (sizes == n)] = next(i for i, c in enumerate(lines) if c is None or len(c) != n)
        at[known], gap[known] = _closest(values[np.repeat(known, np.maximum(sizes, 0))].reshape(known.sum(), len(places)), places)
        return pa.StructArray.from_arrays([pa.array(at), pa.array(gap, mask=~known)], ["at", "gap"])

    known = F.array(*[F.lit(r["id"]).cast(ids) for r in table])
    best = df.withColumn("_best", nearest(F.col(vector).cast("array<double>")))
    return best.withColumn(out, F.get(known, F.col("_best.at"))).withColumn(distance, F.col("_best.gap")).drop("_best")


def _closest(rows: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of the closest centres (columns of ``places``) of each row and its squared distance, added up place by
    place, in parts that fit a cache."""
    at, gap = np.zeros(len(rows), np.int32), np.zeros(len(rows))
    step = max(1, (1 << 15) // places.shape[1])
    for a in range(0, len(rows), step):
        part = rows[a : a + step]
        apart = np.zeros((len(part), places.shape[1]))
        for x, c in zip(part.T, places):
            off = x[:, None] - c
            off *= off
            apart += off
        which = np.where(np.isnan(apart), np.inf, apart).argmin(axis=1)
        found = apart[np.arange(len(part)), which]
        for i in np.flatnonzero(np.isnan(found) & np.isinf(apart).any(axis=1)):
            which[i] = np.isinf(apart[i]).argmax()
        at[a : a + step], gap[a : a + step] = which, apart[np.arange(len(part)), which]
    return at, gap


def cost_by_cluster(df: DataFrame, cluster: str, amount: str) -> DataFrame:
    """(cluster, total, total as text), largest first."""
    totals = df.groupBy(cluster).agg(F.sum(amount).alias("subtotal"))
    return totals.select(cluster, "subtotal", thousands(F.round("subtotal")).alias("subtotal_str")).orderBy(F.desc("subtotal"), cluster)


def cluster_profile(df: DataFrame, cluster: str, values: Sequence[str], counts: Sequence[str], amount: str, cap: int = 10) -> DataFrame:
    """Up to ``cap`` distinct values per attribute, distinct counts of ids, and the cost, per cluster. The attributes go
    through one grouping as (cluster, attribute, value) rows, which are cut to ``cap`` before they are shuffled."""
    kinds = [df.schema[v].dataType for v in values]
    ranks = [F.col(v).cast("double") if isinstance(t, T.NumericType) else F.lit(0.0) for v, t in zip(values, kinds)]
    cells = [F.struct(F.lit(i).alias("slot"), r.alias("rank"), F.col(v).cast("string").alias("text")) for i, (v, r) in enumerate(zip(values, ranks))]
    cells = df.select(cluster, F.explode(F.array(*cells)).alias("_c")).select(cluster, "_c.*").where(F.col("text").isNotNull()).distinct()
    along = Window.partitionBy(cluster, "slot").orderBy("rank", "text")
    top = cells.withColumn("_rn", F.row_number().over(along)).where(F.col("_rn") <= cap)
    arrays = []
    for i, (v, t) in enumerate(zip(values, kinds)):
        found = F.array_sort(F.collect_list(F.when(F.col("slot") == i, F.struct("_rn", "text"))))
        arrays.append(nonempty(found["text"].cast(T.ArrayType(t))).alias(f"array_{v}"))
    lists = top.groupBy(F.col(cluster).alias("_of")).agg(*arrays)
    sums = df.groupBy(cluster).agg(*[F.countDistinct(c).alias(f"q_{c}") for c in counts], F.round(F.sum(amount).cast("decimal(28,2)"), 0).alias("subtotal"))
    return sums.join(lists, sums[cluster].eqNullSafe(lists["_of"]), "left").drop("_of")


def cluster_purity(df: DataFrame, cluster: str, features: Sequence[str]) -> DataFrame:
    """Mean number of distinct values per feature over the clusters, one decimal; a cluster without any value of a
    feature does not count."""
    lengths = distinct_lengths(df, [cluster], features)
    means = []
    for f in features:
        n = F.when(F.col("feature") == f, F.col("n_values"))
        means.append(round_ratio(F.sum(n), F.count(n), 1).cast("double").alias(f"avg_len_array_{f}"))
    return lengths.agg(*means)
