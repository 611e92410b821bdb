"""Penalised linear regression of cost, its evaluation and its explanation."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossledger.models.features import FeatureModel, exact_quantiles
from lossledger.models.linalg import sparse_column, sparse_rows, sum_matrix
from lossledger.models.stages import StoredModel, stored_table

#: Places up to which the products of all pairs are added up: a matrix of 32 MB.
MOMENTS = 2048


def linear_regression(
    l1: float = 1.0, l2: float = 0.0, iterations: int = 30, features: str = "features", label: str = "subtotal", prediction: str = "predicted_subtotal"
) -> LinearRegression:
    """Spark's elastic net with total weight l1 + l2 on the mean loss; ``CostRegression`` has them on the summed loss."""
    total = l1 + l2
    return LinearRegression(
        featuresCol=features,
        labelCol=label,
        predictionCol=prediction,
        maxIter=iterations,
        regParam=total,
        elasticNetParam=l1 / total if total else 0.0,
    )


class _CostParams(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    l1 = Param(Params._dummy(), "l1", "weight of the sum of absolute weights", TypeConverters.toFloat)
    l2 = Param(Params._dummy(), "l2", "weight of half the sum of squared weights", TypeConverters.toFloat)
    iterations = Param(Params._dummy(), "iterations", "most iterations", TypeConverters.toInt)
    tolerance = Param(Params._dummy(), "tolerance", "relative progress that ends the fit", TypeConverters.toFloat)

    def _defaults(self) -> None:
        self._setDefault(l1=1.0, l2=0.0, iterations=30, tolerance=1e-6, featuresCol="features", labelCol="subtotal", predictionCol="predicted_subtotal")


class CostRegression(Estimator, _CostParams, DefaultParamsReadable, DefaultParamsWritable):
    """Linear regression with the penalty on the summed loss:

        1/2 sum (y - prediction)^2 + l1 sum |w_j s_j| + l2 / 2 sum (w_j s_j)^2

    where s_j is the standard deviation of place j, so weights are penalised in units of standardised features.

    Up to MOMENTS places one pass adds up the products of all pairs of places, and coordinate descent on those runs to the
    optimum on the driver. Beyond that Spark's solver passes over the rows; it takes the mean loss, and divides its squared
    penalty by the label's deviation, so the amounts are scaled for that, and it ends where its progress does.
    """

    def __init__(self, l1: float = 1.0, l2: float = 0.0, **more: Any):
        super().__init__()
        self._defaults()
        self._set(l1=float(l1), l2=float(l2), **more)

    def _fit(self, dataset: DataFrame) -> CostRegressionModel:
        known = dataset.where(F.col(self.getLabelCol()).isNotNull())
        label = F.col(self.getLabelCol()).cast("double")
        seen = known.select(
            F.count(label).alias("n"), F.avg(label).alias("mean"), F.stddev_pop(label).alias("spread"), Summarizer.metrics("mean", "std").summary(F.col(self.getFeaturesCol())).alias("s")
        ).first()
        means, n = seen["s"]["mean"].toArray(), seen["n"]
        spread = seen["s"]["std"].toArray() * ((n - 1) / n) ** 0.5
        fit = self._by_moments if len(means) <= MOMENTS else self._by_solver
        found = fit(known, n, means, spread, seen["mean"], seen["spread"] or 0.0)
        return self._copyValues(CostRegressionModel(found, n, means, spread))

    def _by_moments(self, known: DataFrame, n: int, means: np.ndarray, spread: np.ndarray, mean: float, deviation: float) -> LinearRegressionModel:
        size = len(means)
        rows = known.select(sparse_column(known, self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))

        def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
            y, done = batch.column(1).to_numpy(), 0
            for part in sparse_rows(batch.column(0)).chunks():
                dense = np.zeros((len(part), size + 1))
                dense[part.row, part.places] = part.values
                dense[:, size] = y[done : done + len(part)]
                total += dense.T @ dense
                done += len(part)

        moments = sum_matrix(rows, (size + 1, size + 1), add)
        unit = np.where(spread > 0, spread, np.inf)
        gram = (moments[:size, :size] - n * np.outer(means, means)) / np.outer(unit, unit)
        cross = (moments[:size, size] - n * means * mean) / unit
        weights = descend(gram, cross, self.getOrDefault(self.l1), self.getOrDefault(self.l2), 1e-10 * n * deviation) / unit
        spark = known.sparkSession
        java = spark._jvm.org.apache.spark.ml.regression.LinearRegressionModel(self.uid, _py2java(spark.sparkContext, Vectors.dense(weights)), float(mean - weights @ means))
        return LinearRegressionModel(java).setFeaturesCol(self.getFeaturesCol()).setPredictionCol(self.getPredictionCol())

    def _by_solver(self, known: DataFrame, n: int, means: np.ndarray, spread: np.ndarray, mean: float, deviation: float) -> LinearRegressionModel:
        l1, l2 = self.getOrDefault(self.l1), self.getOrDefault(self.l2) * deviation
        solver = LinearRegression(
            featuresCol=self.getFeaturesCol(),
            labelCol=self.getLabelCol(),
            predictionCol=self.getPredictionCol(),
            maxIter=self.getOrDefault(self.iterations),
            tol=self.getOrDefault(self.tolerance),
            regParam=(l1 + l2) / n,
            elasticNetParam=l1 / (l1 + l2) if l1 + l2 else 0.0,
        )
        return solver.fit(known)


def descend(gram: np.ndarray, cross: np.ndarray, l1: float, l2: float, slack: float, sweeps: int = 20_000) -> np.ndarray:
    """The w that minimises w'Gw / 2 - c'w + l1 |w| + l2 w'w / 2, by coordinate descent, until every coordinate meets the
    condition of the optimum within ``slack``. Every few sweeps the equations of the non-zero coordinates, with their
    signs, are solved outright; if the answer meets the condition it is the optimum, else the sweeps go on, up to their number. A place
    without spread keeps weight 0."""
    weights, rest = np.zeros(len(cross)), cross.copy()
    live = [j for j in range(len(cross)) if gram[j, j] > 0]

    def short(w: np.ndarray, rest: np.ndarray) -> float:
        pull = rest - l2 * w
        return np.where(w != 0, np.abs(pull - l1 * np.sign(w)), np.maximum(np.abs(pull) - l1, 0.0))[live].max(initial=0.0)

    for sweep in range(sweeps):
        for j in live:
            wanted = rest[j] + gram[j, j] * weights[j]
            new = np.sign(wanted) * max(abs(wanted) - l1, 0.0) / (gram[j, j] + l2)
            if new != weights[j]:
                rest -= gram[j] * (new - weights[j])
                weights[j] = new
        if short(weights, rest) <= slack:
            break
        if sweep % 25 == 24:
            some = np.flatnonzero(weights)
            solved = np.zeros(len(cross))
            solved[some] = np.linalg.lstsq(gram[np.ix_(some, some)] + l2 * np.eye(len(some)), cross[some] - l1 * np.sign(weights[some]), rcond=None)[0]
            if (l1 == 0 or (np.sign(solved) == np.sign(weights)).all()) and short(solved, cross - gram @ solved) <= slack:
                return solved
    return weights


class CostRegressionModel(StoredModel, _CostParams):
    """The fitted regression, with the mean and standard deviation that every place had in training."""

    def __init__(self, regression: LinearRegressionModel | None = None, n: int = 0, means: np.ndarray | None = None, spread: np.ndarray | None = None):
        super().__init__()
        self._defaults()
        self.regression, self.n, self.means, self.spread = regression, n, means, spread

    @property
    def weights(self) -> np.ndarray:
        return self.regression.coefficients.toArray()

    @property
    def baseline(self) -> float:
        """The prediction where every place has its training mean."""
        return float(self.regression.intercept + self.weights @ self.means)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.regression.transform(dataset)

    def state(self) -> dict[str, Any]:
        return {"n": self.n}

    def tables(self) -> dict[str, DataFrame]:
        return {"places": self.place_table(SparkSession.getActiveSession())}

    def inner(self) -> dict[str, LinearRegressionModel]:
        return {"regression": self.regression}

    def restore(self, spark: SparkSession, path: str, state: dict[str, Any]) -> None:
        self.regression = LinearRegressionModel.load(os.path.join(path, "inner", "regression"))
        places = sorted(stored_table(spark, path, "places").collect(), key=lambda r: r["pos"])
        self.n = state["n"]
        self.means, self.spread = np.array([r["mean"] for r in places]), np.array([r["spread"] for r in places])

    def place_table(self, spark: SparkSession) -> DataFrame:
        """(pos, weight, mean, spread) of every place."""
        rows = [(i, *map(float, x)) for i, x in enumerate(zip(self.weights, self.means, self.spread))]
        return spark.createDataFrame(rows, "pos long, weight double, mean double, spread double")

    def optimality(self, rows: DataFrame, relative: float = 1e-6) -> DataFrame:
        """(pos, weight, gradient, holds): whether each weight meets the condition of the optimum on its training rows,
        within ``relative`` of n times the label's deviation. The gradient of the summed loss, in units of the
        standardised place, is minus l1 times the weight's sign (within l1 for a weight of 0), less the squared penalty's."""
        predicted = self.transform(rows.where(F.col(self.getLabelCol()).isNotNull()))
        label = F.col(self.getLabelCol()).cast("double")
        gaps = predicted.select(sparse_column(predicted, self.getFeaturesCol()).alias("x"), (F.col(self.getPredictionCol()) - label).alias("gap"), label.alias("y"))

        def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
            gap, y = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            sparse_rows(batch.column(0)).transposed_times(np.c_[gap, gap * 0, gap * 0], total)
            total[-1] += gap.sum(), y.sum(), (y * y).sum()

        size = len(self.weights)
        total = sum_matrix(gaps, (size + 1, 3), add)
        deviation = max(total[-1, 2] / self.n - (total[-1, 1] / self.n) ** 2, 0.0) ** 0.5
        slack = relative * self.n * deviation
        l1, l2 = self.getOrDefault(self.l1), self.getOrDefault(self.l2)
        found = []
        for pos, (w, s, g) in enumerate(zip(self.weights, self.spread, total[:size, 0])):
            # standardised, and with the mean taken off (the gaps' sum is 0 at the optimum, up to rounding)
            gradient = (g - self.means[pos] * total[-1, 0]) / s + l2 * w * s if s > 0 else 0.0
            short = abs(gradient + l1 * np.sign(w)) if w else max(abs(gradient) - l1, 0.0)
            found.append((pos, float(w), float(gradient), bool(short <= slack)))
        return rows.sparkSession.createDataFrame(found, "pos long, weight double, gradient double, holds boolean")

    def with_attributions(self, rows: DataFrame, features: FeatureModel, out: str = "attributions") -> DataFrame:
        """Adds what each input adds to or takes from the baseline, as an array in the order of ``features.inputs()``: the
        sum of weight x (value - training mean) over the input's places. Only places that a row fills are looked at; what
        an input's empty places cost is the same for all rows. Attributions and baseline add up to the prediction."""
        names, owner = features.inputs()
        owner, weights = np.array(owner, np.int64), self.weights
        usual = np.bincount(owner, weights * self.means, len(names))
        count = len(names)

        @F.arrow_udf("array<double>")
        def attribute(x: pa.Array) -> pa.Array:
            found = sparse_rows(x)
            key = found.row * count + owner[found.places]
            total = np.bincount(key, weights[found.places] * found.values, len(found) * count).reshape(-1, count) - usual
            at = pa.array(np.arange(len(found) + 1, dtype=np.int32) * count)
            return pa.ListArray.from_arrays(at, pa.array(total.ravel()))

        return rows.withColumn(out, attribute(sparse_column(rows, self.getFeaturesCol())))

    def explain(self, rows: DataFrame, features: FeatureModel, k: int = 5) -> DataFrame:
        """Rows with prediction, baseline and the k inputs with the largest absolute attribution, largest first (the name
        breaks ties), closest prediction first. ``rows`` have the assembled features."""
        names, _ = features.inputs()
        out = self.with_attributions(self.transform(rows), features).withColumn("baseline_prediction", F.lit(self.baseline))
        parts = [(name, F.col("attributions")[i]) for i, name in enumerate(names)]
        out = out.withColumn("top_feature_attributions", top_attributions(parts, k))
        return out.orderBy(F.abs(F.col(self.getPredictionCol()) - F.col(self.getLabelCol())))

    def global_attribution(self, rows: DataFrame, features: FeatureModel) -> DataFrame:
        """(feature, mean absolute attribution) over the rows, largest first."""
        names, _ = features.inputs()
        found = self.with_attributions(rows, features).select(F.posexplode("attributions").alias("input", "a"))
        means = found.groupBy("input").agg(F.avg(F.abs("a")).alias("attribution"))
        named = F.array(*[F.lit(n) for n in names])[F.col("input")]
        return means.select(named.alias("feature"), "attribution").orderBy(F.desc("attribution"), "feature")

    def weight_table(self, features: FeatureModel, spark: SparkSession) -> DataFrame:
        """(processed_input, category, weight), each weight times its place's standard deviation in training."""
        places = self.place_table(spark).select("pos", (F.col("weight") * F.col("spread")).alias("weight"))
        return features.feature_table(spark).join(places, "pos").select("processed_input", "category", "weight")


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Mean absolute, mean squared, mean squared log and median absolute error, R2 and explained variance."""
    y, p = F.col(label), F.col(prediction)
    err = y - p
    log_gap = F.log1p(F.greatest(p, F.lit(0.0))) - F.log1p(F.greatest(y, F.lit(0.0)))
    median = exact_quantiles(df.select(F.abs(err).alias("e")), {"e": [0.5]})["e"][0]
    ss_res, var_y, var_err = F.sum(err * err), F.var_pop(y), F.var_pop(err)
    return df.agg(
        F.avg(F.abs(err)).alias("mean_absolute_error"),
        F.avg(err * err).alias("mean_squared_error"),
        F.avg(log_gap * log_gap).alias("mean_squared_log_error"),
        F.lit(median).alias("median_absolute_error"),
        (1 - F.try_divide(ss_res, var_y * F.count(y))).alias("r2_score"),
        (1 - F.try_divide(var_err, var_y)).alias("explained_variance"),
    )


def model_weights(model: LinearRegressionModel, table: DataFrame, rows: DataFrame, features: str = "features") -> DataFrame:
    """(processed_input, category, weight), each weight times its feature's standard deviation. ``table`` has pos,
    processed_input and category; the weights are as many as the model has places."""
    spread = rows.select(Summarizer.metrics("std").summary(F.col(features)).alias("s")).select("s.std").first()[0]
    found = [(i, float(w * d)) for i, (w, d) in enumerate(zip(model.coefficients.toArray(), spread.toArray()))]
    weights = rows.sparkSession.createDataFrame(found, "pos long, weight double")
    return table.join(weights, "pos").select("processed_input", "category", "weight")


def category_weights(weights: DataFrame) -> DataFrame:
    """Weights by input, as ``weight_report`` takes them: a number has its weight, a category column a list."""
    listed = F.collect_list(F.when(F.col("category").isNotNull(), F.struct("category", "weight")))
    number = F.max(F.when(F.col("category").isNull(), F.col("weight")))
    return weights.groupBy("processed_input").agg(number.alias("weight"), listed.alias("category_weights"))


def weight_report(weights: DataFrame) -> DataFrame:
    """Mean weight per input over its categories, and the category with the largest weight, largest first."""
    flat = weights.select("processed_input", "weight", F.explode_outer("category_weights").alias("cat"))
    w = F.coalesce("weight", "cat.weight")
    top = F.max_by("cat.category", F.struct(w, F.col("cat.category")))
    return flat.groupBy("processed_input").agg(F.avg(w).alias("weight"), top.alias("top_category")).orderBy(F.desc("weight"), "processed_input")


def attributions(weights: Mapping[str, float], means: Mapping[str, float]) -> list[tuple[str, Column]]:
    """(feature, weight x (value - mean)) per feature."""
    return [(name, F.lit(float(w)) * (F.col(name) - F.lit(means[name]))) for name, w in weights.items()]


def top_attributions(parts: Sequence[tuple[str, Column]], k: int = 5) -> Column:
    """The k features with the largest absolute attribution as (feature, attribution), largest first, name breaking
    ties. Field access on the sorted array keeps the expression free of interpreted lambdas."""
    keyed = F.array(*[F.struct((-F.abs(a)).alias("o"), F.lit(n).alias("feature"), a.alias("attribution")) for n, a in parts])
    top = F.slice(F.sort_array(keyed), 1, k)
    return F.arrays_zip(top["feature"].alias("feature"), top["attribution"].alias("attribution"))


def explain(df: DataFrame, weights: Mapping[str, float], label: str, prediction: Column, k: int = 5) -> DataFrame:
    """Rows with their top attributions, closest prediction first. Means come from the table itself."""
    means = df.agg(*[F.avg(n).alias(n) for n in weights]).first().asDict()
    out = df.withColumn(f"predicted_{label}", prediction)
    out = out.withColumn("top_feature_attributions", top_attributions(attributions(weights, means), k))
    return out.orderBy(F.abs(F.col(f"predicted_{label}") - F.col(label)))


def global_attribution(df: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """(feature, mean absolute attribution), largest first."""
    means = df.agg(*[F.avg(n).alias(n) for n in weights]).first().asDict()
    # One mean per feature in a single row, then one row per feature.
    row = df.agg(*[F.avg(F.abs(a)).alias(n) for n, a in attributions(weights, means)])
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("attribution")) for n in weights])
    return row.select(F.explode(pairs).alias("p")).select("p.feature", "p.attribution").orderBy(F.desc("attribution"), "feature")
