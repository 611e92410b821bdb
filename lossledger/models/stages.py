"""Pipeline stages whose fitted state is tables, and staged fits.

A fitted stage is saved with its parameters, a small JSON state and its tables as Parquet, so that one ``PipelineModel``
holds features, components and model, is saved and loaded as a whole, and predicts after loading in another session.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence
from typing import Any

from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from lossledger.models.features import FeatureModel, FeatureSpec
from lossledger.sources.tables import materialise


class _Writer(MLWriter):
    def __init__(self, stage: StoredModel):
        super().__init__()
        self._stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self._stage, path, self.sparkSession, extraMetadata={"state": self._stage.state()})
        for name, table in self._stage.tables().items():
            table.write.parquet(os.path.join(path, "tables", name))
        for name, inner in self._stage.inner().items():
            inner.write().save(os.path.join(path, "inner", name))


class _Reader(MLReader):
    def __init__(self, kind: type[StoredModel]):
        super().__init__()
        self._kind = kind

    def load(self, path: str) -> StoredModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self._kind()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        stage.restore(self.sparkSession, path, metadata["state"])
        return stage


class StoredModel(Model, MLWritable, MLReadable):
    """A fitted stage; subclasses say what their state is and take it back."""

    def state(self) -> dict[str, Any]:
        return {}

    def tables(self) -> dict[str, DataFrame]:
        return {}

    def inner(self) -> dict[str, MLWritable]:
        return {}

    def restore(self, spark: SparkSession, path: str, state: dict[str, Any]) -> None:
        """Take the state back; tables lie in ``path``/tables, inner stages in ``path``/inner."""

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


def stored_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(path, "tables", name))


class _FeatureParams(HasOutputCol):
    spec = Param(Params._dummy(), "spec", "the FeatureSpec as JSON", TypeConverters.toString)

    def _init(self, spec: FeatureSpec | None, output: str) -> None:
        self._setDefault(spec="{}", outputCol="features")
        self._set(outputCol=output, **({"spec": json.dumps(spec.as_dict())} if spec else {}))

    def feature_spec(self) -> FeatureSpec:
        return FeatureSpec.from_dict(json.loads(self.getOrDefault(self.spec)))


class FeatureEstimator(Estimator, _FeatureParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits a FeatureSpec: label and category vocabularies, cut points, medians and spreads, means."""

    def __init__(self, spec: FeatureSpec | None = None, output: str = "features"):
        super().__init__()
        self._init(spec, output)

    def _fit(self, dataset: DataFrame) -> FeatureStage:
        stage = FeatureStage(FeatureModel.fit(dataset, self.feature_spec()))
        return self._copyValues(stage)


class FeatureStage(StoredModel, _FeatureParams):
    """Fitted features as a pipeline stage; it adds the vector column and passes all rows on."""

    def __init__(self, model: FeatureModel | None = None):
        super().__init__()
        self._init(model.spec if model else None, "features")
        self.model = model

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.model.assemble(dataset, self.getOutputCol())

    def state(self) -> dict[str, Any]:
        return self.model.numbers()

    def tables(self) -> dict[str, DataFrame]:
        return self.model.code_tables()

    def restore(self, spark: SparkSession, path: str, state: dict[str, Any]) -> None:
        self.model = FeatureModel.restored(self.feature_spec(), state, lambda name: stored_table(spark, path, name))


def fit_staged(rows: DataFrame, stages: Sequence[Estimator | Transformer]) -> tuple[PipelineModel, DataFrame]:
    """Fit stage after stage. What a fitted stage makes of the rows is written once, so that the many passes of a later
    fit read that and don't repeat the joins before. Returns the fitted pipeline and the rows as the last stage got them."""
    fitted = []
    for number, stage in enumerate(stages):
        fits = isinstance(stage, Estimator)
        fitted.append(stage.fit(rows) if fits else stage)
        if number + 1 < len(stages):
            rows = fitted[-1].transform(rows)
            rows = materialise(rows, f"stage-{number}") if fits else rows
    return PipelineModel(fitted), rows
