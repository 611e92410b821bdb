"""Models on text: cards become word vectors, those become components, and components join the other features.

Each part is fitted on what the part before it wrote. Services without a card, and cards without words, stay: their
components are NULL, which the features replace by the training means.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame

from lossledger.models.components import SLOTS, PrincipalComponents, WordVectors
from lossledger.models.embed import join_embeddings
from lossledger.models.features import FeatureSpec
from lossledger.models.stages import FeatureEstimator, fit_staged
from lossledger.sources.tables import materialise


@dataclass(frozen=True)
class TextModel:
    """``text`` makes components of cards, ``model`` predicts from rows with components beside them."""

    text: PipelineModel
    model: PipelineModel
    keys: tuple[str, ...]

    def with_components(self, rows: DataFrame, cards: DataFrame) -> DataFrame:
        """Rows with the components of their card; rows without one keep NULLs."""
        found = self.text.transform(cards).select(*self.keys, *self.text.stages[-1].columns())
        return join_embeddings(rows, found, self.keys)

    def transform(self, rows: DataFrame, cards: DataFrame) -> DataFrame:
        return self.model.transform(self.with_components(rows, cards))


def fit_with_text(rows: DataFrame, cards: DataFrame, keys: Sequence[str], content: str, spec: FeatureSpec, model: Estimator, k: int = 32, slots: int = SLOTS) -> tuple[TextModel, DataFrame]:
    """Fit components of the cards (one per key) and a model on the spec's features and the components. Returns the models
    and the rows as the last one got them, features assembled."""
    cards = materialise(cards, "cards")  # read for the frequencies, their number and the vectors
    words = WordVectors(inputCol=content, outputCol="_words", slots=slots)
    text, seen = fit_staged(cards, [words, PrincipalComponents(inputCol="_words", size=slots, k=k)])
    components = text.stages[-1].columns()
    found = text.stages[-1].transform(seen).select(*keys, *components)
    joined = materialise(join_embeddings(rows, found, keys), "with-components")
    fitted, last = fit_staged(joined, [FeatureEstimator(replace(spec, passed=(*spec.passed, *components))), model])
    return TextModel(text, fitted, tuple(keys)), last
