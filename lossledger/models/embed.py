"""Text cards, text vectors and their reduction."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, PCA, HashingTF, Normalizer, RegexTokenizer, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_card(fields: Sequence[tuple[str, Column]]) -> Column:
    """'name: value, name: value, ...'; the values must already have their defaults."""
    parts = []
    for i, (name, value) in enumerate(fields):
        parts += [F.lit(f"{', ' if i else ''}{name}: "), value.cast("string")]
    return F.concat(*parts)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def number_or_minus_one(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(-1))


def service_card() -> Column:
    """Card of a wide-table row."""
    external = F.when(F.col("doctorfriend_name").isNotNull(), "yes").otherwise("no")
    # The field captions.
    return text_card(
        [
            ("service type", text_or_empty("service_type")),
            ("service specification", text_or_empty("services_specification")),
            ("service category", text_or_empty("caseevent_category")),
            ("service class", text_or_empty("caseevent_class")),
            ("provider category name", text_or_empty("provider_category_name")),
            ("provider network", text_or_empty("provider_network")),
            ("procedure CPT (Current Procedural Terminology)", text_or_empty("cpt")),
            ("diagnosis", text_or_empty("diagnosis")),
            ("is a external doctor?", external),
            ("doctor specialties", text_or_empty("doctor_descriptor")),
            ("patient occupation", text_or_empty("member_occupation")),
            ("patient weight kg", number_or_minus_one("member_weight_kg")),
            ("patient height cm", number_or_minus_one("member_height_cm")),
            ("patient gender", text_or_empty("member_gender")),
            ("patient age", number_or_minus_one("member_age_at_subscription")),
        ]
    )


def embedding_stages(text: str, out: str, size: int = 256) -> Pipeline:
    """Words hashed into ``size`` counts, weighted by inverse document frequency, scaled to unit length. The fitted
    state is one number per hash slot."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"[^\p{L}\p{N}]+"),
            HashingTF(inputCol="_words", outputCol="_counts", numFeatures=size),
            IDF(inputCol="_counts", outputCol="_weighted"),
            Normalizer(inputCol="_weighted", outputCol=out),
        ]
    )


def embed(df: DataFrame, model: PipelineModel, out: str) -> DataFrame:
    return model.transform(df).withColumn(out, vector_to_array(F.col(out))).drop("_words", "_counts", "_weighted")


def embed_with(df: DataFrame, key: Sequence[str], text: str, out: str, encoder: Callable[[Sequence[str]], Sequence[Sequence[float]]]) -> DataFrame:
    """Vectors from any batch encoder, called on Arrow batches inside the tasks."""
    schema = T.StructType([df.schema[k] for k in key] + [T.StructField(out, T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            result = batch[list(key)].copy()
            result[out] = [list(map(float, v)) for v in encoder(batch[text].tolist())]
            yield result

    return df.select(*key, text).mapInPandas(run, schema)


def reduction_stages(vector: str, out: str, k: int = 32) -> Pipeline:
    """Centred, unscaled principal components. (The projection itself does not centre, so a scaler does.)"""
    return Pipeline(
        stages=[
            StandardScaler(inputCol=vector, outputCol="_centred", withMean=True, withStd=False),
            PCA(inputCol="_centred", outputCol=out, k=k),
        ]
    )


def as_vectors(df: DataFrame, column: str, out: str = "vector") -> DataFrame:
    """Array column as an ml vector; rows without one are left out, as they cannot be projected."""
    return df.where(F.col(column).isNotNull()).withColumn(out, array_to_vector(F.col(column).cast("array<double>")))


def component_columns(df: DataFrame, column: str, k: int, prefix: str = "principal_component_") -> DataFrame:
    arr = vector_to_array(F.col(column))
    return df.select("*", *[arr[i].alias(f"{prefix}{i + 1}") for i in range(k)]).drop(column)


def join_embeddings(fact: DataFrame, vectors: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Vectors beside the facts; a NULL key part never matches."""
    return fact.join(vectors, list(keys), "left")
