"""Grouped operators. Each reduces on the map side first, and arrays are built from distinct values or counts, never
from the raw rows of a group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossledger.functions.rules import joined, nonempty


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """Values of the newest row per key, all taken from that one row. ``order`` ends in a tie breaker.

    A newest row with a NULL keeps the NULL.
    """
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in columns])


def distinct_array(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Sorted distinct non-NULL values per key, NULL when there is none. Distinct first, so a hot key's repeats
    never travel."""
    pairs = df.select(*keys, value).distinct()
    return pairs.groupBy(*keys).agg(nonempty(F.array_sort(F.collect_set(value))).alias(out))


def capped_distinct_array(df: DataFrame, keys: Sequence[str], value: str, out: str, cap: int = 10) -> DataFrame:
    """The ``cap`` smallest distinct values per key; no more than that many per key are ever gathered."""
    pairs = df.select(*keys, value).distinct()
    w = Window.partitionBy(*keys).orderBy(F.col(value).asc_nulls_last())
    top = pairs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= cap)
    return top.groupBy(*keys).agg(nonempty(F.array_sort(F.collect_list(value))).alias(out))


def repeated_text(df: DataFrame, keys: Sequence[str], value: str, out: str, sep: str = ", ") -> DataFrame:
    """All non-NULL values with repeats, sorted and joined: counted per value first, then written out."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).cast("int").alias("_n"))
    boxed = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct(value, "_n"))))
    flat = F.flatten(F.transform(boxed, lambda s: F.array_repeat(s[value], s["_n"])))
    return counts.groupBy(*keys).agg(joined(flat, sep).alias(out))


def melt(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """(keys, feature, value as text), one row per feature."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")) for f in features])
    return df.select(*keys, F.explode(pairs).alias("_p")).select(*keys, "_p.feature", "_p.value")


def distinct_lengths(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """(keys, feature, n distinct non-NULL values), NULL instead of 0. One pass for all features."""
    pairs = melt(df, keys, features).distinct()
    n = F.nullif(F.count("value"), F.lit(0))
    return pairs.groupBy(*keys, "feature").agg(n.alias("n_values"))


def rollup_levels(df: DataFrame, levels: Mapping[int, Column], class_col: str, keys: Sequence[str], sums: Sequence[str], level_col: str = "granularity_level") -> DataFrame:
    """Several relabellings of one class column, totalled in one pass: each row is tagged once per level and a
    single grouping covers all levels."""
    tags = F.array(*[F.struct(F.lit(n).alias("level"), label.alias("label")) for n, label in levels.items()])
    tagged = df.withColumn("_t", F.explode(tags))
    tagged = tagged.withColumn(level_col, F.col("_t.level")).withColumn(class_col, F.col("_t.label")).drop("_t")
    return tagged.groupBy(level_col, class_col, *keys).agg(*[F.sum(s).alias(s) for s in sums])

