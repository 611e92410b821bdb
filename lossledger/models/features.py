"""Feature transforms fitted once and applied on predict.

Fitted state is either a few numbers (cut points, median, spread) or a code table kept as a DataFrame, never a
vocabulary on the driver. Transforming is projections and lookup joins.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossledger.functions.rules import range_band, safe_ratio
from lossledger.operators.aggregates import melt
from lossledger.operators.ordered import grouped_bucket, grouped_split_points, range_bucket, with_row_number, with_running_sum
from lossledger.sources.tables import materialise, save_table

# Age bands and body-mass bands of the cluster reports.
AGE_BANDS = (
    (0, 2, "Infants and Toddlers (0-2)"),
    (3, 5, "Early Childhood (3-5)"),
    (6, 12, "Children (6-12)"),
    (13, 18, "Adolescents (13-18)"),
    (19, 34, "Young Adults (19-34)"),
    (35, 49, "Adults (35-49)"),
    (50, 64, "Middle-Aged Adults (50-64)"),
    (65, 79, "Seniors (65-79)"),
    (80, None, "Elderly (80+)"),
)
BMI_UNDER, BMI_UNDER_LABEL = 18.5, "Underweight"
BMI_BANDS = (
    (18.5, 24.9, "Normal weight"),
    (25, 29.9, "Overweight"),
    (30, 34.9, "Obesity Class I (Moderate)"),
    (35, 39.9, "Obesity Class II (Severe)"),
    (40, None, "Obesity Class III (Very severe or morbid obesity)"),
)


def body_mass(weight_kg: Column, height_cm: Column) -> Column:
    return safe_ratio(10000.0 * weight_kg, (height_cm * height_cm).cast("double"))


def age_band(age: Column) -> Column:
    return range_band(age, AGE_BANDS)


def body_mass_band(weight_kg: Column, height_cm: Column) -> Column:
    bmi = body_mass(weight_kg.cast("bigint"), height_cm.cast("bigint"))
    return F.when(bmi < BMI_UNDER, BMI_UNDER_LABEL).otherwise(range_band(bmi, BMI_BANDS))


def code_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, code) for all columns in one pass: 1, 2, ... over each one's sorted distinct values (as
    text). Values are numbered range by range, so no task sorts a whole vocabulary."""
    values = melt(df, [], columns).where(F.col("value").isNotNull()).distinct()
    values = materialise(values, "vocabulary")
    points = grouped_split_points(values, "feature", "value")
    bucket = grouped_bucket(F.col("feature"), F.col("value"), points)
    return with_row_number(values, ["feature"], ["value"], bucket, "code")


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code) of one column."""
    return code_table(df, [column]).select("value", "code")


def encode_label(df: DataFrame, codes: DataFrame, column: str, out: str) -> DataFrame:
    """The code of each value; 0 for NULL and for values not seen in fitting."""
    side = codes.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    found = df.join(side, F.col("_value") == F.col(column).cast("string"), "left")
    return found.withColumn(out, F.coalesce("_code", F.lit(0)).cast("bigint")).drop("_value", "_code")


#: Vocabularies of up to so many values are comparisons in the plan; larger ones are joined.
IN_PLAN = 256


def code_of(x: Column, known: Sequence[tuple[str, int]]) -> Column:
    """The code of a text among a few known ones, sorted: a balanced comparison tree; 0 for any other and for NULL."""

    def tree(lo: int, hi: int) -> Column:
        if hi - lo == 1:
            return F.when(x == F.lit(known[lo][0]), F.lit(known[lo][1])).otherwise(F.lit(0))
        mid = (lo + hi) // 2
        return F.when(x < F.lit(known[mid][0]), tree(lo, mid)).otherwise(tree(mid, hi))

    return (tree(0, len(known)) if known else F.lit(0)).cast("bigint")


@dataclass(frozen=True)
class Codes:
    """Codes of several features: all in a table, those of small vocabularies also here."""

    table: DataFrame
    sizes: dict[str, int]
    small: dict[str, list[tuple[str, int]]]

    @classmethod
    def of(cls, table: DataFrame) -> Codes:
        sizes = {r[0]: r[1] for r in table.groupBy("feature").agg(F.max("code")).collect()}
        small: dict[str, list[tuple[str, int]]] = {f: [] for f, n in sizes.items() if n <= IN_PLAN}
        if small:  # at most IN_PLAN rows for each feature
            for r in table.where(F.col("feature").isin(list(small))).collect():
                small[r["feature"]].append((r["value"], r["code"]))
        return cls(table, sizes, {f: sorted(v, key=lambda p: p[0].encode()) for f, v in small.items()})

    def encode(self, df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
        """Adds codes; ``columns`` maps features to output names. One projection for all small vocabularies, and a join
        for each large one."""
        few = {out: code_of(F.col(c).cast("string"), self.small.get(c, [])) for c, out in columns.items() if self.sizes.get(c, 0) <= IN_PLAN}
        df = df.withColumns(few) if few else df
        for c, out in columns.items():
            if out not in few:
                df = encode_label(df, self.table.where(F.col("feature") == c), c, out)
        return df


def exact_quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]]) -> dict[str, list[float]]:
    """Interpolated quantiles of several columns, exact at any size, in one pass over the table.

    Values are counted, the counts are summed up range by range, and only the asked-for order statistics reach the
    driver (two per probability).
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in wanted])
    flat = df.select(F.explode(pairs).alias("p")).select("p.feature", "p.v").where(F.col("v").isNotNull())
    counts = materialise(flat.groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n")), "value_counts")
    totals = {r[0]: r[1] for r in counts.groupBy("feature").agg(F.sum("n")).collect()}
    missing = [c for c in wanted if not totals.get(c)]
    if missing:
        raise ValueError(f"no values in {missing}")
    points = grouped_split_points(counts, "feature", "v")
    ranked = with_running_sum(counts, ["feature"], ["v"], "n", grouped_bucket(F.col("feature"), F.col("v"), points), "upto")

    places = {c: [p * (totals[c] - 1) for p in probs] for c, probs in wanted.items()}
    ranks = {c: sorted({min(int(x) + i, totals[c] - 1) for x in xs for i in (0, 1)}) for c, xs in places.items()}
    at = [
        F.min(F.when((F.col("feature") == c) & (F.col("upto") > r), F.col("v"))).alias(f"{i}_{r}")
        for i, c in enumerate(wanted)
        for r in ranks[c]
    ]
    row = ranked.agg(*at).first()
    out = {}
    for i, (c, xs) in enumerate(places.items()):
        low = [row[f"{i}_{int(x)}"] for x in xs]
        high = [row[f"{i}_{min(int(x) + 1, totals[c] - 1)}"] for x in xs]
        out[c] = [a + (b - a) * (x - int(x)) for a, b, x in zip(low, high, xs)]
    return out


def cut_probs(buckets: int) -> list[float]:
    return [i / buckets for i in range(1, buckets)]


def quantile_cuts(df: DataFrame, column: str, buckets: int) -> list[float]:
    return sorted(set(exact_quantiles(df, {column: cut_probs(buckets)})[column]))


def bucket_label(x: Column, cuts: Sequence[float]) -> Column:
    """'bin_1' below the first cut point, the next one from a cut point on; NULL stays NULL."""
    return F.when(x.isNotNull(), F.concat(F.lit("bin_"), (range_bucket(x, cuts) + 1).cast("string")))


QUARTILES = (0.25, 0.5, 0.75)


def robust_params(df: DataFrame, column: str) -> tuple[float, float]:
    """(median, interquartile range)."""
    q1, median, q3 = exact_quantiles(df, {column: QUARTILES})[column]
    return median, q3 - q1


def robust_scale(x: Column, median: float, spread: float) -> Column:
    return safe_ratio(x.cast("double") - F.lit(median), F.lit(spread))


def feature_cross(*cols: Column, sep: str = "_") -> Column:
    """Values joined into one category; NULL when one is NULL."""
    parts = [cols[0]]
    for c in cols[1:]:
        parts += [F.lit(sep), c]
    return F.concat(*parts)


def training_window(df: DataFrame, day: str, until: Column) -> DataFrame:
    """Rows of the year that ends the day before ``until``."""
    return df.where(F.col(day).cast("date").between(F.add_months(until, -12), F.date_sub(until, 1)))


@dataclass(frozen=True)
class FeatureSpec:
    """Which transform each column gets. Model variants are different specs."""

    labels: tuple[str, ...] = ()
    buckets: tuple[tuple[str, int], ...] = ()
    scaled: tuple[str, ...] = ()
    crosses: tuple[tuple[str, ...], ...] = ()
    passed: tuple[str, ...] = ()

    def as_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_dict(cls, raw: Mapping) -> FeatureSpec:
        return cls(
            labels=tuple(raw.get("labels", ())),
            buckets=tuple((c, n) for c, n in raw.get("buckets", ())),
            scaled=tuple(raw.get("scaled", ())),
            crosses=tuple(tuple(x) for x in raw.get("crosses", ())),
            passed=tuple(raw.get("passed", ())),
        )


@dataclass
class FeatureModel:
    """A fitted FeatureSpec: one code table for all labels and one for all categories, cut points, medians and spreads,
    and the mean of each number."""

    spec: FeatureSpec
    codes: Codes | None = None
    cuts: dict[str, list[float]] = field(default_factory=dict)
    scale: dict[str, tuple[float, float]] = field(default_factory=dict)
    categories: Codes | None = None
    means: dict[str, float] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, spec: FeatureSpec) -> FeatureModel:
        """One pass over the table for all label vocabularies, one for all quantiles, and one each for the categories
        and means that follow from them."""
        model = cls(spec)
        if spec.labels:
            model.codes = Codes.of(materialise(code_table(df, spec.labels), "codes"))
        asked: dict[str, list[float]] = {}
        for c, n in spec.buckets:
            asked.setdefault(c, []).extend(cut_probs(n))
        for c in spec.scaled:
            asked.setdefault(c, []).extend(QUARTILES)
        if asked:
            found = exact_quantiles(df, asked)
            for c, n in spec.buckets:
                model.cuts[c] = sorted(set(found[c][: n - 1]))
            for c in spec.scaled:
                q1, median, q3 = found[c][-3:]
                model.scale[c] = (median, q3 - q1)
        rows = model.transform(df)
        if model.category_columns():
            model.categories = Codes.of(materialise(code_table(rows, model.category_columns()), "categories"))
        if model.numeric_columns():
            found = rows.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in model.numeric_columns()]).first()
            model.means = {c: found[c] or 0.0 for c in model.numeric_columns()}
        return model

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds the coded columns: <c>_code, <c>_bucket, <c>_scaled and crosses as a_x_b."""
        out = self.codes.encode(df, {c: f"{c}_code" for c in self.spec.labels}) if self.spec.labels else df
        added = {}
        for c, cuts in self.cuts.items():
            added[f"{c}_bucket"] = bucket_label(F.col(c).cast("double"), cuts)
        for c, (median, spread) in self.scale.items():
            added[f"{c}_scaled"] = robust_scale(F.col(c), median, spread)
        for cross in self.spec.crosses:
            added["_x_".join(cross)] = feature_cross(*[F.col(c) for c in cross])
        return out.withColumns(added) if added else out

    def numeric_columns(self) -> list[str]:
        return [f"{c}_code" for c in self.spec.labels] + [f"{c}_scaled" for c in self.scale] + list(self.spec.passed)

    def category_columns(self) -> list[str]:
        return [f"{c}_bucket" for c in self.cuts] + ["_x_".join(x) for x in self.spec.crosses]

    def size(self, category: str) -> int:
        """Known values of a category column."""
        return self.categories.sizes.get(category, 0)

    def assemble(self, df: DataFrame, out: str = "features") -> DataFrame:
        """One vector per row: numbers as they are (NULL as the mean in training), and a slot of its own for every
        category; slot 0 of a column is for NULL and for what training had not."""
        rows = self.transform(df)
        numbers, kinds = self.numeric_columns(), self.category_columns()
        rows = rows.withColumns({f"_n_{c}": F.coalesce(F.col(c).cast("double"), F.lit(self.means[c])) for c in numbers})
        inputs, slots = [f"_n_{c}" for c in numbers], [f"_s_{c}" for c in kinds]
        if kinds:
            rows = self.categories.encode(rows, {c: f"_s_{c}" for c in kinds})
            # with the number of slots in the column's description, the encoder needs no pass over the rows
            known = {c: {"ml_attr": {"type": "nominal", "name": f"_s_{c}", "num_vals": self.size(c) + 1}} for c in kinds}
            rows = rows.withColumns({f"_s_{c}": F.col(f"_s_{c}").cast("double").alias(f"_s_{c}", metadata=known[c]) for c in kinds})
            encoder = OneHotEncoder(inputCols=slots, outputCols=[f"_o_{c}" for c in kinds], dropLast=False)
            rows, inputs = encoder.fit(rows).transform(rows), [*inputs, *encoder.getOutputCols()]
        rows = VectorAssembler(inputCols=inputs, outputCol=out).transform(rows)
        return rows.drop(*inputs, *slots)

    def inputs(self) -> tuple[list[str], list[int]]:
        """The inputs in order, and for every place of the vector which of them it belongs to."""
        names = [*self.numeric_columns(), *self.category_columns()]
        widths = [1] * len(self.numeric_columns()) + [self.size(c) + 1 for c in self.category_columns()]
        return names, [i for i, n in enumerate(widths) for _ in range(n)]

    def feature_table(self, spark: SparkSession) -> DataFrame:
        """(pos, processed_input, category) of every place in the vector; numbers have no category."""
        places, at = [(i, c, None) for i, c in enumerate(self.numeric_columns())], len(self.numeric_columns())
        first = {}
        for c in self.category_columns():
            first[c] = at
            places.append((at, c, "(none)"))
            at += self.size(c) + 1
        out = spark.createDataFrame(places, "pos long, processed_input string, category string")
        if self.categories is None:
            return out
        begin = F.create_map(*[F.lit(x) for kv in first.items() for x in kv])[F.col("feature")]
        return out.unionByName(self.categories.table.select((begin + F.col("code")).alias("pos"), F.col("feature").alias("processed_input"), F.col("value").alias("category")))

    def numbers(self) -> dict:
        """What is fitted besides the code tables."""
        return {"cuts": self.cuts, "scale": self.scale, "means": self.means}

    def code_tables(self) -> dict[str, DataFrame]:
        return {name: c.table for name, c in (("codes", self.codes), ("categories", self.categories)) if c is not None}

    @classmethod
    def restored(cls, spec: FeatureSpec, numbers: Mapping, table: Callable[[str], DataFrame]) -> FeatureModel:
        codes = Codes.of(table("codes")) if spec.labels else None
        categories = Codes.of(table("categories")) if spec.buckets or spec.crosses else None
        return cls(spec, codes, numbers["cuts"], {c: tuple(v) for c, v in numbers["scale"].items()}, categories, numbers["means"])

    def save(self, path: str) -> None:
        """The code tables as parquet, the numbers as one JSON row."""
        spark = SparkSession.getActiveSession()
        state = json.dumps({"spec": self.spec.as_dict(), **self.numbers()})
        spark.createDataFrame([(state,)], "state string").write.mode("overwrite").json(os.path.join(path, "state"))
        for name, table in self.code_tables().items():
            save_table(table, os.path.join(path, name))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureModel:
        state = json.loads(spark.read.schema("state string").json(os.path.join(path, "state")).first()[0])
        return cls.restored(FeatureSpec.from_dict(state["spec"]), state, lambda name: spark.read.parquet(os.path.join(path, name)))
