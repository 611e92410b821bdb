"""Date spines and grids. Lengths depend on the calendar, never on the data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def month_starts(start: dt.date | Column, as_of: dt.date | Column) -> Column:
    """Month starts from ``start`` (a first of a month) to ``as_of``'s month."""
    return F.sequence(F.lit(start), F.trunc(F.lit(as_of), "MM"), F.expr("interval 1 month"))


def month_end_spine(bounds: DataFrame, start: dt.date | Column, as_of: dt.date | Column, out: str = "date_date") -> DataFrame:
    """The day before each month start, for the one row of ``bounds`` (its columns may give the limits)."""
    return bounds.select(F.explode(month_starts(start, as_of)).alias(out)).withColumn(out, F.date_sub(out, 1))


def day_spine(bounds: DataFrame, start: dt.date | Column, as_of: dt.date | Column) -> DataFrame:
    """(ts_date, month) for every day from start to as_of."""
    days = F.sequence(F.lit(start), F.lit(as_of), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias("ts_date")).withColumn("month", F.trunc("ts_date", "MM"))


def one_row(spark: SparkSession) -> DataFrame:
    return spark.range(1)


def month_grid(classes: DataFrame, start: dt.date | Column, as_of: dt.date | Column, out: str = "date_date") -> DataFrame:
    """Every month end beside every row of ``classes``: a generator over the classes, so no cross join."""
    return classes.withColumn(out, F.explode(month_starts(start, as_of))).withColumn(out, F.date_sub(out, 1))
