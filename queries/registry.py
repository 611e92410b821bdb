"""Registry of (Spark callable, checking SQL) pairs and small helpers both sides share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossledger.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

SPARK: dict[str, Query] = {}
SQL: dict[str, str] = {}
MODULE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name; without SQL only its rows are checked."""

    def add(fn: Query) -> Query:
        if name in SPARK:
            raise ValueError(f"{name} is registered twice")
        MODULE[name] = fn.__module__.rsplit(".", 1)[-1]
        SPARK[name] = lambda spark, sf: plain(fn(spark, sf))
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


class Tables:
    """Driver tables by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        table = read_table(self._spark, self._folder, name)
        setattr(self, name, table)
        return table


def plain(df: DataFrame) -> DataFrame:
    """Results in types every client shows alike: decimals as doubles, dates as text, lists as joined text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), "|")
        out.append(c.alias(f.name))
    return df.select(*out)


# --- SQL fragments used by several checks -------------------------------------------------------------------------


def sql_ratio(num: str, den: str, digits: int) -> str:
    """Exact half-up rounding of an integer ratio, as a double; NULL on a zero denominator."""
    n, d = f"CAST({num} AS HUGEINT)", f"NULLIF(CAST({den} AS HUGEINT), 0)"
    size = f"((2 * ABS({n}) * {10**digits} + ABS({d})) // (2 * ABS({d})))"
    return f"(SIGN({n}) * SIGN({d}) * CAST({size} AS DOUBLE) / {10**digits})"


def sql_cents(amount: str) -> str:
    """A decimal(18,2) amount as integer cents."""
    return f"CAST(CAST({amount} AS DECIMAL(18,2)) * 100 AS BIGINT)"


def sql_local_date(ts: str) -> str:
    return f"CAST((({ts}) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Mexico_City' AS DATE)"
