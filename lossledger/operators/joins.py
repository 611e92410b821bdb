"""Join shapes the insurance queries need. Sizes are left to adaptive execution: a side is broadcast only when its
measured size allows, and skewed partitions of a sort-merge join are split."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossledger.functions.rules import OPEN_END
from lossledger.operators.ordered import always_zero, id_block, range_bucket, split_points
from lossledger.sources.tables import materialise


def join_role(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, columns: Mapping[str, str], when: Column | None = None) -> DataFrame:
    """Left join one dimension in one role. ``columns`` maps dimension columns to output names, so the same
    dimension can be joined many times; ``when`` restricts the fact rows that may match (a type tag).

    Rows without a key, and those of other tags, match nothing. In a shuffle they would all meet at the hash of NULL, so
    they are spread by a second key, which is 0 for rows that can match and in the dimension.
    """
    key = F.col(fact_key) if when is None else F.when(when, F.col(fact_key))
    others = [c for c in fact.columns if c != fact_key][:1]
    spread = F.when(key.isNull(), F.xxhash64(fact_key, *others)).otherwise(0)
    side = dim.select(F.col(dim_key).alias("_dim_key"), always_zero(F.col(dim_key)).alias("_dim_spread"), *[F.col(c).alias(o) for c, o in columns.items()])
    keyed = fact.withColumn("_fact_key", key).withColumn("_fact_spread", spread)
    found = keyed.join(side, (F.col("_fact_key") == F.col("_dim_key")) & (F.col("_fact_spread") == F.col("_dim_spread")), "left")
    return found.drop("_fact_key", "_fact_spread", "_dim_key", "_dim_spread")


def join_by_type(fact: DataFrame, type_col: str, id_col: str, targets: Mapping[int, tuple[DataFrame, str, Mapping[str, str]]]) -> DataFrame:
    """Polymorphic reference: (type tag, object id) looked up in the table the tag names."""
    for tag, (dim, dim_key, columns) in targets.items():
        fact = join_role(fact, dim, id_col, dim_key, columns, when=F.col(type_col) == tag)
    return fact


def join_valid_at(
    fact: DataFrame,
    validity: DataFrame,
    fact_key: str,
    key: str,
    at: Column,
    start: str,
    end: str,
    columns: Mapping[str, str],
) -> DataFrame:
    """Left join on a key plus "the date lies in [start, end]"; a NULL end is open. The key keeps it an equi-join."""
    side = validity.select(
        F.col(key).alias("_v_key"),
        F.col(start).alias("_v_from"),
        F.coalesce(F.col(end), F.lit(OPEN_END).cast("date")).alias("_v_to"),
        *[F.col(c).alias(o) for c, o in columns.items()],
    )
    f = fact.withColumn("_at", at)
    cond = (f[fact_key] == side["_v_key"]) & (f["_at"] >= side["_v_from"]) & (f["_at"] <= side["_v_to"])
    return f.join(side, cond, "left").drop("_v_key", "_v_from", "_v_to", "_at")


def explode_active_days(intervals: DataFrame, start: str, end: str, first: Column, last: Column, out: str = "ts_date") -> DataFrame:
    """One row per interval and day it covers within [first, last]: the theta join "start <= day <= end" as a
    generator over the intervals, so nothing is compared pairwise."""
    lo = F.greatest(F.col(start), first)
    hi = F.least(F.coalesce(F.col(end), F.lit(OPEN_END).cast("date")), last)
    return intervals.where(lo <= hi).withColumn(out, F.explode(F.sequence(lo, hi, F.expr("interval 1 day"))))


def explode_active_months(intervals: DataFrame, start: str, end: str, first: Column, last: Column) -> DataFrame:
    """One row per interval and calendar month it touches, with the number of covered days and of days in the month."""
    lo = F.greatest(F.col(start), first)
    hi = F.least(F.coalesce(F.col(end), F.lit(OPEN_END).cast("date")), last)
    months = F.sequence(F.trunc(lo, "MM"), F.trunc(hi, "MM"), F.expr("interval 1 month"))
    rows = intervals.where(lo <= hi).withColumn("_lo", lo).withColumn("_hi", hi).withColumn("month", F.explode(months))
    covered = F.datediff(F.least(F.col("_hi"), F.last_day("month")), F.greatest(F.col("_lo"), F.col("month"))) + 1
    return rows.withColumn("covered_days", covered).withColumn("month_days", F.dayofmonth(F.last_day("month"))).drop("_lo", "_hi")


def join_member_of(left: DataFrame, key: str, right: DataFrame, array_col: str, how: str = "left") -> DataFrame:
    """Join on "key is an element of the array" as an equi-join on the exploded array."""
    flat = right.withColumn("_el", F.explode(F.array_distinct(F.col(array_col))))
    return left.join(flat, left[key] == flat["_el"], how).drop("_el")


def _id_ranges(df: DataFrame, id_col: str, width: int | None) -> Column:
    """Cuts ids into blocks of ``width``, or at split points into about as many ranges as a shuffle has partitions."""
    return id_block(F.col(id_col), width) if width else range_bucket(F.col(id_col), split_points(df, id_col))


def breakpoints(prices: DataFrame, id_col: str, price_col: str, width: int | None = None) -> DataFrame:
    """Distinct prices ordered by the smallest id that has them, as contiguous id ranges.

    The first range starts at id 1, the last one ends at the largest id. Prices are ordered range by range; what follows a
    range is the first id of the next range that has any, so one row per range reaches the driver.
    """
    spark = prices.sparkSession
    known = prices.where(F.col(price_col).isNotNull() & F.col(id_col).isNotNull())
    starts = materialise(known.groupBy(price_col).agg(F.min(id_col).alias("first_id")), "price-starts")
    starts = starts.withColumn("_range", _id_ranges(starts, "first_id", width))
    begins = sorted(starts.groupBy("_range").agg(F.min("first_id")).collect())
    after = [b[1] for b in begins[1:]] + [prices.agg(F.max(id_col) + 1).first()[0]]
    follows = spark.createDataFrame([(b[0], a) for b, a in zip(begins, after)], "_range long, _after long")
    along = Window.partitionBy("_range").orderBy("first_id", price_col)
    ranked = starts.withColumns({"_rn": F.row_number().over(along), "_next": F.lead("first_id").over(along)}).join(F.broadcast(follows), "_range")
    very_first = (F.col("_rn") == 1) & (F.col("_range") == F.lit(begins[0][0] if begins else None).cast("long"))
    return ranked.select(
        price_col,
        F.when(very_first, F.lit(1)).otherwise(F.col("first_id")).cast("bigint").alias("first_id"),
        (F.coalesce("_next", "_after") - 1).cast("bigint").alias("last_id"),
    )


def fill_from_breakpoints(prices: DataFrame, id_col: str, price_col: str, out: str, width: int | None = None) -> DataFrame:
    """The price of the id range each row falls in. As-of fill: range starts are laid among the ids and the latest
    start is carried forward, instead of comparing every id with every range. Ids are cut at split points of their own, so
    they may be dense, sparse or hashed; the price that holds when a range begins comes from the last earlier range that
    has a start, so one row per range reaches the driver. Of prices that start at one id the last in order holds."""
    kind = prices.schema[price_col].dataType
    ranges = breakpoints(prices, id_col, price_col, width).where("last_id >= first_id")
    marks = ranges.select(F.col("first_id").alias(id_col), F.col(price_col).alias("_price"), F.lit(0).alias("_kind"))
    rows = prices.select(id_col).where(F.col(id_col).isNotNull()).distinct().select(id_col, F.lit(None).cast(kind).alias("_price"), F.lit(1).alias("_kind"))
    laid = materialise(marks.unionByName(rows), "laid-prices").withColumn("_range", _id_ranges(rows, id_col, width))
    last, carried = None, []
    newest = F.max_by("_price", F.when(F.col("_kind") == 0, F.col(id_col)))
    for bucket, price in sorted(laid.groupBy("_range").agg(newest).collect(), key=lambda r: r[0]):
        carried.append((bucket, last))
        last = price if price is not None else last
    fields = T.StructType([T.StructField("_range", T.LongType()), T.StructField("_carried", kind)])
    before = prices.sparkSession.createDataFrame(carried, fields)
    inside = Window.partitionBy("_range").orderBy(id_col, "_kind").rowsBetween(Window.unboundedPreceding, 0)
    filled = laid.withColumn("_latest", F.last("_price", ignorenulls=True).over(inside)).where("_kind = 1").join(F.broadcast(before), "_range")
    return prices.join(filled.select(id_col, F.coalesce("_latest", "_carried").alias(out)), id_col, "left")
