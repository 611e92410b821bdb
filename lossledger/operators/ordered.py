"""Ordered-window operators that do not put a whole key into one task.

A plain window sorts all rows of a partition key in one task, so one hot key, or a window with no key, is one
straggler. Here rows are first cut into buckets along the order (a time slot, an id block, a value range). Each
bucket is summarised with a map-side aggregate, the small summary is scanned in order, and what it carries into a
bucket is joined back to the rows, which are then windowed inside (key, bucket) only. Results equal the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossledger.sources.tables import materialise

_B = "_bucket"


def id_block(col: Column, width: int = 1_000_000) -> Column:
    """Bucket of a unique integer id: at most ``width`` rows each."""
    return F.floor(col / F.lit(width)).cast("bigint")


def time_slot(ts: Column, seconds: int = 6 * 3600) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("bigint")


def split_points(df: DataFrame, column: str, parts: int | None = None, per_part: int = 20) -> list:
    """Values that cut the distinct values of a column into about equal ranges, from a bounded hash sample.

    The cut only balances work; no result depends on it.
    """
    one = df.select(F.lit(0).alias("_g"), F.col(column).alias("_v"))
    return grouped_split_points(one, "_g", "_v", parts, per_part).get(0, [])


def grouped_split_points(df: DataFrame, group: str, column: str, parts: int | None = None, per_part: int = 20) -> dict:
    """Split points per group in one pass, for a few groups (features). The sample of a group is its rows with the
    smallest hashes, cut to parts * per_part before the shuffle, so that is all a task or the driver ever holds."""
    parts = parts or _default_parts(df)
    values = df.select(group, column).where(F.col(column).isNotNull()).distinct()
    w = Window.partitionBy(group).orderBy(F.xxhash64(column))
    sample = values.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= parts * per_part)
    found: dict = {}
    for row in sample.select(group, column).collect():
        found.setdefault(row[0], []).append(row[1])
    out = {}
    for g, v in found.items():
        v.sort()
        step = max(1, len(v) // parts)
        out[g] = v[step::step][: parts - 1]
    return out


def grouped_bucket(group: Column, col: Column, points: dict) -> Column:
    """range_bucket with each group's own points."""
    out = F.lit(0).cast("bigint")
    for g, p in points.items():
        out = F.when(group == F.lit(g), range_bucket(col, p)).otherwise(out)
    return out


def _default_parts(df: DataFrame) -> int:
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(4, wanted)


def range_bucket(col: Column, points: Sequence) -> Column:
    """Index of the range that holds the value: a balanced comparison tree, so log2(len(points)) comparisons."""

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(col < F.lit(points[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(points)).cast("bigint")


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def _attach(rows: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of a bucket summary on keys that may be NULL."""
    extra = [c for c in summary.columns if c not in keys]
    return rows.join(summary, _same(rows, summary, keys), "left").select(rows["*"], *[summary[c] for c in extra])


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    bucket: Column,
    prev: str | None = None,
    next: str | None = None,
) -> DataFrame:
    """LAG and/or LEAD of ``value`` by one row, per ``keys``, in ``order`` (which must be a total order)."""
    keys, by = list(keys), [*keys, _B]
    rows = df.withColumn(_B, bucket)
    boxed, rank = F.struct(F.col(value).alias("v")), F.struct(*order)
    summary = rows.groupBy(*by).agg(F.min_by(boxed, rank).alias("_first"), F.max_by(boxed, rank).alias("_last"))
    across = Window.partitionBy(*keys).orderBy(_B)
    carried = {}
    if prev:
        carried["_carry_prev"] = F.lag("_last").over(across)
    if next:
        carried["_carry_next"] = F.lead("_first").over(across)
    summary = summary.withColumns(carried).drop("_first", "_last")
    inside = Window.partitionBy(*by).orderBy(*order)
    out, added = _attach(rows, summary, by), {}
    if prev:
        added[prev] = F.coalesce(F.lag(boxed).over(inside), F.col("_carry_prev"))["v"]
    if next:
        added[next] = F.coalesce(F.lead(boxed).over(inside), F.col("_carry_next"))["v"]
    return out.withColumns(added).drop(_B, *carried)


def with_running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, bucket: Column, out: str) -> DataFrame:
    """Sum of ``value`` over all rows up to and including this one."""
    keys, by = list(keys), [*keys, _B]
    rows = df.withColumn(_B, bucket)
    before = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    summary = rows.groupBy(*by).agg(F.sum(value).alias("_sum")).withColumn("_before", F.sum("_sum").over(before)).drop("_sum")
    inside = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(value).over(inside) + F.coalesce(F.col("_before"), F.lit(0))
    return _attach(rows, summary, by).withColumn(out, total).drop(_B, "_before")


def with_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, out: str) -> DataFrame:
    one = df.withColumn("_one", F.lit(1).cast("bigint"))
    return with_running_sum(one, keys, order, "_one", bucket, out).drop("_one")


def with_last_known(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, bucket: Column, out: str) -> DataFrame:
    """The latest non-NULL ``value`` at or before each row."""
    keys, by = list(keys), [*keys, _B]
    rows = df.withColumn(_B, bucket)
    known = F.struct(*[F.when(F.col(value).isNotNull(), F.col(o)).alias(o) for o in order])
    latest = F.max_by(value, F.when(F.col(value).isNotNull(), known))
    before = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    summary = rows.groupBy(*by).agg(latest.alias("_v")).withColumn("_before", F.last("_v", ignorenulls=True).over(before)).drop("_v")
    inside = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = F.coalesce(F.last(value, ignorenulls=True).over(inside), F.col("_before"))
    return _attach(rows, summary, by).withColumn(out, filled).drop(_B, "_before")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key. ``row_number() = 1`` becomes a group limit before the shuffle, so each map task sends at
    most one row per key and a hot key costs no more than any other. ``order`` must break ties."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


# A key with more than this share of the rows is hot; there can be at most 1 / share of them.
HOT_SHARE = 1 / 1000


def always_zero(*cols: Column) -> Column:
    """0, computed from columns: a constant would be folded away, and with it its part in a join's partitioning."""
    return F.pmod(F.xxhash64(*cols), F.lit(1).cast("bigint"))


def join_summary(rows: DataFrame, summary: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    """Join a per-key summary (one row per key, with the number of ``rows`` of the key) back to the rows.

    Hot keys are at most a thousand by their definition, so their summary rows are broadcast, and the rows
    themselves are spread by a salt; all other keys meet in a shuffle join. The salt also keeps a later grouping by
    the same key from reusing the join's partitioning, so that grouping reduces before its own shuffle.
    """
    keys = list(keys)
    # Written once: read three times below, and by the plans of further keys, whose work would multiply otherwise.
    summary = materialise(summary, "key-summary")
    extras = [c for c in summary.columns if c not in keys and c != count]
    total = summary.agg(F.sum(count)).scalar()
    packed = F.struct(*extras)
    hot = summary.where(F.col(count) > total * F.lit(HOT_SHARE))
    hot = F.broadcast(hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys], packed.alias("_hot")))
    found = rows.join(hot, reduce(lambda a, b: a & b, [rows[k].eqNullSafe(hot[f"_h_{k}"]) for k in keys]), "left")
    spread = F.pmod(F.xxhash64(*[rows[c] for c in rows.columns]), F.lit(2**62)) + 1
    found = found.withColumn("_salt", F.when(F.col("_hot").isNotNull(), spread).otherwise(F.lit(0)))
    cold = summary.select(*[F.col(k).alias(f"_c_{k}") for k in keys], packed.alias("_cold"), always_zero(*[F.col(k) for k in keys]).alias("_zero"))
    same = [found[k].eqNullSafe(cold[f"_c_{k}"]) for k in keys] + [found["_salt"] == cold["_zero"]]
    both = found.join(cold, reduce(lambda a, b: a & b, same), "left")
    value = F.coalesce("_hot", "_cold")
    return both.select(*rows.columns, *[value[c].alias(c) for c in extras])


def with_key_aggregate(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """Whole-partition window aggregates as a grouped aggregate joined back: partial sums go through the shuffle
    instead of rows, and a hot key's rows stay spread, where a window would gather them in one task."""
    summary = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()], F.count(F.lit(1)).alias("_n"))
    return join_summary(df, summary, keys, "_n")
