"""Scans, projections, filters, set operations, sorting."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from lossledger.functions.rules import local_date
from lossledger.models.features import AGE_BANDS, age_band
from lossledger.operators.spines import day_spine, month_end_spine
from lossledger.sources.tables import current_table, replace_table, save_table, work_folder
from queries.registry import Tables, query, sql_local_date


def sql_bands(x: str, bands=AGE_BANDS, default: str = "Unknown") -> str:
    whens = " ".join(f"WHEN {x} >= {lo}" + (f" AND {x} <= {hi}" if hi is not None else "") + f" THEN '{label}'" for lo, hi, label in bands)
    return f"CASE {whens} ELSE '{default}' END"


@query("scan_project", "SELECT o_orderkey AS plan_id, o_custkey AS member_id, o_totalprice AS premium, o_orderstatus AS state FROM orders")
def scan_project(spark, sf):
    o = Tables(spark, sf).orders
    return o.select(
        F.col("o_orderkey").alias("plan_id"), F.col("o_custkey").alias("member_id"), F.col("o_totalprice").alias("premium"), F.col("o_orderstatus").alias("state")
    )


# An example of a small constant table kept beside the code.
PRIORITY_BANDS = (("1-URGENT", "high", 3), ("2-HIGH", "high", 2), ("3-MEDIUM", "normal", 1), ("5-LOW", "low", 0))


@query(
    "inline_values_join",
    """WITH v(code, band, weight) AS (VALUES ('1-URGENT', 'high', 3), ('2-HIGH', 'high', 2), ('3-MEDIUM', 'normal', 1), ('5-LOW', 'low', 0))
       SELECT COALESCE(band, 'none') AS band, COUNT(*) AS n, CAST(SUM(weight) AS BIGINT) AS weight
       FROM orders LEFT JOIN v ON code = o_orderpriority GROUP BY 1""",
)
def inline_values_join(spark, sf):
    values = spark.createDataFrame(PRIORITY_BANDS, "code string, band string, weight int")
    o = Tables(spark, sf).orders.select("o_orderpriority")
    rows = o.join(values, F.col("code") == F.col("o_orderpriority"), "left")
    return rows.groupBy(F.coalesce("band", F.lit("none")).alias("band")).agg(F.count("*").alias("n"), F.sum("weight").alias("weight"))


@query(
    "month_end_spine",
    """WITH b AS (SELECT date_trunc('month', MIN(o_orderdate)) AS d0, MAX(o_orderdate) AS d1 FROM orders),
            n AS (SELECT last_day(o_orderdate) AS m, COUNT(*) AS n FROM orders GROUP BY 1),
            s AS (SELECT CAST(d0 AS DATE) + to_months(CAST(i AS INTEGER)) - INTERVAL 1 DAY AS x
                  FROM b, range(0, date_diff('month', d0, d1) + 1) r(i))
       SELECT CAST(CAST(x AS DATE) AS VARCHAR) AS date_date, COALESCE(n, 0) AS n_orders FROM s LEFT JOIN n ON m = CAST(x AS DATE)""",
)
def q_month_end_spine(spark, sf):
    o = Tables(spark, sf).orders.select(F.col("o_orderdate").cast("date").alias("d"))
    bounds = o.agg(F.trunc(F.min("d"), "MM").alias("d0"), F.max("d").alias("d1"))
    spine = month_end_spine(bounds, F.col("d0"), F.col("d1"))
    per_month = o.groupBy(F.last_day("d").alias("date_date")).agg(F.count("*").alias("n"))
    return spine.join(per_month, "date_date", "left").select("date_date", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query(
    "day_spine",
    """WITH b AS (SELECT CAST(MIN(ts) AS DATE) AS d0, CAST(MAX(ts) AS DATE) AS d1 FROM events),
            s AS (SELECT CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS d FROM b),
            n AS (SELECT CAST(ts AS DATE) AS e, COUNT(*) AS n FROM events GROUP BY 1)
       SELECT CAST(d AS VARCHAR) AS ts_date, CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS month, COALESCE(n, 0) AS n_events
       FROM s LEFT JOIN n ON e = d""",
)
def q_day_spine(spark, sf):
    e = Tables(spark, sf).events.select(F.col("ts").cast("date").alias("ts_date"))
    bounds = e.agg(F.min("ts_date").alias("d0"), F.max("ts_date").alias("d1"))
    per_day = e.groupBy("ts_date").agg(F.count("*").alias("n"))
    return day_spine(bounds, F.col("d0"), F.col("d1")).join(per_day, "ts_date", "left").select("ts_date", "month", F.coalesce("n", F.lit(0)).alias("n_events"))


@query(
    "ctas_roundtrip",
    """SELECT o_orderstatus AS state, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS premium FROM orders GROUP BY 1""",
)
def ctas_roundtrip(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("premium"))
    path = os.path.join(work_folder(spark), f"ctas-{uuid.uuid4().hex}")
    saved = save_table(o, path, ("o_orderstatus",))
    return saved.groupBy(F.col("o_orderstatus").alias("state")).agg(F.count("*").alias("n"), F.sum("premium").alias("premium"))


@query(
    "replace_from_itself",
    """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 2 AS DOUBLE) AS premium FROM orders WHERE CAST(o_totalprice AS DECIMAL(18,2)) > 100000""",
)
def replace_from_itself(spark, sf):
    """A table that is replaced by what a query makes of it."""
    path = os.path.join(work_folder(spark), f"replaced-{uuid.uuid4().hex}")
    replace_table(Tables(spark, sf).orders.select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("premium")), path)
    doubled = current_table(spark, path).where("premium > 100000").select("o_orderkey", (F.col("premium") * 2).cast("decimal(18,2)").alias("premium"))
    replace_table(doubled, path)
    return current_table(spark, path)


@query("distinct_rows", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_rows(spark, sf):
    return Tables(spark, sf).orders.select("o_custkey", "o_orderstatus").distinct()


@query(
    "filter_range",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'
       AND o_totalprice > 100000 AND o_orderstatus <> 'P'""",
)
def filter_range(spark, sf):
    o = Tables(spark, sf).orders
    day = F.col("o_orderdate")
    lo, hi = F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1997-01-01").cast("timestamp_ntz")
    return o.where((day >= lo) & (day < hi) & (F.col("o_totalprice") > 100000) & (F.col("o_orderstatus") != "P")).select("o_orderkey", "o_totalprice")


@query(
    "soft_delete_filter",
    """WITH r AS (SELECT event_id, NULLIF(json_extract_string(props, '$.k'), '7') AS k FROM events)
       SELECT COUNT(*) FILTER (WHERE k IS NULL) AS n_missing, COUNT(*) FILTER (WHERE k IS NOT NULL) AS n_live FROM r""",
)
def soft_delete_filter(spark, sf):
    e = Tables(spark, sf).events.select(F.nullif(F.get_json_object("props", "$.k"), F.lit("7")).alias("k"))
    return e.agg(F.count_if(F.col("k").isNull()).alias("n_missing"), F.count_if(F.col("k").isNotNull()).alias("n_live"))


@query(
    "filter_in_list",
    """SELECT event_type, COUNT(*) AS n FROM events WHERE event_type IN ('purchase', 'click', 'view') AND user_id % 10 NOT IN (3, 4) GROUP BY 1""",
)
def filter_in_list(spark, sf):
    e = Tables(spark, sf).events
    kept = e.where(F.col("event_type").isin("purchase", "click", "view") & ~(F.col("user_id") % 10).isin(3, 4))
    return kept.groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    "semi_join_in",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')",
)
def semi_join_in(spark, sf):
    t = Tables(spark, sf)
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_orderkey").alias("l_orderkey"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity").join(urgent, "l_orderkey", "left_semi")


@query(
    "range_bucket_between",
    f"SELECT {sql_bands('l_quantity')} AS band, COUNT(*) AS n FROM lineitem GROUP BY 1",
)
def range_bucket_between(spark, sf):
    rows = Tables(spark, sf).lineitem.select(age_band(F.col("l_quantity")).alias("band"))
    return rows.groupBy("band").agg(F.count("*").alias("n"))


@query(
    "not_null_logic",
    """WITH r AS (SELECT e.event_id, e.event_type, s.s_name FROM events e LEFT JOIN supplier s ON s.s_suppkey = e.user_id)
       SELECT event_type, COUNT(*) AS n FROM r WHERE NOT (event_type = 'click' AND s_name = 'Supplier#000000003') GROUP BY 1""",
)
def not_null_logic(spark, sf):
    t = Tables(spark, sf)
    s = t.supplier.select("s_suppkey", "s_name")
    rows = t.events.select("event_type", "user_id").join(s, F.col("s_suppkey") == F.col("user_id"), "left")
    kept = rows.where(~((F.col("event_type") == "click") & (F.col("s_name") == "Supplier#000000003")))
    return kept.groupBy("event_type").agg(F.count("*").alias("n"))


@query("regex_filter", "SELECT doc_id, lang FROM documents WHERE NOT regexp_matches(lower(text), 'prueba|test|leaux')")
def regex_filter(spark, sf):
    return Tables(spark, sf).documents.where(~F.lower("text").rlike("prueba|test|leaux")).select("doc_id", "lang")


@query("sort_col", "SELECT c_custkey, c_acctbal, CAST(ROW_NUMBER() OVER (ORDER BY c_acctbal, c_custkey) AS BIGINT) AS pos FROM customer")
def sort_col(spark, sf):
    from lossledger.operators.ordered import range_bucket, split_points, with_row_number

    c = Tables(spark, sf).customer.select("c_custkey", "c_acctbal")
    # Positions make the order part of the checked values.
    bucket = range_bucket(F.col("c_acctbal"), split_points(c, "c_acctbal"))
    return with_row_number(c, [], ["c_acctbal", "c_custkey"], bucket, "pos").orderBy("c_acctbal", "c_custkey")


@query(
    "sort_by_aggregate",
    """SELECT l_returnflag, l_linestatus, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM lineitem GROUP BY 1, 2 ORDER BY total DESC""",
)
def sort_by_aggregate(spark, sf):
    rows = Tables(spark, sf).lineitem.groupBy("l_returnflag", "l_linestatus")
    return rows.agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("total")).orderBy(F.desc("total"))


@query(
    "sort_by_expr",
    """SELECT o_orderkey, CAST(ABS(CAST(o_totalprice AS DECIMAL(18,2)) - 250000) AS DOUBLE) AS gap FROM orders ORDER BY gap, o_orderkey""",
)
def sort_by_expr(spark, sf):
    o = Tables(spark, sf).orders
    gap = F.abs(F.col("o_totalprice").cast("decimal(18,2)") - F.lit(250000))
    return o.select("o_orderkey", gap.alias("gap")).orderBy("gap", "o_orderkey")


@query(
    "union_all_sources",
    """SELECT source, COUNT(*) AS n, CAST(SUM(amount) AS DOUBLE) AS amount FROM (
         SELECT 'orders' AS source, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders
         UNION ALL SELECT 'lineitem', CAST(l_extendedprice AS DECIMAL(18,2)) FROM lineitem
         UNION ALL SELECT 'events', CAST(value AS DECIMAL(18,2)) FROM events) u GROUP BY 1""",
)
def union_all_sources(spark, sf):
    t = Tables(spark, sf)

    def part(df, name, amount):
        return df.select(F.lit(name).alias("source"), F.col(amount).cast("decimal(18,2)").alias("amount"))

    rows = part(t.orders, "orders", "o_totalprice").unionByName(part(t.lineitem, "lineitem", "l_extendedprice"))
    rows = rows.unionByName(part(t.events, "events", "value"))
    return rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))


@query(
    "union_distinct",
    """SELECT o_custkey AS member, CAST(o_orderdate AS DATE)::VARCHAR AS day FROM orders
       UNION SELECT o_custkey, CAST(o_orderdate + INTERVAL 365 DAY AS DATE)::VARCHAR FROM orders WHERE o_orderstatus = 'F'""",
)
def union_distinct(spark, sf):
    o = Tables(spark, sf).orders
    day = F.col("o_orderdate").cast("date")
    starts = o.select(F.col("o_custkey").alias("member"), day.alias("day"))
    ends = o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("member"), F.date_add(day, 365).alias("day"))
    return starts.unionByName(ends).distinct()


@query("local_date", f"SELECT CAST({sql_local_date('ts')} AS VARCHAR) AS day, COUNT(*) AS n FROM events GROUP BY 1")
def q_local_date(spark, sf):
    rows = Tables(spark, sf).events.select(local_date(F.col("ts")).alias("day"))
    return rows.groupBy("day").agg(F.count("*").alias("n"))
