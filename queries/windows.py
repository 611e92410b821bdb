"""Window functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lossledger.functions.rules import minutes_between, to_money
from lossledger.operators.ordered import first_per_key, time_slot, with_key_aggregate, with_neighbours
from lossledger.plans.claims import impute_from_neighbours
from lossledger.plans.loss_ratio import TRAILING_MONTHS, with_trailing_ratios
from queries.registry import Tables, query, sql_ratio


@query(
    "window_partition_max",
    """SELECT o_orderkey, MAX(o_totalprice) OVER (PARTITION BY o_custkey) AS most, CAST(MIN(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey) AS VARCHAR) AS first_day FROM orders""",
)
def window_partition_max(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("d"))
    rows = with_key_aggregate(o, ["o_custkey"], {"most": F.max("o_totalprice"), "first_day": F.min("d")})
    return rows.select("o_orderkey", "most", "first_day")


_ALL = "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


@query(
    "dedupe_first_per_key",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
        QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ALL}) = 1""",
)
def dedupe_first_per_key(spark, sf):
    rows = first_per_key(Tables(spark, sf).lineitem, ["l_orderkey", "l_linenumber"], [F.col(c.strip()) for c in _ALL.split(",")])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query(
    "dedupe_latest_per_key",
    "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
)
def dedupe_latest_per_key(spark, sf):
    o = Tables(spark, sf).orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return first_per_key(o, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).drop("o_orderdate")


def sql_trailing(num: str, den: str, window: str = "w") -> str:
    """Running and trailing ratio columns over integer cent columns."""
    cols = [f"{sql_ratio(num, den, 4)} AS mlr_running_total"]
    for n in TRAILING_MONTHS:
        dn, dd = (f"({c} - LAG({c}, {n}) OVER {window})" for c in (num, den))
        cols.append(f"{sql_ratio(dn, dd, 4)} AS mlr_last_{n}_months")
    return ", ".join(cols)


@query(
    "lag_offsets_ratio",
    f"""WITH m AS (SELECT l_returnflag AS flag, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
                CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) * 100 AS BIGINT) AS num, CAST(SUM(CAST(l_quantity AS BIGINT)) * 100 AS BIGINT) AS den FROM lineitem GROUP BY 1, 2)
        SELECT flag, CAST(month AS VARCHAR) AS month, {sql_trailing('num', 'den')} FROM m WINDOW w AS (PARTITION BY flag ORDER BY month)""",
)
def lag_offsets_ratio(spark, sf):
    li = Tables(spark, sf).lineitem
    month = F.trunc(F.col("l_shipdate").cast("date"), "MM")
    m = li.groupBy(F.col("l_returnflag").alias("flag"), month.alias("month")).agg(
        F.sum(to_money(F.col("l_extendedprice"))).alias("num"), F.sum(F.col("l_quantity").cast("bigint")).cast("decimal(18,2)").alias("den")
    )
    return with_trailing_ratios(m, ["flag"], "month", "num", "den").drop("num", "den")


@query(
    "time_to_next_event",
    "SELECT event_id, date_sub('minute', ts, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS minutes FROM events",
)
def time_to_next_event(spark, sf):
    e = Tables(spark, sf).events.select("event_id", "user_id", "ts")
    rows = with_neighbours(e, ["user_id"], ["ts", "event_id"], "ts", time_slot(F.col("ts"), 24 * 3600), next="_next")
    return rows.select("event_id", minutes_between(F.col("ts"), F.col("_next")).alias("minutes"))


@query(
    "lag_fill_ratio",
    """WITH m AS (SELECT l_suppkey AS s, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(SUM(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS a, COUNT(*) AS n
                  FROM lineitem GROUP BY 1, 2)
       SELECT s, CAST(month AS VARCHAR) AS month, CASE WHEN month < DATE '2001-10-01' AND a IS NOT NULL THEN a / n ELSE LAG(a / n) OVER (PARTITION BY s ORDER BY month) END AS unit FROM m""",
)
def lag_fill_ratio(spark, sf):
    li = Tables(spark, sf).lineitem
    month = F.trunc(F.col("l_shipdate").cast("date"), "MM")
    amount = F.sum(F.when(F.col("l_returnflag") == "A", to_money(F.col("l_extendedprice")))).cast("double")
    m = li.groupBy(F.col("l_suppkey").alias("s"), month.alias("month")).agg(amount.alias("a"), F.count("*").alias("n"))
    unit = F.col("a") / F.col("n")
    # One row per supplier and month, so the window is as long as the calendar.
    before = F.lag(unit).over(Window.partitionBy("s").orderBy("month"))
    known = (F.col("month") < F.lit("2001-10-01").cast("date")) & F.col("a").isNotNull()
    return m.select("s", "month", F.when(known, unit).otherwise(before).alias("unit"))


@query(
    "neighbor_impute",
    """WITH r AS (SELECT event_id, user_id, CASE WHEN event_id % 3 <> 0 THEN value END AS v FROM events)
       SELECT event_id, COALESCE(v, LAG(v) OVER w, LEAD(v) OVER w, 100.0 - user_id) AS price FROM r WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""",
)
def neighbor_impute(spark, sf):
    e = Tables(spark, sf).events.select("event_id", "user_id", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("v"))
    return impute_from_neighbours(e, "user_id", "event_id", "v", (F.lit(100.0) - F.col("user_id")), "price").select("event_id", "price")


@query(
    "window_value_frequency",
    """SELECT o_orderkey, COUNT(*) OVER (PARTITION BY o_orderpriority) AS freq_priority, COUNT(*) OVER (PARTITION BY o_custkey) AS freq_member FROM orders""",
)
def window_value_frequency(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderpriority", "o_custkey")
    rows = with_key_aggregate(o, ["o_orderpriority"], {"freq_priority": F.count("*")})
    return with_key_aggregate(rows, ["o_custkey"], {"freq_member": F.count("*")}).select("o_orderkey", "freq_priority", "freq_member")
