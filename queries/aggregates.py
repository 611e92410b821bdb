"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossledger.operators import aggregates as A
from lossledger.operators.ordered import with_key_aggregate
from lossledger.plans.loss_ratio import class_levels
from queries.registry import Tables, query

_PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"


@query(
    "agg_basic",
    f"""SELECT l_returnflag, l_linestatus, COUNT(*) AS n, CAST(SUM({_PRICE}) AS DOUBLE) AS total, MIN(l_quantity) AS least, MAX(l_quantity) AS most,
               CAST(SUM({_PRICE}) AS DOUBLE) / COUNT(l_extendedprice) AS mean FROM lineitem GROUP BY 1, 2""",
)
def agg_basic(spark, sf):
    li = Tables(spark, sf).lineitem
    total = F.sum(F.col("l_extendedprice").cast("decimal(18,2)"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"),
        total.alias("total"),
        F.min("l_quantity").alias("least"),
        F.max("l_quantity").alias("most"),
        (total.cast("double") / F.count("l_extendedprice")).alias("mean"),
    )


@query(
    "count_distinct_multi",
    """SELECT l_returnflag, COUNT(DISTINCT l_orderkey) AS orders, COUNT(DISTINCT l_partkey) AS parts, COUNT(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1""",
)
def count_distinct_multi(spark, sf):
    return Tables(spark, sf).lineitem.groupBy("l_returnflag").agg(
        F.countDistinct("l_orderkey").alias("orders"), F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_suppkey").alias("suppliers")
    )


@query(
    "count_distinct_if",
    """SELECT o_orderpriority, COUNT(DISTINCT CASE WHEN o_orderstatus = 'O' THEN o_custkey END) AS active FROM orders GROUP BY 1""",
)
def count_distinct_if(spark, sf):
    active = F.when(F.col("o_orderstatus") == "O", F.col("o_custkey"))
    return Tables(spark, sf).orders.groupBy("o_orderpriority").agg(F.countDistinct(active).alias("active"))


@query(
    "min_if",
    """SELECT o_custkey, CAST(MIN(CASE WHEN o_orderstatus <> 'O' THEN LEAST(CAST(o_orderdate AS DATE) + 100, DATE '2000-01-01') END) AS VARCHAR) AS ended FROM orders GROUP BY 1""",
)
def min_if(spark, sf):
    day = F.least(F.date_add(F.col("o_orderdate").cast("date"), 100), F.lit("2000-01-01").cast("date"))
    return Tables(spark, sf).orders.groupBy("o_custkey").agg(F.min(F.when(F.col("o_orderstatus") != "O", day)).alias("ended"))


@query(
    "latest_value_by_key",
    """SELECT o_custkey, arg_max_null(o_orderstatus, (o_orderdate, o_orderkey)) AS status, arg_max_null(CASE WHEN o_totalprice > 200000 THEN o_totalprice END, (o_orderdate, o_orderkey)) AS big_price
       FROM orders GROUP BY 1""",
)
def latest_value_by_key(spark, sf):
    o = Tables(spark, sf).orders
    o = o.select("o_custkey", "o_orderdate", "o_orderkey", F.col("o_orderstatus").alias("status"), F.when(F.col("o_totalprice") > 200000, F.col("o_totalprice")).alias("big_price"))
    return A.latest_by_key(o, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], ["status", "big_price"])


@query(
    "collect_set_sorted",
    """SELECT l_suppkey, array_to_string(list_sort(list(DISTINCT l_returnflag || l_linestatus) FILTER (WHERE l_quantity > 48)), '|') AS flags FROM lineitem GROUP BY 1""",
)
def collect_set_sorted(spark, sf):
    li = Tables(spark, sf).lineitem
    rows = li.select("l_suppkey", F.when(F.col("l_quantity") > 48, F.concat("l_returnflag", "l_linestatus")).alias("f"))
    return A.distinct_array(rows, ["l_suppkey"], "f", "flags")


@query(
    "collect_list_joined",
    """SELECT l_orderkey, array_to_string(list_sort(list(l_returnflag) FILTER (WHERE l_linestatus = 'O')), ', ') AS flags FROM lineitem GROUP BY 1""",
)
def collect_list_joined(spark, sf):
    li = Tables(spark, sf).lineitem
    rows = li.select("l_orderkey", F.when(F.col("l_linestatus") == "O", F.col("l_returnflag")).alias("f"))
    return A.repeated_text(rows, ["l_orderkey"], "f", "flags")


@query(
    "collect_set_top10",
    """SELECT l_suppkey, array_to_string(list_slice(list_sort(list(DISTINCT l_partkey)), 1, 10), '|') AS parts FROM lineitem GROUP BY 1""",
)
def collect_set_top10(spark, sf):
    return A.capped_distinct_array(Tables(spark, sf).lineitem, ["l_suppkey"], "l_partkey", "parts", 10)


@query(
    "distinct_len_by_group",
    """WITH m AS (SELECT l_suppkey, 'l_returnflag' AS feature, l_returnflag AS value FROM lineitem
                  UNION ALL SELECT l_suppkey, 'l_partkey', CAST(l_partkey AS VARCHAR) FROM lineitem
                  UNION ALL SELECT l_suppkey, 'rare', CASE WHEN l_quantity = 50 AND l_discount = 0 THEN l_linestatus END FROM lineitem)
       SELECT l_suppkey, feature, NULLIF(COUNT(DISTINCT value), 0) AS n_values FROM m GROUP BY 1, 2""",
)
def distinct_len_by_group(spark, sf):
    li = Tables(spark, sf).lineitem.withColumn("rare", F.when((F.col("l_quantity") == 50) & (F.col("l_discount") == 0), F.col("l_linestatus")))
    return A.distinct_lengths(li, ["l_suppkey"], ["l_returnflag", "l_partkey", "rare"])


@query(
    "agg_of_agg",
    """WITH n AS (SELECT o_orderpriority, o_custkey, COUNT(*) AS n FROM orders GROUP BY 1, 2)
       SELECT o_orderpriority, MAX(n) AS most, CAST(SUM(n) AS DOUBLE) / COUNT(*) AS mean FROM n GROUP BY 1""",
)
def agg_of_agg(spark, sf):
    per = Tables(spark, sf).orders.groupBy("o_orderpriority", "o_custkey").agg(F.count("*").alias("n"))
    return per.groupBy("o_orderpriority").agg(F.max("n").alias("most"), (F.sum("n").cast("double") / F.count("*")).alias("mean"))


@query("agg_global", "SELECT CAST(CAST(MAX(l_shipdate) AS DATE) AS VARCHAR) AS last_day, COUNT(*) AS n, MAX(l_quantity) AS most FROM lineitem")
def agg_global(spark, sf):
    return Tables(spark, sf).lineitem.agg(F.max(F.col("l_shipdate").cast("date")).alias("last_day"), F.count("*").alias("n"), F.max("l_quantity").alias("most"))


SQL_LEVELS = """SELECT 0 AS granularity_level, 'Overall' AS hp_class, {keys}, {sums} FROM {src} GROUP BY ALL
  UNION ALL SELECT 1, CASE WHEN hp_class = 'B2C' THEN 'B2C' ELSE 'B2B' END, {keys}, {sums} FROM {src} GROUP BY ALL
  UNION ALL SELECT 2, CASE WHEN hp_class IN ('B2C', 'B2B (1 - 9)') THEN hp_class ELSE 'B2B (10 or more)' END, {keys}, {sums} FROM {src} GROUP BY ALL
  UNION ALL SELECT 3, hp_class, {keys}, {sums} FROM {src} GROUP BY ALL"""


@query(
    "granularity_rollup",
    f"""WITH src AS (SELECT CAST(EXTRACT(YEAR FROM o_orderdate) AS INTEGER) AS y, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
                CASE o_orderpriority WHEN '5-LOW' THEN 'B2C' WHEN '1-URGENT' THEN 'B2B (1 - 9)' WHEN '2-HIGH' THEN 'B2B (10 - 19)' ELSE 'B2B (20 - 49)' END AS hp_class FROM orders)
        {SQL_LEVELS.format(keys='y', sums='CAST(SUM(amount) AS DOUBLE) AS amount', src='src')}""",
)
def granularity_rollup(spark, sf):
    o = Tables(spark, sf).orders
    p = F.col("o_orderpriority")
    label = F.when(p == "5-LOW", "B2C").when(p == "1-URGENT", "B2B (1 - 9)").when(p == "2-HIGH", "B2B (10 - 19)").otherwise("B2B (20 - 49)")
    rows = o.select(F.year("o_orderdate").alias("y"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"), label.alias("hp_class"))
    # Sum the finest level first, so that only one row per class and year is tagged four times.
    finest = rows.groupBy("y", "hp_class").agg(F.sum("amount").alias("amount"))
    return A.rollup_levels(finest, class_levels(), "hp_class", ["y"], ["amount"])


@query(
    "group_by_case_key",
    """SELECT CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 40 THEN 'medium' ELSE 'large' END AS size, CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS VARCHAR) AS month, COUNT(*) AS n
       FROM lineitem GROUP BY 1, 2""",
)
def group_by_case_key(spark, sf):
    q = F.col("l_quantity")
    size = F.when(q < 10, "small").when(q < 40, "medium").otherwise("large")
    month = F.trunc(F.col("l_shipdate").cast("date"), "MM")
    return Tables(spark, sf).lineitem.groupBy(size.alias("size"), month.alias("month")).agg(F.count("*").alias("n"))


@query(
    "correlated_count_asof",
    """WITH d AS (SELECT o_custkey, MIN(CAST(o_orderdate AS DATE)) AS first_day FROM orders GROUP BY 1)
       SELECT d.o_custkey, (SELECT COUNT(DISTINCT o.o_orderpriority) FROM orders o WHERE o.o_custkey = d.o_custkey AND CAST(o.o_orderdate AS DATE) <= d.first_day + 300
              AND (o.o_orderstatus <> 'F' OR CAST(o.o_orderdate AS DATE) + 200 > d.first_day + 300)) AS active FROM d""",
)
def correlated_count_asof(spark, sf):
    day = F.col("o_orderdate").cast("date")
    o = Tables(spark, sf).orders.select("o_custkey", "o_orderpriority", "o_orderstatus", day.alias("day"))
    rows = with_key_aggregate(o, ["o_custkey"], {"first_day": F.min("day")})
    cutoff = F.date_add("first_day", 300)
    active = (F.col("day") <= cutoff) & ((F.col("o_orderstatus") != "F") | (F.date_add("day", 200) > cutoff))
    pairs = rows.groupBy("o_custkey", "o_orderpriority").agg(F.max(active).alias("_in"))
    return pairs.groupBy("o_custkey").agg(F.count_if("_in").alias("active"))


