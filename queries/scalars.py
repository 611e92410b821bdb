"""Scalar functions and the rules that pin them down."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossledger.functions import rules as R
from lossledger.operators.joins import join_role
from queries.registry import Tables, query, sql_cents, sql_ratio

SQL_SIZE_BAND = "CASE WHEN {0} < 10 THEN '1 - 9' WHEN {0} < 20 THEN '10 - 19' WHEN {0} < 50 THEN '20 - 49' ELSE '50 or more' END"


@query(
    "case_size_band",
    f"""WITH n AS (SELECT l_suppkey, l_returnflag, l_shipdate, COUNT(*) AS n FROM (SELECT l_suppkey, l_returnflag, CAST(date_trunc('month', l_shipdate) AS DATE) AS l_shipdate FROM lineitem) GROUP BY 1, 2, 3)
        SELECT s_suppkey, l_returnflag, CAST(l_shipdate AS VARCHAR) AS month, n, {SQL_SIZE_BAND.format('n')} AS band FROM supplier LEFT JOIN n ON l_suppkey = s_suppkey""",
)
def case_size_band(spark, sf):
    t = Tables(spark, sf)
    month = F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("month")
    n = t.lineitem.groupBy("l_suppkey", "l_returnflag", month).agg(F.count("*").alias("n"))
    rows = t.supplier.select("s_suppkey").join(n, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return rows.select("s_suppkey", "l_returnflag", "month", "n", R.size_band(F.col("n")).alias("band"))


@query(
    "sentinel_to_null",
    """WITH r AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'None' ELSE event_type END AS a,
                         CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'None' ELSE 'x' || event_id END AS b FROM events)
       SELECT event_id, NULLIF(a, 'None') AS a, NULLIF(NULLIF(b, 'None'), '') AS b FROM r""",
)
def q_sentinel_to_null(spark, sf):
    e = Tables(spark, sf).events
    a = F.when(F.col("event_type") == "error", "None").otherwise(F.col("event_type"))
    kind = F.col("event_id") % 3
    b = F.when(kind == 0, "").when(kind == 1, "None").otherwise(F.concat(F.lit("x"), F.col("event_id").cast("string")))
    return R.sentinel_to_null(e.select("event_id", a.alias("a"), b.alias("b")), ["a", "b"], also_empty=["b"])


@query(
    "coalesce_chain",
    """SELECT doc_id, COALESCE(CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN quality = 1 THEN 'good' END, lang, 'none') AS tag
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def coalesce_chain(spark, sf):
    t = Tables(spark, sf)
    rows = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    tag = F.coalesce(F.when(F.col("toxic") == 1, "toxic"), F.when(F.col("quality") == 1, "good"), F.col("lang"), F.lit("none"))
    return rows.select("doc_id", tag.alias("tag"))


@query("safe_ratio", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_tax / NULLIF(l_discount, 0) AS ratio FROM lineitem")
def q_safe_ratio(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", R.safe_ratio(F.col("l_tax"), F.col("l_discount")).alias("ratio"))


@query(
    "least_greatest_nullaware",
    """WITH r AS (SELECT o_orderkey, o_orderkey % 100 AS a, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 77 END AS b, o_custkey % 90 AS c FROM orders)
       SELECT o_orderkey, LEAST(a, b, c) AS least_skip, GREATEST(a, b, c) AS greatest_skip,
              CASE WHEN b IS NOT NULL THEN LEAST(a, b, c) END AS least_propagate,
              CASE WHEN b IS NOT NULL THEN GREATEST(a, b, c) END AS greatest_propagate FROM r""",
)
def least_greatest_nullaware(spark, sf):
    o = Tables(spark, sf).orders
    cols = [F.col("o_orderkey") % 100, F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") % 77), F.col("o_custkey") % 90]
    return o.select(
        "o_orderkey",
        R.least_of(*cols).alias("least_skip"),
        R.greatest_of(*cols).alias("greatest_skip"),
        R.least_of(*cols, null_policy="propagate").alias("least_propagate"),
        R.greatest_of(*cols, null_policy="propagate").alias("greatest_propagate"),
    )


@query(
    "round_money",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {sql_ratio(sql_cents('l_extendedprice') + ' * (100 - CAST(ROUND(l_discount * 100) AS BIGINT))', '10000', 2)} AS net,
              {sql_ratio(sql_cents('l_extendedprice'), '100', 0)} AS whole FROM lineitem""",
)
def round_money(spark, sf):
    li = Tables(spark, sf).lineitem
    price, rate = R.to_money(F.col("l_extendedprice")), F.lit(1) - F.col("l_discount").cast("decimal(4,2)")
    return li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.round(price * rate, 2).alias("net"), F.round(price, 0).alias("whole")
    )


@query(
    "trunc_digits",
    """WITH r AS (SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 100 AS BIGINT) AS v FROM customer)
       SELECT c_custkey, SIGN(v) * CAST((ABS(v) * 10000) // 700 AS DOUBLE) / 10000 AS cut FROM r""",
)
def q_trunc_digits(spark, sf):
    c = Tables(spark, sf).customer
    seventh = F.col("c_acctbal").cast("decimal(18,2)") / F.lit(7).cast("decimal(2,0)")
    return c.select("c_custkey", R.trunc_digits(seventh, 4).alias("cut"))


@query(
    "signed_amount",
    """SELECT l_returnflag, CAST(SUM(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount,
              CAST(MAX(CAST(l_shipdate AS DATE) + 30) AS VARCHAR) AS last_due FROM lineitem GROUP BY 1""",
)
def signed_amount(spark, sf):
    li = Tables(spark, sf).lineitem
    amount = R.signed(R.to_money(F.col("l_extendedprice")), F.col("l_returnflag"), ["R"])
    return li.groupBy("l_returnflag").agg(F.sum(amount).alias("amount"), F.max(F.date_add(F.col("l_shipdate").cast("date"), 30)).alias("last_due"))


@query(
    "cast_suite",
    """SELECT event_id, CAST(event_id AS VARCHAR) AS as_text, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS as_int,
              TRY_CAST(event_type AS BIGINT) AS bad_int, CAST(value AS DECIMAL(18,2))::DOUBLE AS as_decimal, CAST(CAST(ts AS DATE) AS VARCHAR) AS as_date,
              regexp_replace(CAST(CAST(user_id AS DOUBLE) AS VARCHAR), '\\.0$', '') AS float_text
       FROM events""",
)
def cast_suite(spark, sf):
    e = Tables(spark, sf).events
    return e.select(
        "event_id",
        F.col("event_id").cast("string").alias("as_text"),
        R.json_text(F.col("props"), "k").try_cast("bigint").alias("as_int"),
        F.col("event_type").try_cast("bigint").alias("bad_int"),
        F.col("value").cast("decimal(18,2)").alias("as_decimal"),
        F.col("ts").cast("date").alias("as_date"),
        R.number_text(F.col("user_id").cast("double")).alias("float_text"),
    )


@query(
    "concat_name",
    """SELECT c_custkey, c_name || ' ' || CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END || ' ' || n_name AS full_name
       FROM customer JOIN nation ON n_nationkey = c_nationkey""",
)
def concat_name(spark, sf):
    t = Tables(spark, sf)
    rows = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    middle = F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment"))
    return rows.select("c_custkey", F.concat("c_name", F.lit(" "), middle, F.lit(" "), "n_name").alias("full_name"))


@query(
    "string_clean",
    "SELECT p_partkey, TRIM('  ' || p_name || ' ') AS trimmed, UPPER(p_name) AS upper_name, LOWER(p_type) AS lower_type FROM part",
)
def string_clean(spark, sf):
    p = Tables(spark, sf).part
    padded = F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))
    return p.select("p_partkey", F.trim(padded).alias("trimmed"), F.upper("p_name").alias("upper_name"), F.lower("p_type").alias("lower_type"))


@query(
    "initcap_text",
    """SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(lower(p_type || '-' || p_name || ' x/' || p_brand), '[^-\\s#/]*[-\\s#/]?'),
              lambda w: upper(w[1]) || w[2:]), '') AS title FROM part""",
)
def initcap_text(spark, sf):
    p = Tables(spark, sf).part
    raw = F.concat("p_type", F.lit("-"), "p_name", F.lit(" x/"), "p_brand")
    return p.select("p_partkey", R.title_text(raw).alias("title"))


@query(
    "format_thousands",
    """SELECT l_suppkey, format('{:,}', CAST(SUM(CAST(l_quantity AS BIGINT)) * 1000 AS BIGINT)) AS total FROM lineitem GROUP BY 1""",
)
def format_thousands(spark, sf):
    rows = Tables(spark, sf).lineitem.groupBy("l_suppkey").agg((F.sum(F.col("l_quantity").cast("bigint")) * 1000).alias("n"))
    return rows.select("l_suppkey", R.thousands(F.col("n")).alias("total"))


@query("json_field", "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.missing') AS missing FROM events")
def json_field(spark, sf):
    e = Tables(spark, sf).events
    return e.select("event_id", R.json_text(F.col("props"), "k").alias("k"), R.json_text(F.col("props"), "missing").alias("missing"))


@query(
    "date_diff_parts",
    """WITH r AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 900 AS INTEGER) AS b FROM orders)
       SELECT o_orderkey, date_diff('day', a, b) AS days, date_diff('month', a, b) AS months, date_diff('year', a, b) AS years FROM r""",
)
def date_diff_parts(spark, sf):
    a = F.col("o_orderdate").cast("date")
    b = F.date_add(a, (F.col("o_orderkey") % 900).cast("int"))
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", *[R.date_diff(b, a, u).cast("bigint").alias(f"{u.lower()}s") for u in ("DAY", "MONTH", "YEAR")])


@query(
    "date_arith",
    """SELECT o_orderkey, CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS next_month, CAST(CAST(o_orderdate AS DATE) - 1 AS VARCHAR) AS day_before,
              CAST(CAST(CAST(o_orderdate AS DATE) - INTERVAL 12 MONTH AS DATE) AS VARCHAR) AS year_before FROM orders""",
)
def date_arith(spark, sf):
    d = F.col("o_orderdate").cast("date")
    return Tables(spark, sf).orders.select(
        "o_orderkey", F.add_months(d, 1).alias("next_month"), F.date_sub(d, 1).alias("day_before"), F.add_months(d, -12).alias("year_before")
    )


@query(
    "month_trunc_counts",
    "SELECT CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS VARCHAR) AS month, COUNT(*) AS n FROM lineitem GROUP BY 1",
)
def month_trunc_counts(spark, sf):
    rows = Tables(spark, sf).lineitem.select(R.month_start(F.col("l_shipdate").cast("date")).alias("month"))
    return rows.groupBy("month").agg(F.count("*").alias("n"))


@query(
    "days_in_month_prorate",
    """SELECT o_orderkey, EXTRACT(DAY FROM o_orderdate) AS day, EXTRACT(DAY FROM last_day(o_orderdate)) AS month_days,
              o_totalprice / EXTRACT(DAY FROM last_day(o_orderdate)) AS per_day FROM orders""",
)
def days_in_month_prorate(spark, sf):
    d = F.col("o_orderdate").cast("date")
    n = R.days_in_month(d)
    return Tables(spark, sf).orders.select(
        "o_orderkey", F.dayofmonth(d).cast("bigint").alias("day"), n.cast("bigint").alias("month_days"), R.safe_ratio(F.col("o_totalprice"), n.cast("double")).alias("per_day")
    )


@query(
    "parse_date",
    """SELECT o_orderkey, EXTRACT(YEAR FROM strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d')) AS y, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d FROM orders""",
)
def parse_date(spark, sf):
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    parsed = F.to_date(text, "yyyy-MM-dd")
    return Tables(spark, sf).orders.select("o_orderkey", F.year(parsed).cast("bigint").alias("y"), parsed.alias("d"))


@query(
    "code_label_lookup",
    """SELECT o_orderkey, COALESCE(n_name, UPPER('code ' || (o_custkey % 30))) AS label FROM orders LEFT JOIN nation ON n_nationkey = o_custkey % 30""",
)
def code_label_lookup(spark, sf):
    t = Tables(spark, sf)
    rows = t.orders.select("o_orderkey", (F.col("o_custkey") % 30).alias("code"))
    rows = join_role(rows, t.nation, "code", "n_nationkey", {"n_name": "_label"})
    fallback = F.upper(F.concat(F.lit("code "), F.col("code").cast("string")))
    return rows.select("o_orderkey", F.coalesce("_label", fallback).alias("label"))
