"""Join shapes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lossledger.functions.rules import json_text, local_date
from lossledger.operators import joins as J
from lossledger.operators.aggregates import distinct_array
from lossledger.operators.spines import month_grid
from lossledger.plans.loss_ratio import cumulative_to_cutoff, last_cutoff
from queries.registry import Tables, query, sql_local_date
from queries.standins import PLAN_AS_OF, PLAN_START, Standins, ctes

SQL_CUTOFFS = f"""cutoffs AS (SELECT CAST(DATE '{PLAN_START}' + to_months(CAST(i AS INTEGER)) - INTERVAL 1 DAY AS DATE) AS date_date
  FROM range(0, date_diff('month', DATE '{PLAN_START}', DATE '{PLAN_AS_OF}') + 1) r(i))"""


@query(
    "inner_join_using",
    f"""WITH {ctes('medical_event', 'service_payment')},
       m AS (SELECT member_id, service_id, services_health_plan_id AS healthplan_id, COUNT(*) AS n FROM medical_event GROUP BY 1, 2, 3),
       p AS (SELECT member_id, service_id, healthplan_id, CAST(SUM(subtotal) AS DOUBLE) AS subtotal FROM service_payment GROUP BY 1, 2, 3)
       SELECT member_id, service_id, healthplan_id, n, subtotal FROM m JOIN p USING (member_id, service_id, healthplan_id)""",
)
def inner_join_using(spark, sf):
    t = Standins(spark, sf)
    keys = ["member_id", "service_id", "healthplan_id"]
    m = t["medical_event"].withColumnRenamed("services_health_plan_id", "healthplan_id").groupBy(*keys).agg(F.count("*").alias("n"))
    p = t["service_payment"].groupBy(*keys).agg(F.sum("subtotal").alias("subtotal"))
    return m.join(p, keys)


@query(
    "left_join_lookup",
    """SELECT c_custkey, n_name AS nation, r_name AS region FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
       LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def left_join_lookup(spark, sf):
    t = Tables(spark, sf)
    rows = J.join_role(t.customer.select("c_custkey", "c_nationkey"), t.nation, "c_nationkey", "n_nationkey", {"n_name": "nation", "n_regionkey": "_region"})
    return J.join_role(rows, t.region, "_region", "r_regionkey", {"r_name": "region"}).select("c_custkey", "nation", "region")


@query(
    "star_join_role_dims",
    """SELECT nc.n_name AS customer_nation, ns.n_name AS supplier_nation, np.n_name AS part_nation, COUNT(*) AS n,
              CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
       FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey
       LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN part ON p_partkey = l_partkey
       LEFT JOIN nation nc ON nc.n_nationkey = c_nationkey LEFT JOIN nation ns ON ns.n_nationkey = s_nationkey
       LEFT JOIN nation np ON np.n_nationkey = p_size % 30 GROUP BY 1, 2, 3""",
)
def star_join_role_dims(spark, sf):
    t = Tables(spark, sf)
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    rows = J.join_role(rows, t.orders, "l_orderkey", "o_orderkey", {"o_custkey": "_cust"})
    rows = J.join_role(rows, t.customer, "_cust", "c_custkey", {"c_nationkey": "_cn"})
    rows = J.join_role(rows, t.supplier, "l_suppkey", "s_suppkey", {"s_nationkey": "_sn"})
    rows = J.join_role(rows, t.part.withColumn("home", F.col("p_size") % 30), "l_partkey", "p_partkey", {"home": "_pn"})
    # Amounts are summed over the keys before the three names are looked up.
    rows = rows.groupBy("_cn", "_sn", "_pn").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
    for key, out in (("_cn", "customer_nation"), ("_sn", "supplier_nation"), ("_pn", "part_nation")):
        rows = J.join_role(rows, t.nation, key, "n_nationkey", {"n_name": out})
    return rows.groupBy("customer_nation", "supplier_nation", "part_nation").agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))


@query(
    "polymorphic_join",
    f"""WITH {ctes('service', 'branch_office', 'doctor_friend', 'doctor')}
       SELECT s.id AS service_id, o.name AS office, f.name AS friend, d.descriptor AS doctor FROM service s
       LEFT JOIN branch_office o ON o.id = s.provided_by_object_id AND s.provided_by_content_type_id = 57
       LEFT JOIN doctor_friend f ON f.id = s.provided_by_object_id AND s.provided_by_content_type_id = 58
       LEFT JOIN doctor d ON d.id = s.provided_by_object_id AND s.provided_by_content_type_id = 59""",
)
def polymorphic_join(spark, sf):
    t = Standins(spark, sf)
    rows = t["service"].select(F.col("id").alias("service_id"), "provided_by_object_id", "provided_by_content_type_id")
    targets = {
        57: (t["branch_office"], "id", {"name": "office"}),
        58: (t["doctor_friend"], "id", {"name": "friend"}),
        59: (t["doctor"], "id", {"descriptor": "doctor"}),
    }
    rows = J.join_by_type(rows, "provided_by_content_type_id", "provided_by_object_id", targets)
    return rows.select("service_id", "office", "friend", "doctor")


@query(
    "full_outer_merge",
    """WITH f AS (SELECT o_custkey, COUNT(*) AS n_closed FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
            o AS (SELECT o_custkey, COUNT(*) AS n_open FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
       SELECT o_custkey, n_closed, n_open FROM f FULL JOIN o USING (o_custkey)""",
)
def full_outer_merge(spark, sf):
    o = Tables(spark, sf).orders
    closed = o.where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.count("*").alias("n_closed"))
    opened = o.where("o_orderstatus = 'O'").groupBy("o_custkey").agg(F.count("*").alias("n_open"))
    return closed.join(opened, "o_custkey", "full")


@query(
    "grid_cross_join",
    """WITH b AS (SELECT MIN(o_orderdate) AS d0, MAX(o_orderdate) AS d1 FROM orders),
            c AS (SELECT CAST(date_trunc('month', d0) + to_months(CAST(i AS INTEGER)) - INTERVAL 1 DAY AS DATE) AS date_date FROM b, range(0, date_diff('month', d0, d1) + 1) r(i))
       SELECT c_mktsegment, CAST(date_date AS VARCHAR) AS date_date FROM c CROSS JOIN (SELECT DISTINCT c_mktsegment FROM customer) s""",
)
def grid_cross_join(spark, sf):
    t = Tables(spark, sf)
    day = F.col("o_orderdate").cast("date")
    first, last = t.orders.agg(F.trunc(F.min(day), "MM")).scalar(), t.orders.agg(F.max(day)).scalar()
    return month_grid(t.customer.select("c_mktsegment").distinct(), first, last)


@query(
    "scalar_broadcast_filter",
    """SELECT l_returnflag, COUNT(*) AS n FROM lineitem LEFT JOIN (SELECT MAX(o_orderdate) AS last FROM orders WHERE o_orderstatus = 'F') ON TRUE
       WHERE l_shipdate <= last - INTERVAL 500 DAY GROUP BY 1""",
)
def scalar_broadcast_filter(spark, sf):
    t = Tables(spark, sf)
    last = t.orders.where("o_orderstatus = 'F'").agg((F.max("o_orderdate") - F.expr("interval 500 days")).alias("d")).scalar()
    return t.lineitem.where(F.col("l_shipdate") <= last).groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query(
    "semi_join_left_notnull",
    """SELECT c_custkey, c_mktsegment FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000) o ON o_custkey = c_custkey
       WHERE o_custkey IS NOT NULL""",
)
def semi_join_left_notnull(spark, sf):
    t = Tables(spark, sf)
    big = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_mktsegment").join(big, "c_custkey", "left_semi")


@query(
    "self_join_parent",
    f"""WITH {ctes('amendment')} SELECT a.id, a.amendment_category, ca.id AS cancelled_by, ca.amendment_category AS cancelled_as
       FROM amendment a LEFT JOIN amendment ca ON ca.cancelled_amendment_id = a.id""",
)
def self_join_parent(spark, sf):
    a = Standins(spark, sf)["amendment"].select("id", "amendment_category", "cancelled_amendment_id")
    ca = a.where(F.col("cancelled_amendment_id").isNotNull())
    columns = {"id": "cancelled_by", "amendment_category": "cancelled_as"}
    return J.join_role(a, ca, "id", "cancelled_amendment_id", columns).drop("cancelled_amendment_id")


@query(
    "interval_join_keyed",
    f"""WITH {ctes('service', 'payroll_doctor')}
       SELECT s.id AS service_id, p.type, CAST(p.salary AS DOUBLE) AS salary FROM service s LEFT JOIN payroll_doctor p ON p.doctor_id = s.provided_by_object_id
         AND {sql_local_date('s.created_at')} >= p.start_date AND {sql_local_date('s.created_at')} <= COALESCE(p.end_date, DATE '2100-01-01')""",
)
def interval_join_keyed(spark, sf):
    t = Standins(spark, sf)
    rows = t["service"].select(F.col("id").alias("service_id"), "provided_by_object_id", "created_at")
    at = local_date(F.col("created_at"))
    rows = J.join_valid_at(rows, t["payroll_doctor"], "provided_by_object_id", "doctor_id", at, "start_date", "end_date", {"type": "type", "salary": "salary"})
    return rows.select("service_id", "type", "salary")


@query(
    "interval_join_theta",
    f"""WITH {ctes('payroll_doctor')}, d AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '{PLAN_AS_OF}', INTERVAL 1 DAY)) AS DATE) AS day)
       SELECT CAST(day AS VARCHAR) AS ts_date, type, COUNT(*) AS n, CAST(SUM(salary) AS DOUBLE) AS pay
       FROM d JOIN payroll_doctor ON start_date <= day AND COALESCE(end_date, DATE '2100-01-01') >= day GROUP BY 1, 2""",
)
def interval_join_theta(spark, sf):
    people = Standins(spark, sf)["payroll_doctor"]
    days = J.explode_active_days(people, "start_date", "end_date", F.lit(dt.date(1995, 1, 1)), F.lit(PLAN_AS_OF))
    return days.groupBy("ts_date", "type").agg(F.count("*").alias("n"), F.sum("salary").alias("pay"))


@query(
    "active_at_date",
    """WITH p AS (SELECT n_name, o_custkey, CAST(o_orderdate AS DATE) AS s, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 200 END AS e
                  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
            d AS (SELECT DISTINCT n_name, CAST(date_trunc('quarter', s) AS DATE) AS day FROM p)
       SELECT d.n_name AS nation, CAST(d.day AS VARCHAR) AS day, COUNT(DISTINCT p.o_custkey) AS active FROM d
       LEFT JOIN p ON p.n_name = d.n_name AND p.s <= d.day AND (p.e IS NULL OR p.e > d.day) GROUP BY 1, 2""",
)
def active_at_date(spark, sf):
    t = Tables(spark, sf)
    start = F.col("o_orderdate").cast("date")
    rows = t.orders.select("o_custkey", start.alias("s"), F.when(F.col("o_orderstatus") == "F", F.date_add(start, 200)).alias("e"))
    rows = J.join_role(rows, t.customer, "o_custkey", "c_custkey", {"c_nationkey": "_n"})
    rows = J.join_role(rows, t.nation, "_n", "n_nationkey", {"n_name": "nation"})
    quarter = F.trunc("s", "quarter")
    dates = rows.select("nation", quarter.alias("day")).distinct()
    # A spell becomes one row per quarter start it covers, so dates and spells meet on equality.
    last = rows.agg(F.max(quarter)).scalar()
    first = F.when(quarter == F.col("s"), quarter).otherwise(F.add_months(quarter, 3))
    until = F.least(last, F.coalesce(F.date_sub("e", 1), last))
    spread = rows.withColumn("_f", first).withColumn("_u", until).where("_f <= _u")
    spread = spread.select("nation", "o_custkey", F.explode(F.sequence("_f", "_u", F.expr("interval 3 months"))).alias("day")).distinct()
    counted = spread.groupBy("nation", "day").agg(F.count("*").alias("_n"))
    return dates.join(counted, ["nation", "day"], "left").select("nation", "day", F.coalesce("_n", F.lit(0)).alias("active"))


SQL_PRICES = """p AS (SELECT event_id AS id, CASE WHEN event_id % 4 <> 0 THEN CAST(FLOOR(value) AS BIGINT) % 5 + 10 * (event_id // 1000) END AS price FROM events),
  f AS (SELECT price, MIN(id) AS first_id FROM p WHERE price IS NOT NULL GROUP BY 1),
  b AS (SELECT price, CASE WHEN ROW_NUMBER() OVER (ORDER BY first_id) = 1 THEN 1 ELSE first_id END AS first_id,
               COALESCE(LEAD(first_id) OVER (ORDER BY first_id) - 1, (SELECT MAX(id) FROM p)) AS last_id FROM f)"""


def _prices(spark, sf):
    e = Tables(spark, sf).events
    price = F.floor("value").cast("bigint") % 5 + 10 * F.floor(F.col("event_id") / 1000).cast("bigint")
    return e.select(F.col("event_id").alias("id"), F.when(F.col("event_id") % 4 != 0, price).alias("price"))


@query("asof_breakpoint_fill", f"WITH {SQL_PRICES} SELECT p.id, b.price AS filled FROM p LEFT JOIN b ON p.id BETWEEN b.first_id AND b.last_id")
def asof_breakpoint_fill(spark, sf):
    return J.fill_from_breakpoints(_prices(spark, sf), "id", "price", "filled").select("id", "filled")


@query("breakpoint_ranges", f"WITH {SQL_PRICES} SELECT price, first_id, last_id FROM b")
def breakpoint_ranges(spark, sf):
    return J.breakpoints(_prices(spark, sf), "id", "price")


@query(
    "cumulative_to_cutoff",
    f"""WITH {SQL_CUTOFFS}, g AS (SELECT * FROM cutoffs CROSS JOIN (SELECT DISTINCT l_returnflag FROM lineitem) x)
       SELECT CAST(date_date AS VARCHAR) AS date_date, g.l_returnflag, CAST(ROUND(COALESCE(SUM(CAST(l_extendedprice AS DECIMAL(18,2))), 0), 2) AS DOUBLE) AS paid
       FROM g LEFT JOIN lineitem l ON CAST(l.l_shipdate AS DATE) <= g.date_date AND l.l_returnflag = g.l_returnflag GROUP BY 1, 2""",
)
def q_cumulative_to_cutoff(spark, sf):
    li = Tables(spark, sf).lineitem
    facts = li.select("l_returnflag", F.col("l_shipdate").cast("date").alias("day"), F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    grid = month_grid(li.select("l_returnflag").distinct(), PLAN_START, PLAN_AS_OF)
    inside = facts.where(F.col("day") <= F.lit(last_cutoff(PLAN_AS_OF)))
    return cumulative_to_cutoff(inside, "day", ["l_returnflag"], "amount", grid, PLAN_START, "paid")


@query(
    "array_membership_join",
    """WITH g AS (SELECT r_name, list(DISTINCT n_nationkey) AS ids FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1)
       SELECT c_custkey, r_name FROM customer LEFT JOIN g ON list_contains(ids, c_nationkey)""",
)
def array_membership_join(spark, sf):
    t = Tables(spark, sf)
    groups = distinct_array(t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")), ["r_name"], "n_nationkey", "ids")
    return J.join_member_of(t.customer.select("c_custkey", "c_nationkey"), "c_nationkey", groups, "ids").select("c_custkey", "r_name")


@query(
    "explode_outer_struct",
    """WITH s AS (SELECT c_nationkey, c_mktsegment, COUNT(*) AS n FROM customer GROUP BY 1, 2)
       SELECT n_name AS nation, c_mktsegment AS segment, n FROM nation LEFT JOIN s ON c_nationkey = n_nationkey AND n_nationkey % 3 <> 0""",
)
def explode_outer_struct(spark, sf):
    t = Tables(spark, sf)
    per = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    arrays = per.groupBy("c_nationkey").agg(F.array_sort(F.collect_list(F.struct("c_mktsegment", "n"))).alias("items"))
    rows = J.join_role(t.nation, arrays, "n_nationkey", "c_nationkey", {"items": "items"}, when=F.col("n_nationkey") % 3 != 0)
    return rows.select(F.col("n_name").alias("nation"), F.explode_outer("items").alias("i")).select("nation", F.col("i.c_mktsegment").alias("segment"), "i.n")


@query(
    "json_key_join",
    """SELECT event_id, n_name FROM events LEFT JOIN nation ON json_extract_string(props, '$.k') = CAST(n_nationkey AS VARCHAR)""",
)
def json_key_join(spark, sf):
    t = Tables(spark, sf)
    rows = t.events.select("event_id", json_text(F.col("props"), "k").alias("code"))
    codes = t.nation.select(F.col("n_nationkey").cast("string").alias("code"), "n_name")
    return rows.join(codes, "code", "left").select("event_id", "n_name")


@query(
    "outer_to_inner",
    """SELECT l_linestatus, COUNT(*) AS n FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderkey % 5 <> 0 WHERE o_orderstatus = 'F' GROUP BY 1""",
)
def outer_to_inner(spark, sf):
    t = Tables(spark, sf)
    closed = t.orders.where((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 5 != 0)).select(F.col("o_orderkey").alias("l_orderkey"))
    return t.lineitem.select("l_orderkey", "l_linestatus").join(closed, "l_orderkey").groupBy("l_linestatus").agg(F.count("*").alias("n"))


