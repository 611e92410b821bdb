"""Premium, collections and loss ratio."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossledger.functions.rules import local_date
from lossledger.plans import claims as C
from lossledger.plans import collections as K
from lossledger.plans import loss_ratio as L
from lossledger.plans import premium as P
from lossledger.plans.membership import cancellation_dates
from lossledger.sources.tables import materialise, outside_block, work_tables
from queries.plan_sql import AS_OF, local, plan_sql
from queries.registry import query
from queries.standins import OWN_CLINIC, PLAN_AS_OF, PLAN_START, Standins
from queries.windows import sql_trailing

RULES = C.ClaimRules(own_clinic=OWN_CLINIC, first_day=PLAN_START.replace(month=1))


@query(
    "exposure_days",
    plan_sql(
        f"""SELECT h.id AS healthplan_id, date_diff('day', {local('valid_since')}, LEAST({AS_OF}, {local('valid_through')}, {local('c.cancelled_at')})) + 1 AS days,
            CAST(date_diff('day', {local('valid_since')}, LEAST({AS_OF}, {local('valid_through')}, {local('c.cancelled_at')})) + 1 AS DOUBLE)
              / (date_diff('day', {local('valid_since')}, {local('valid_through')}) + 1) AS share,
            CASE WHEN c.cancelled_at IS NOT NULL THEN date_diff('day', {local('valid_since')}, LEAST({AS_OF}, {local('valid_through')}, {local('c.cancelled_at')})) + 1 END AS days_propagated
            FROM healthplan h LEFT JOIN canc c ON c.healthplan_id = h.id"""
    ),
)
def exposure_days(spark, sf):
    t = Standins(spark, sf)
    canc = cancellation_dates(t["healthplan"], t["amendment"]).select("healthplan_id", F.col("cancelled_at").alias("_c"))
    rows = t["healthplan"].join(canc, F.col("id") == F.col("healthplan_id"), "left")
    args = [local_date(F.col(c)) for c in ("valid_since", "valid_through", "_c")]
    days, share = P.exposure_days(*args, F.lit(PLAN_AS_OF))
    strict, _ = P.exposure_days(*args, F.lit(PLAN_AS_OF), null_policy="propagate")
    return rows.select(F.col("id").alias("healthplan_id"), days.cast("bigint").alias("days"), share.alias("share"), strict.cast("bigint").alias("days_propagated"))


@query(
    "amendment_facts",
    plan_sql(
        """SELECT amendment_id, healthplan_id, amendment_category, CAST(amendment_subscription_date AS VARCHAR) AS amendment_subscription_date,
           CAST(amendment_cancelation_date AS VARCHAR) AS amendment_cancelation_date, CAST(amendment_valid_since AS VARCHAR) AS amendment_valid_since,
           CAST(amendment_valid_through AS VARCHAR) AS amendment_valid_through, net_c / 100 AS net_premium, sur_c / 100 AS surcharge, sub_c / 100 AS subtotal, tot_c / 100 AS total FROM fact"""
    ),
)
def amendment_facts(spark, sf):
    t = Standins(spark, sf)
    return P.amendment_facts(t["amendment"], t["amendment_code"])


@query(
    "discount_backout",
    plan_sql("SELECT amendment_id, CASE WHEN in_scope THEN disc4 / 10000 ELSE 0.0 END AS applied, gross_c / 100 AS gross, (gross_c - net_c) / 100 AS discount FROM premium WHERE amendment_id IS NOT NULL"),
)
def discount_backout(spark, sf):
    t = Standins(spark, sf)
    share = P.discount_share(F.col("product_parameters_values"))
    # The same plans as in the report: live ones, whose renewal record is live too.
    from lossledger.plans.membership import live_plans

    plans = live_plans(t["healthplan"]).select(F.col("id").alias("healthplan_id"), share.alias("_share")).distinct()
    rows = P.amendment_facts(t["amendment"], t["amendment_code"]).join(plans, "healthplan_id")
    applied, gross, discount = P.discount_backout(F.col("net_premium"), F.col("amendment_category"), F.col("_share"))
    return rows.select("amendment_id", applied.alias("applied"), gross.alias("gross"), discount.alias("discount"))


@query("cession_flag", plan_sql("SELECT amendment_id, participates FROM premium WHERE amendment_id IS NOT NULL"))
def cession_flag(spark, sf):
    from lossledger.plans.membership import live_plans

    t = Standins(spark, sf)
    listed = t["non_ceded_plan"].select(F.col("healthplan_uuid").alias("uuid"), F.lit(True).alias("_listed")).distinct()
    product = t["product"].select(F.col("id").alias("product_id"), "product_family")
    plans = live_plans(t["healthplan"]).select(F.col("id").alias("healthplan_id"), "uuid", "product_id").distinct()
    plans = plans.join(listed, "uuid", "left").join(product, "product_id", "left")
    rows = P.amendment_facts(t["amendment"], t["amendment_code"]).join(plans, "healthplan_id")
    flag = P.ceded(F.col("amendment_category").isin(*P.DISCOUNTED), F.col("product_family"), F.col("_listed").isNotNull())
    return rows.select("amendment_id", flag.alias("participates"))


@query(
    "premium_report",
    plan_sql(
        """SELECT healthplan_id, vertical, product_id, product_family, business_id, business_name, business_group, business_group_size, is_collective, member_id, insured_amount,
           CAST(subscription_date AS VARCHAR) AS subscription_date, CAST(cancelation_date AS VARCHAR) AS cancelation_date, cancel_reason, days AS healthplan_vigour_days_so_far,
           CAST(days AS DOUBLE) / term AS healthplan_vigour_days_so_far_prop, is_internal, healthplan_state, subscription_type, age_at_subscription, gender, amendment_id,
           CAST(amendment_valid_since AS VARCHAR) AS amendment_valid_since, CAST(amendment_valid_through AS VARCHAR) AS amendment_valid_through,
           CAST(amendment_subscription_date AS VARCHAR) AS amendment_subscription_date, CAST(amendment_cancelation_date AS VARCHAR) AS amendment_cancelation_date, amendment_category,
           a_days AS amendment_vigour_days_so_far, CAST(a_days AS DOUBLE) / a_term AS amendment_vigour_days_so_far_prop, CASE WHEN in_scope THEN disc4 / 10000 ELSE 0.0 END AS discountpercent,
           participates AS reinsurance_participates, gross_c / 100 AS net_premium_before_discount, COALESCE(gross_c - net_c, 0) / 100 AS discount, net_c / 100 AS net_premium,
           sur_c / 100 AS surcharge, sub_c / 100 AS subtotal, tot_c / 100 AS total FROM premium"""
    ),
)
def premium_report(spark, sf):
    rows = P.premium_report(Standins(spark, sf), PLAN_AS_OF)
    longs = ("healthplan_vigour_days_so_far", "age_at_subscription", "amendment_vigour_days_so_far")
    return rows.withColumns({c: F.col(c).cast("bigint") for c in longs})


@query("settled_transactions", plan_sql("SELECT transaction_type, COUNT(*) AS n, MAX(transaction_id) AS last_id FROM settled GROUP BY 1"))
def settled_transactions(spark, sf):
    rows = K.settled_transactions(Standins(spark, sf)["transaction"])
    return rows.groupBy("transaction_type").agg(F.count("*").alias("n"), F.max("transaction_id").alias("last_id"))


#: What plan classes and the accrual of collections read of the premium report.
_CLASS_COLUMNS = ("healthplan_id", "vertical", "business_group_size", "is_internal")
_ACCRUAL_COLUMNS = (
    *_CLASS_COLUMNS, "amendment_id", "net_premium", "net_premium_before_discount", "amendment_subscription_date", "subscription_date",
    "amendment_cancelation_date", "cancelation_date",
)
#: What the accrual reads of the instalments' payments.
_PAYMENT_COLUMNS = ("amendment_id", "installment_number", "installment_valid_since", "installment_valid_through", "transaction_type", "_net", "_date")
#: What the claims report reads of it: the plan's attributes, and the amendment whose row they are taken from.
CLAIM_PLAN_COLUMNS = ("healthplan_id", "amendment_id", *C.PLAN_COLUMNS)


def _premium(spark, sf, *columns):
    """The premium report (or some columns of it), written once, as several branches read it."""
    t = Standins(spark, sf)
    with work_tables(spark):
        report = P.premium_report(t, PLAN_AS_OF)
        with outside_block():
            return t, materialise(report.select(*columns) if columns else report, "premium")


def _accrual_collections(premium, t):
    """The collections with what the accrual reads. Payments are written, so what their joins shuffle is gone before the rest."""
    return K.signed_collections(premium, t, materialise(K.instalment_payments(t).select(*_PAYMENT_COLUMNS), "payments"))


@query(
    "signed_collections",
    plan_sql(
        """SELECT healthplan_id, amendment_id, installment_number, transaction_id, transaction_type, CAST(transaction_date AS VARCHAR) AS transaction_date, sgn * i_gross_micro / 1000000 AS gross,
           sgn * i_net_c / 100 AS net, sgn * i_sub_c / 100 AS subtotal, sgn * i_tot_c / 100 AS total FROM collected"""
    ),
)
def signed_collections(spark, sf):
    t = Standins(spark, sf)
    rows = K.signed_collections(P.premium_report(t, PLAN_AS_OF), t)
    return rows.select(
        "healthplan_id", "amendment_id", "installment_number", "transaction_id", "transaction_type", "transaction_date",
        F.col("installment_net_premium_before_discount").alias("gross"), F.col("installment_net_premium").alias("net"),
        F.col("installment_subtotal").alias("subtotal"), F.col("installment_total").alias("total"),
    )


@query("plan_class", plan_sql("SELECT healthplan_id, hp_class FROM classed"))
def plan_class(spark, sf):
    _, premium = _premium(spark, sf, *_CLASS_COLUMNS)
    return L.plan_classes(premium)


@query("accrued_to_cutoff", plan_sql("SELECT CAST(c AS VARCHAR) AS date_date, hp_class, prem_c / 100 AS accrued_and_collected_premium FROM accrued"))
def accrued_to_cutoff(spark, sf):
    t, premium = _premium(spark, sf, *_ACCRUAL_COLUMNS)
    return L.accrued_to_cutoff(_accrual_collections(premium, t), L.plan_classes(premium), PLAN_START, PLAN_AS_OF)


_FINEST = "SELECT c, hp_class, ss_class, paid_c, prem_c FROM finest"
_LEVELS = """SELECT 0 AS granularity_level, c, 'Overall' AS hp_class, ss_class, CAST(SUM(paid_c) AS BIGINT) AS paid_c, CAST(SUM(prem_c) AS BIGINT) AS prem_c FROM finest GROUP BY ALL
  UNION ALL SELECT 1, c, CASE WHEN hp_class = 'B2C' THEN 'B2C' ELSE 'B2B' END, ss_class, CAST(SUM(paid_c) AS BIGINT), CAST(SUM(prem_c) AS BIGINT) FROM finest GROUP BY ALL
  UNION ALL SELECT 2, c, CASE WHEN hp_class IN ('B2C', 'B2B (1 - 9)') THEN hp_class ELSE 'B2B (10 or more)' END, ss_class, CAST(SUM(paid_c) AS BIGINT), CAST(SUM(prem_c) AS BIGINT) FROM finest GROUP BY ALL
  UNION ALL SELECT 3, c, hp_class, ss_class, paid_c, prem_c FROM finest"""


@query(
    "loss_ratio_report",
    plan_sql(
        f"""SELECT granularity_level, CAST(c AS VARCHAR) AS date_date, hp_class, ss_class, paid_c / 100 AS service_payments, prem_c / 100 AS accrued_and_collected_premium,
            {sql_trailing('paid_c', 'prem_c')} FROM ({_LEVELS}) levels WINDOW w AS (PARTITION BY granularity_level, hp_class, ss_class ORDER BY c)"""
    ),
)
def loss_ratio_report(spark, sf):
    t, premium = _premium(spark, sf, *dict.fromkeys((*_ACCRUAL_COLUMNS, *CLAIM_PLAN_COLUMNS)))
    return L.loss_ratio_report(
        premium, _accrual_collections(premium, t), C.claims_report(t, premium, PLAN_AS_OF, RULES), PLAN_AS_OF, PLAN_START
    )


@query(
    "loss_ratio_trailing",
    f"""WITH m AS (SELECT o_orderpriority AS hp_class, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
            CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) * 100 AS BIGINT) AS paid,
            CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) * 100 AS BIGINT) AS prem FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2),
          r AS (SELECT hp_class, month, CAST(SUM(paid) OVER v AS BIGINT) AS paid, CAST(SUM(prem) OVER v AS BIGINT) AS prem FROM m WINDOW v AS (PARTITION BY hp_class ORDER BY month))
        SELECT hp_class, CAST(last_day(month) AS VARCHAR) AS date_date, paid / 100 AS service_payments, prem / 100 AS premium, {sql_trailing('paid', 'prem')}
        FROM r WINDOW w AS (PARTITION BY hp_class ORDER BY month)""",
)
def loss_ratio_trailing(spark, sf):
    from queries.registry import Tables

    t = Tables(spark, sf)
    day = F.last_day(F.col("o_orderdate").cast("date"))
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", price).otherwise(0)).alias("paid"), F.sum(price).alias("prem")
    )
    rows = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("hp_class"), day.alias("date_date"))
    m = rows.join(lines, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("hp_class", "date_date")
    m = m.agg(F.sum("paid").alias("paid"), F.sum("prem").alias("prem"))
    from pyspark.sql import Window

    along = Window.partitionBy("hp_class").orderBy("date_date")
    m = m.select(
        "hp_class", "date_date",
        F.sum("paid").over(along).cast("decimal(18,2)").alias("service_payments"), F.sum("prem").over(along).cast("decimal(18,2)").alias("premium"),
    )
    return L.with_trailing_ratios(m, ["hp_class"], "date_date", "service_payments", "premium")
