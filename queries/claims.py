"""Claim payments and cost allocation."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossledger.functions.rules import local_date
from lossledger.operators.spines import day_spine, one_row
from lossledger.plans import claims as C
from queries.plan_sql import OPEN, local, plan_sql
from queries.premium import CLAIM_PLAN_COLUMNS, RULES, _premium
from queries.registry import query, sql_ratio
from queries.standins import PLAN_AS_OF, Standins


@query(
    "signed_claims",
    plan_sql(
        """SELECT healthplan_id, member_id, service_id, disease_case_id, CAST(service_created_at AS VARCHAR) AS service_created_at, service_type, vc_schema, ipc_schema, transaction_id,
           transaction_type, CAST(transaction_date AS VARCHAR) AS transaction_date, sub_c / 100 AS subtotal FROM billed"""
    ),
)
def signed_claims(spark, sf):
    return C.signed_claims(Standins(spark, sf), RULES)


@query(
    "month_shift_10day",
    plan_sql(
        f"""SELECT CAST(CAST(date_trunc('month', CASE WHEN EXTRACT(DAY FROM {local('confirmed_at')}) <= 10 THEN {local('confirmed_at')} - INTERVAL 1 MONTH ELSE {local('confirmed_at')} END) AS DATE) AS VARCHAR) AS month,
            COUNT(*) AS n FROM settled GROUP BY 1"""
    ),
)
def month_shift_10day(spark, sf):
    from lossledger.plans.collections import settled_transactions

    rows = settled_transactions(Standins(spark, sf)["transaction"])
    month = C.payment_month(local_date(F.col("confirmed_at")))
    return rows.groupBy(month.alias("month")).agg(F.count("*").alias("n"))


@query("burst_dedupe", plan_sql("SELECT service_id, healthplan_id, member_id, CAST(day AS VARCHAR) AS day, scheme FROM vc"))
def burst_dedupe(spark, sf):
    rows = C.video_consults(Standins(spark, sf), RULES)
    return rows.select("service_id", "healthplan_id", "member_id", F.col("service_created_at").alias("day"), F.col("vc_schema").alias("scheme"))


@query(
    "daily_payroll_cost",
    plan_sql(
        f"""SELECT CAST(day AS VARCHAR) AS ts_date, COUNT(p.doctor_id) AS n_people, CAST(SUM(salary) AS DOUBLE) AS month_pay, CAST(SUM(salary) AS DOUBLE) / EXTRACT(DAY FROM last_day(day)) AS daily_pay
            FROM days LEFT JOIN payroll_doctor p ON p.start_date <= day AND COALESCE(p.end_date, {OPEN}) >= day GROUP BY day"""
    ),
)
def daily_payroll_cost(spark, sf):
    t = Standins(spark, sf)
    spine = day_spine(one_row(spark), RULES.first_day, PLAN_AS_OF)
    rows = C.payroll_by_day(t["payroll_doctor"], RULES.first_day, PLAN_AS_OF, spine)
    pay = F.nullif(F.col("month_pay"), F.lit(0).cast("decimal(28,2)"))
    return rows.select("ts_date", F.col("n_people").cast("bigint").alias("n_people"), pay.alias("month_pay"), F.when(pay.isNotNull(), F.col("daily_pay")).alias("daily_pay"))


@query(
    "daily_active_cost",
    plan_sql(
        f"""SELECT CAST(month AS VARCHAR) AS month, type, doctor_id, n_days, pay_c / 100 / EXTRACT(DAY FROM last_day(month)) AS cost FROM pay"""
    ),
)
def daily_active_cost(spark, sf):
    from lossledger.operators.joins import explode_active_months

    people = Standins(spark, sf)["payroll_doctor"]
    rows = explode_active_months(people, "start_date", "end_date", F.lit(RULES.first_day), F.lit(PLAN_AS_OF))
    pay = (F.col("salary") * F.col("covered_days")).cast("double") / F.col("month_days")
    return rows.select("month", "type", "doctor_id", F.col("covered_days").cast("bigint").alias("n_days"), pay.alias("cost"))


@query(
    "unit_cost_monthly",
    plan_sql("SELECT CAST(month AS VARCHAR) AS month, scheme, count_service, " + sql_ratio("num", "den * 100", 4) + " AS unit_cost FROM vc_unit"),
)
def unit_cost_monthly(spark, sf):
    t = Standins(spark, sf)
    consults = C.video_consults(t, RULES)
    costs = C.video_scheme_costs(t, PLAN_AS_OF, RULES)
    rows = C.unit_cost_monthly(C.service_counts(consults, ["vc_schema"]), costs, ["vc_schema"], PLAN_AS_OF)
    return rows.select("month", F.col("vc_schema").alias("scheme"), "count_service", F.round("unit_cost", 4).alias("unit_cost"))


@query(
    "unit_cost_carry_forward",
    plan_sql("SELECT CAST(month AS VARCHAR) AS month, doctor_id, scheme, n AS count_service, " + sql_ratio("num", "den * 100", 4) + " AS unit_cost FROM ipc_unit"),
)
def unit_cost_carry_forward(spark, sf):
    t = Standins(spark, sf)
    visits = C.clinic_visits(t, RULES)
    contracts = t["payroll_doctor"].where(F.col("type") != RULES.primary_type)
    payroll = C.payroll_by_month(contracts, RULES.first_day, PLAN_AS_OF, ["doctor_id"])

    def units(scheme, costs, **how):
        counts = C.service_counts(visits.where(F.col("ipc_schema") == scheme), ["doctor_id"])
        return C.unit_cost_carry_forward(counts, costs, PLAN_AS_OF, **how).select("month", "doctor_id", F.lit(scheme).alias("scheme"), "count_service", F.round("unit_cost", 4).alias("unit_cost"))

    return units(C.HOURLY, t["monthly_cost"]).unionByName(units(C.PAYROLL, payroll, own_fallback=True))


@query(
    "allocate_unit_cost",
    plan_sql("SELECT service_id, service_type, COALESCE(vc_schema, ipc_schema) AS scheme, CAST(sub_n AS DOUBLE) / 1e10 AS subtotal FROM paid_all WHERE transaction_id IS NULL"),
)
def allocate_unit_cost(spark, sf):
    t = Standins(spark, sf)
    video = C.video_costs(t, C.video_consults(t, RULES), PLAN_AS_OF, RULES).withColumnRenamed("vc_schema", "scheme").withColumn("service_type", F.lit(C.VIDEO_LABEL))
    clinic = C.clinic_costs(t, C.clinic_visits(t, RULES), PLAN_AS_OF, RULES).withColumnRenamed("ipc_schema", "scheme").withColumn("service_type", F.lit(C.CLINIC_LABEL))
    columns = ["service_id", "service_type", "scheme", "subtotal"]
    return video.select(*columns).unionByName(clinic.select(*columns))


@query(
    "scheme_tag_interval",
    plan_sql(
        f"""SELECT s.id AS service_id, CASE WHEN p.doctor_id IS NULL THEN 'Fee per hour' ELSE 'Payroll based' END AS scheme FROM service s
            LEFT JOIN payroll_doctor p ON p.doctor_id = s.provided_by_object_id AND {local('s.created_at')} BETWEEN p.start_date AND COALESCE(p.end_date, {OPEN})"""
    ),
)
def scheme_tag_interval(spark, sf):
    t = Standins(spark, sf)
    rows = C.tag_scheme(t["service"], t["payroll_doctor"], "provided_by_object_id", local_date(F.col("created_at")), "scheme")
    return rows.select(F.col("id").alias("service_id"), "scheme")


@query(
    "claims_report",
    plan_sql(
        """SELECT healthplan_id, member_id, vertical, business_group, business_group_size, age_at_subscription, product_family, service_id, CAST(service_created_at AS VARCHAR) AS service_created_at,
           service_type, vc_schema, ipc_schema, transaction_id, transaction_type, CAST(transaction_date AS VARCHAR) AS transaction_date, CAST(sub_n AS DOUBLE) / 1e10 AS subtotal,
           price_c / 100 AS subtotal_cost_to_reinsurance, participates AS reinsurance_participates FROM claims"""
    ),
)
def claims_report(spark, sf):
    t, premium = _premium(spark, sf, *CLAIM_PLAN_COLUMNS)
    rows = C.claims_report(t, premium, PLAN_AS_OF, RULES)
    return rows.select(
        "healthplan_id", "member_id", "vertical", "business_group", "business_group_size", F.col("age_at_subscription").cast("bigint"), "product_family", "service_id",
        "service_created_at", "service_type", "vc_schema", "ipc_schema", "transaction_id", "transaction_type", "transaction_date", "subtotal",
        "subtotal_cost_to_reinsurance", "reinsurance_participates",
    )
