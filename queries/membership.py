"""Plans, members and groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossledger.plans import membership as M
from lossledger.sources.tables import materialise
from queries.plan_sql import plan_sql
from queries.registry import query
from queries.standins import PLAN_AS_OF, Standins


def _grouped(t):
    return M.grouped_members(t, PLAN_AS_OF)


@query("cancellation_date", plan_sql("SELECT healthplan_id, CAST(CAST(cancelled_at AS DATE) AS VARCHAR) AS cancelled_on FROM canc"))
def cancellation_date(spark, sf):
    t = Standins(spark, sf)
    rows = M.cancellation_dates(t["healthplan"], t["amendment"])
    return rows.select("healthplan_id", F.col("cancelled_at").cast("date").alias("cancelled_on"))


@query("cancellation_reason", plan_sql("SELECT healthplan_id, cancel_reason FROM cancelled"))
def cancellation_reason(spark, sf):
    t = Standins(spark, sf)
    return M.cancellations(t["healthplan"], t["amendment"], t["cancel_reason"]).select("healthplan_id", "cancel_reason")


@query("group_state", plan_sql("SELECT healthplan_id, business_state, CAST(business_cancelation_date AS VARCHAR) AS business_cancelation_date, is_internal FROM gm"))
def group_state(spark, sf):
    rows = M.with_group_state(materialise(M.business_members(Standins(spark, sf), PLAN_AS_OF), "members"))
    return rows.select("healthplan_id", "business_state", "business_cancelation_date", "is_internal")


@query("group_assignment", plan_sql("SELECT business_group, array_to_string(business_ids, '|') AS business_ids FROM gids"))
def group_assignment(spark, sf):
    return M.group_business_ids(_grouped(Standins(spark, sf)))


@query("peak_concurrent", plan_sql("SELECT business_group, peak FROM peak"))
def peak_concurrent(spark, sf):
    return M.peak_concurrent(_grouped(Standins(spark, sf)), "business_group", "member_id", "subscription_date", "cancelation_date", "peak")


@query("active_after_30d", plan_sql("SELECT business_group, n30 AS active_after_30_days FROM after30"))
def active_after_30d(spark, sf):
    return M.active_after(_grouped(Standins(spark, sf)))


@query(
    "group_size_report",
    plan_sql(
        """SELECT * REPLACE (array_to_string(business_ids, '|') AS business_ids, CAST(business_group_incorporation_date AS VARCHAR) AS business_group_incorporation_date,
           CAST(business_group_cancelation_date AS VARCHAR) AS business_group_cancelation_date) FROM group_size"""
    ),
)
def group_size_report(spark, sf):
    return M.group_size_report(Standins(spark, sf), PLAN_AS_OF)


