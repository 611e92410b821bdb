"""Claim payments and the cost of services: billed claims, consults with allocated unit cost, reinsurance price."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossledger.functions.rules import TAX_DIVISOR, local_date, minutes_between, money, month_start
from lossledger.operators.joins import explode_active_months, fill_from_breakpoints, join_role, join_valid_at
from lossledger.operators.ordered import first_per_key, range_bucket, split_points, time_slot, with_neighbours
from lossledger.plans.collections import item_payments, items_of_types, settled_transactions
from lossledger.plans.membership import Tables
from lossledger.plans.premium import SMALL_PRODUCT
from lossledger.sources.tables import materialise

# Service types, scheme labels, states and content tags.
ON_DEMAND = "ON_DEMAND_CONSULT"
IN_PERSON = "IN_PERSON_CONSULT"
IN_PERSON_PROVIDER = "IN_PERSON_CONSULT_BY_PROVIDER"
HOURLY, PAYROLL, PER_SERVICE = "Fee per hour", "Payroll based", "Fee per service"
VIDEO_LABEL, CLINIC_LABEL, OTHER_LABEL = "Videoconsult", "In person consult by provider", "Other service"
DOCTOR_TAG = 59
CLAIM_APPS = ("claims", "pharmacy")
TIME_LOG_MODEL = "ondemandconsulttimelog"
PLUS_TYPES = ("DB", "PY")
CANCELLED = "CANCELLED"
DROPPED_CONSULT_STATES = ("CA", "HN")
TEST_PATTERN = "prueba|test"

PLAN_COLUMNS = (
    "is_internal", "vertical", "is_collective", "product_id", "product_family", "business_id", "business_group_size",
    "business_group", "business_name", "age_at_subscription", "gender",
)


@dataclass(frozen=True)
class ClaimRules:
    """What depends on the business rather than on the method."""

    own_clinic: str = "OWN CLINIC"
    primary_type: str = "PRIMARY"
    burst_minutes: int = 60
    payment_day: int = 10
    low_product_id: int = 40
    first_day: dt.date = dt.date(2020, 11, 24)


def signed_claim_amount(subtotal_cents: Column, flow: Column, kind: Column) -> Column:
    """Positive for outflow by debit or payment; each of the other flow and the other types flips the sign."""
    amount = money(subtotal_cents)
    by_flow = F.when(flow == "OUT", amount).otherwise(-amount)
    return F.when(kind.isin(*PLUS_TYPES), by_flow).otherwise(-by_flow)


def signed_claims(t: Tables, rules: ClaimRules = ClaimRules()) -> DataFrame:
    """Settled payments of billed services, without on-demand consults and the own clinic's visits."""
    scope = items_of_types(t["invoice_item"], t["content_type"].where(F.col("app_label").isin(*CLAIM_APPS)))
    items = scope.select("id", F.col("object_id").alias("service_id"), "subtotal_cents", "payment_flow")
    paid = item_payments(items, t["invoice_item_invoice"], settled_transactions(t["transaction"]), how="inner")
    paid = paid.where(F.col("confirmed_at").isNotNull())

    services = t["service"].where(F.col("deleted").isNull() & (F.col("service_type_value") != ON_DEMAND)).select(
        F.col("id").alias("service_id"), F.col("health_plan_id").alias("healthplan_id"), "member_id", "disease_case_id",
        "created_at", "service_type_value", "provided_by_object_id", "provided_by_content_type_id",
    )
    labels = t["service_type"].select(F.col("code").alias("_code"), "legend")
    rows = paid.join(services, "service_id")
    rows = with_clinic_name(rows, t)
    own = (F.col("service_type_value") == IN_PERSON_PROVIDER) & (F.col("_clinic") == rules.own_clinic)
    rows = rows.where(~own).join(labels, F.col("_code") == F.col("service_type_value"), "left")
    return rows.select(
        "healthplan_id", "member_id", "service_id", "disease_case_id",
        local_date(F.col("created_at")).alias("service_created_at"),
        F.coalesce("legend", F.lit(OTHER_LABEL)).alias("service_type"),
        F.lit(None).cast("string").alias("vc_schema"),
        F.when(F.col("service_type_value") == IN_PERSON, PER_SERVICE).alias("ipc_schema"),
        "transaction_id", "transaction_type",
        local_date(F.col("confirmed_at")).alias("transaction_date"),
        signed_claim_amount(F.col("subtotal_cents"), F.col("payment_flow"), F.col("transaction_type")).cast("decimal(18,2)").alias("subtotal"),
    )


def with_clinic_name(rows: DataFrame, t: Tables) -> DataFrame:
    """Name of the provider that employs the doctor a service refers to; NULL when it refers to no doctor."""
    doctors = t["doctor"].select(F.col("id").alias("d_id"), "provider_branch_office_id")
    offices = t["branch_office"].select(F.col("id").alias("o_id"), "provider_id")
    names = t["provider"].select(F.col("id").alias("p_id"), "name")
    chain = doctors.join(offices, F.col("o_id") == F.col("provider_branch_office_id"), "left").join(names, F.col("p_id") == F.col("provider_id"), "left")
    tag = F.col("provided_by_content_type_id") == DOCTOR_TAG
    return join_role(rows, chain, "provided_by_object_id", "d_id", {"name": "_clinic", "d_id": "doctor_id"}, when=tag)


def payment_month(local_day: Column, cutoff_day: int = 10) -> Column:
    """Month a payment belongs to: up to the cutoff day it is for the month before."""
    shifted = F.when(F.dayofmonth(local_day) <= cutoff_day, F.add_months(local_day, -1)).otherwise(local_day)
    return month_start(shifted)


def hourly_consult_cost(t: Tables, rules: ClaimRules = ClaimRules()) -> DataFrame:
    """(month, subtotal) paid for consult hours."""
    scope = items_of_types(t["invoice_item"], t["content_type"].where(F.col("model") == TIME_LOG_MODEL)).select("id", "subtotal_cents")
    paid = item_payments(scope, t["invoice_item_invoice"], settled_transactions(t["transaction"], ("PY",)), how="inner")
    month = payment_month(local_date(F.col("confirmed_at")), rules.payment_day)
    return paid.groupBy(month.alias("month")).agg(F.sum(money(F.col("subtotal_cents"))).cast("decimal(18,2)").alias("subtotal"))


def payroll_by_month(contracts: DataFrame, first: dt.date, as_of: dt.date, keys: Sequence[str] = ()) -> DataFrame:
    """Pay of people under contract per month (and per ``keys``): pay / days in month for each covered day.

    A contract becomes one row per month it touches with its covered days, so no day spine is joined.
    """
    rows = explode_active_months(contracts, "start_date", "end_date", F.lit(first), F.lit(as_of))
    weighted = rows.groupBy("month", *keys).agg(
        F.sum(F.col("salary") * F.col("covered_days")).cast("decimal(28,2)").alias("_pay_days"), F.first("month_days").alias("_days")
    )
    subtotal = F.round(F.try_divide(F.col("_pay_days"), F.col("_days").cast("decimal(4,0)")), 2).cast("decimal(18,2)")
    return weighted.select("month", *keys, subtotal.alias("subtotal"))


def payroll_by_day(contracts: DataFrame, first: dt.date, as_of: dt.date, spine: DataFrame) -> DataFrame:
    """(ts_date, n people, pay per day): starts and ends as +/- steps per day, summed along the spine."""
    lo, hi = F.greatest(F.col("start_date"), F.lit(first)), F.col("end_date")
    steps = F.array(
        F.struct(lo.alias("ts_date"), F.lit(1).alias("n"), F.col("salary").alias("pay")),
        F.struct(F.date_add(hi, 1).alias("ts_date"), F.lit(-1).alias("n"), (-F.col("salary")).alias("pay")),
    )
    inside = contracts.where((F.col("start_date") <= F.lit(as_of)) & (hi.isNull() | (hi >= F.lit(first))))
    changes = inside.select(F.explode(steps).alias("s")).where("s.ts_date IS NOT NULL").groupBy("s.ts_date")
    changes = changes.agg(F.sum("s.n").alias("_n"), F.sum("s.pay").alias("_pay"))
    along = Window.orderBy("ts_date").rowsBetween(Window.unboundedPreceding, 0)  # one row per calendar day
    days = spine.join(changes, "ts_date", "left")
    return days.select(
        "ts_date",
        "month",
        F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("n_people"),
        F.sum("_pay").over(along).cast("decimal(28,2)").alias("month_pay"),
    ).withColumn("daily_pay", F.try_divide(F.col("month_pay").cast("double"), F.dayofmonth(F.last_day("ts_date"))))


def tag_scheme(services: DataFrame, contracts: DataFrame, doctor_col: str, at: Column, out: str) -> DataFrame:
    """Payroll when the doctor has a contract covering the moment, else hourly."""
    held = contracts.select("doctor_id", "start_date", "end_date")
    rows = join_valid_at(services, held, doctor_col, "doctor_id", at, "start_date", "end_date", {"doctor_id": "_contract"})
    return rows.withColumn(out, F.when(F.col("_contract").isNotNull(), PAYROLL).otherwise(HOURLY)).drop("_contract")


def last_of_burst(events: DataFrame, keys: Sequence[str], ts: str, tie: str, minutes: int = 60) -> DataFrame:
    """Keep an event unless the same key has a later one within ``minutes``.

    Only the next event of a key matters; it is found inside time slots with the first event of the next slot
    carried in, so a key with very many events is spread over its slots.
    """
    out = with_neighbours(events, keys, [ts, tie], ts, time_slot(F.col(ts)), next="_next_ts")
    gap = minutes_between(F.col(ts), F.col("_next_ts"))
    return out.where(F.col("_next_ts").isNull() | (gap > minutes)).drop("_next_ts")


def video_consults(t: Tables, rules: ClaimRules = ClaimRules()) -> DataFrame:
    """On-demand consults that count, with their fee scheme; bursts reduced to the last consult."""
    consult = t["on_demand_consult"].where(
        ~F.col("state").isin(*DROPPED_CONSULT_STATES) & ~F.lower("reason").rlike(TEST_PATTERN)
    ).select(F.col("consult_ptr_id").alias("id"))
    services = t["service"].where(
        (F.col("service_type_value") == ON_DEMAND) & (F.col("process_state") != CANCELLED) & F.col("deleted").isNull()
    )
    rows = services.join(consult, "id").select(
        F.col("health_plan_id").alias("healthplan_id"), "member_id", F.col("id").alias("service_id"), "disease_case_id",
        "created_at", local_date(F.col("created_at")).alias("service_created_at"), "provided_by_object_id",
    )
    kept = last_of_burst(rows, ["member_id"], "created_at", "service_id", rules.burst_minutes)
    contracts = t["payroll_doctor"].where(F.col("type") == rules.primary_type)
    tagged = tag_scheme(kept, contracts, "provided_by_object_id", F.col("service_created_at"), "vc_schema")
    return tagged.drop("created_at", "provided_by_object_id")


def service_counts(services: DataFrame, keys: Sequence[str]) -> DataFrame:
    return services.groupBy(month_start(F.col("service_created_at")).alias("month"), *keys).agg(F.countDistinct("service_id").alias("count_service"))


def unit_cost_monthly(counts: DataFrame, costs: DataFrame, keys: Sequence[str], as_of: dt.date) -> DataFrame:
    """Cost per service by month; the open month takes the unit cost of the month before."""
    keys = list(keys)
    this_month = as_of.replace(day=1)
    last_month = (this_month - dt.timedelta(days=1)).replace(day=1)
    unit = F.try_divide(F.col("subtotal").cast("decimal(24,2)"), F.col("count_service").cast("decimal(14,0)"))
    closed = counts.where(F.col("month") < F.lit(this_month)).join(costs, ["month", *keys], "left")
    closed = closed.select("month", *keys, F.col("subtotal").alias("monthly_total_cost"), "count_service", unit.alias("unit_cost"))
    carried = closed.where(F.col("month") == F.lit(last_month)).select(*keys, "unit_cost")
    current = counts.where(F.col("month") == F.lit(this_month)).join(carried, keys, "left")
    estimate = F.round(F.col("unit_cost") * F.col("count_service"), 2).cast("decimal(18,2)")
    current = current.select("month", *keys, estimate.alias("monthly_total_cost"), "count_service", "unit_cost")
    return closed.withColumn("monthly_total_cost", F.col("monthly_total_cost").cast("decimal(18,2)")).unionByName(current)


def unit_cost_carry_forward(counts: DataFrame, costs: DataFrame, as_of: dt.date, own_fallback: bool = False) -> DataFrame:
    """Cost per service by month and doctor; when the cost is missing or the month is open, the unit cost of the
    doctor's previous month with services. Rows per doctor are months, so the window stays small."""
    this_month = as_of.replace(day=1)
    unit = F.try_divide(F.col("subtotal").cast("decimal(24,2)"), F.col("count_service").cast("decimal(14,0)"))
    rows = counts.join(costs, ["month", "doctor_id"], "left").withColumn("_unit", unit)
    earlier = F.lag("_unit").over(Window.partitionBy("doctor_id").orderBy("month"))
    fallback = F.coalesce(earlier, F.col("_unit")) if own_fallback else earlier
    known = (F.col("month") < F.lit(this_month)) & F.col("subtotal").isNotNull()
    return rows.withColumn("unit_cost", F.when(known, F.col("_unit")).otherwise(fallback)).drop("_unit")


EXACT_MONEY = "decimal(38,10)"


def copay_before_tax(cents: Column) -> Column:
    return F.round(money(cents) / F.lit(TAX_DIVISOR), 2).cast("decimal(18,2)")


def allocate_unit_cost(services: DataFrame, units: DataFrame, keys: Sequence[str], copay: Column | None = None) -> DataFrame:
    """Each service gets its month's unit cost, less the copay before tax where one is given."""
    rows = services.withColumn("month", month_start(F.col("service_created_at")))
    rows = rows.join(units.select("month", *keys, "unit_cost"), ["month", *keys], "left")
    # A copay leaves an amount in cents; without one the shares stay exact, so that they add up to the month's cost.
    amount = F.round("unit_cost", 10) if copay is None else F.round(F.col("unit_cost") - copay, 2)
    return rows.withColumn("subtotal", amount.cast(EXACT_MONEY)).drop("month", "unit_cost")


def clinic_visits(t: Tables, rules: ClaimRules = ClaimRules()) -> DataFrame:
    """Visits at the own clinic that are not cancelled and whose coverage ruling stands, with their fee scheme."""
    services = t["service"].where(
        (F.col("service_type_value") == IN_PERSON_PROVIDER) & (F.col("process_state") != CANCELLED) & F.col("deleted").isNull()
    )
    # One row per service: several standing rulings would repeat it.
    standing = t["coverage_ruling"].where(F.col("state") != "CN").select(F.col("service_id").alias("id"))
    rows = with_clinic_name(services.join(standing, "id", "left_semi"), t).where(F.col("_clinic") == rules.own_clinic)
    rows = rows.select(
        F.col("health_plan_id").alias("healthplan_id"), "member_id", F.col("id").alias("service_id"), "disease_case_id",
        "created_at", local_date(F.col("created_at")).alias("service_created_at"), "doctor_id",
    )
    contracts = t["payroll_doctor"].where(F.col("type") != rules.primary_type)
    return tag_scheme(rows, contracts, "doctor_id", F.col("service_created_at"), "ipc_schema").drop("created_at")


def with_copay(rows: DataFrame, t: Tables) -> DataFrame:
    plans = t["healthplan"].select(F.col("id").alias("healthplan_id"), F.col("product_id").alias("_product"))
    products = t["product"].select(F.col("id").alias("_product"), copay_before_tax(F.col("copay_in_person_consult_cents")).alias("_copay"))
    return rows.join(plans, "healthplan_id", "left").join(products, "_product", "left").drop("_product")


def clinic_costs(t: Tables, visits: DataFrame, as_of: dt.date, rules: ClaimRules = ClaimRules()) -> DataFrame:
    """Visits with allocated cost, per scheme. The payroll scheme is joined on the doctor too, so that one
    doctor's unit cost is not repeated over the others."""
    visits = with_copay(visits, t)
    hourly = visits.where(F.col("ipc_schema") == HOURLY)
    payroll = visits.where(F.col("ipc_schema") == PAYROLL)
    contracts = t["payroll_doctor"].where(F.col("type") != rules.primary_type)
    hourly_units = unit_cost_carry_forward(service_counts(hourly, ["doctor_id"]), t["monthly_cost"], as_of)
    payroll_costs = payroll_by_month(contracts, rules.first_day, as_of, ["doctor_id"])
    payroll_units = unit_cost_carry_forward(service_counts(payroll, ["doctor_id"]), payroll_costs, as_of, own_fallback=True)
    both = allocate_unit_cost(hourly, hourly_units, ["doctor_id"], F.col("_copay")).unionByName(
        allocate_unit_cost(payroll, payroll_units, ["doctor_id"], F.col("_copay"))
    )
    return both.drop("_copay", "doctor_id")


def video_scheme_costs(t: Tables, as_of: dt.date, rules: ClaimRules = ClaimRules()) -> DataFrame:
    """(month, subtotal, vc_schema): what consult hours and salaried doctors cost per month."""
    hourly = hourly_consult_cost(t, rules).unionByName(t["monthly_consult_cost"].select("month", "subtotal"))
    # One row per month: written, so that the joins of payments behind it are over before the report's own begin.
    hourly = materialise(hourly.groupBy("month").agg(F.sum("subtotal").cast("decimal(18,2)").alias("subtotal")), "consult-hours")
    hourly = hourly.withColumn("vc_schema", F.lit(HOURLY))
    contracts = t["payroll_doctor"].where(F.col("type") == rules.primary_type)
    return hourly.unionByName(payroll_by_month(contracts, rules.first_day, as_of).withColumn("vc_schema", F.lit(PAYROLL)))


def video_costs(t: Tables, consults: DataFrame, as_of: dt.date, rules: ClaimRules = ClaimRules()) -> DataFrame:
    costs = video_scheme_costs(t, as_of, rules)
    units = unit_cost_monthly(service_counts(consults, ["vc_schema"]), costs, ["vc_schema"], as_of)
    return allocate_unit_cost(consults, units, ["vc_schema"])


def plan_attributes(premium: DataFrame) -> DataFrame:
    """One row per plan: that of its first amendment."""
    order = [F.col("amendment_id").asc_nulls_first(), *[F.col(c) for c in PLAN_COLUMNS]]
    first = first_per_key(premium, ["healthplan_id"], order)
    return first.select("healthplan_id", *PLAN_COLUMNS)


def latest_payouts(t: Tables, columns: Sequence[str]) -> DataFrame:
    """Newest live payout per service, over all its rulings."""
    rulings = t["coverage_ruling"].select(F.col("id").alias("service_coverage_ruling_id"), "service_id")
    live = t["coverage_payout"].where(F.col("deleted").isNull())
    rows = rulings.join(live, "service_coverage_ruling_id")
    order = [F.col("created_at").desc(), F.col("service_coverage_ruling_id").desc(), *[F.col(c).desc() for c in columns]]
    return first_per_key(rows, ["service_id"], order).select("service_id", *columns)


def without_deleted_payouts(services: DataFrame, t: Tables) -> DataFrame:
    """Services without those whose payouts are all deleted: they have no price to reinsurance and no place among the
    neighbours that others take theirs from. A service with a ruling that has no payout stays."""
    rulings = t["coverage_ruling"].select(F.col("id").alias("_ruling"), F.col("service_id").alias("_service"))
    payouts = t["coverage_payout"].select(F.col("service_coverage_ruling_id").alias("_of"), "deleted")
    rows = rulings.join(payouts, F.col("_ruling") == F.col("_of"), "left")
    gone = rows.groupBy("_service").agg(F.bool_and(F.col("deleted").isNotNull()).alias("_gone")).where("_gone")
    return services.join(gone, services["service_id"] == gone["_service"], "left_anti")


def video_reinsurance_price(consults: DataFrame, t: Tables) -> DataFrame:
    """(service_id, price): payout prices seen so far, filled over the id range each price starts."""
    paid = latest_payouts(t, ["covered_subtotal_cents", "coinsured_subtotal_cents"])
    own = without_deleted_payouts(consults.select("service_id"), t).join(paid, "service_id", "left")
    price = money(F.col("covered_subtotal_cents") + F.col("coinsured_subtotal_cents"))
    return fill_from_breakpoints(own.select("service_id", price.alias("_own")), "service_id", "_own", "price").select("service_id", "price")


def impute_from_neighbours(rows: DataFrame, key: str, order: str, value: str, default: Column, out: str) -> DataFrame:
    """Own value, else the previous row's, else the next row's, else the default."""
    near = with_neighbours(rows, [key], [order], value, range_bucket(F.col(order), split_points(rows, order)), prev="_prev", next="_next")
    return near.withColumn(out, F.coalesce(F.col(value), F.col("_prev"), F.col("_next"), default)).drop("_prev", "_next")


def clinic_reinsurance_price(visits: DataFrame, t: Tables) -> DataFrame:
    paid = latest_payouts(t, ["covered_subtotal_cents"])
    doctor = t["doctor"].select(F.col("id").alias("doctor_id"), F.col("specialization_fare_id").alias("_fare_id"))
    fare = t["fare"].select(F.col("id").alias("_fare_id"), money(F.col("amount_cents")).alias("_fare"))
    rows = with_copay(without_deleted_payouts(visits.select("service_id", "healthplan_id", "doctor_id"), t), t)
    rows = rows.join(paid, "service_id", "left").join(doctor, "doctor_id", "left").join(fare, "_fare_id", "left")
    rows = rows.withColumn("_own", money(F.col("covered_subtotal_cents")))
    default = (F.col("_fare") - F.col("_copay")).cast("decimal(18,2)")
    return impute_from_neighbours(rows, "doctor_id", "service_id", "_own", default, "price").select("service_id", "price")


CLAIM_COLUMNS = (
    "healthplan_id", "member_id", *PLAN_COLUMNS, "service_id", "disease_case_id", "service_created_at", "service_type",
    "vc_schema", "ipc_schema", "transaction_id", "transaction_type", "transaction_date", "subtotal",
)


def _consult_rows(rows: DataFrame, label: str, missing: str) -> DataFrame:
    """Allocated consults in the shape of payments: paid on the day of the service."""
    return (
        rows.withColumn("service_type", F.lit(label))
        .withColumn(missing, F.lit(None).cast("string"))
        .withColumn("transaction_id", F.lit(None).cast("bigint"))
        .withColumn("transaction_type", F.lit("PY"))
        .withColumn("transaction_date", F.col("service_created_at"))
    )


def claims_report(t: Tables, premium: DataFrame, as_of: dt.date, rules: ClaimRules = ClaimRules()) -> DataFrame:
    """All payments of services in one shape, with the price charged to reinsurance and whether it takes part."""
    # Both are read three times below: for the unit cost, its allocation, and the price to reinsurance.
    consults = materialise(video_consults(t, rules), "consults")
    visits = materialise(clinic_visits(t, rules), "visits")
    video = _consult_rows(video_costs(t, consults, as_of, rules), VIDEO_LABEL, "ipc_schema")
    clinic = _consult_rows(clinic_costs(t, visits, as_of, rules), CLINIC_LABEL, "vc_schema")
    # Written, so that what the joins of invoices and transactions shuffle is gone before the report's own joins begin.
    billed = materialise(signed_claims(t, rules), "claims")
    payments = billed.unionByName(video).unionByName(clinic)
    rows = payments.join(plan_attributes(premium), "healthplan_id", "left").select(*CLAIM_COLUMNS)

    # A service is a video consult or a clinic visit, so each has one price.
    prices = video_reinsurance_price(consults, t).unionByName(clinic_reinsurance_price(visits, t))
    prices = prices.withColumnRenamed("price", "subtotal_cost_to_reinsurance")
    listed_service = t["non_ceded_service"].select("service_id").distinct().withColumn("_listed_service", F.lit(True))
    listed_plan = t["non_ceded_plan"].select(F.col("healthplan_uuid").alias("uuid")).distinct()
    listed_plan = t["healthplan"].select(F.col("id").alias("healthplan_id"), "uuid").join(listed_plan, "uuid").drop("uuid")
    listed_plan = listed_plan.withColumn("_listed_plan", F.lit(True))
    rows = rows.join(prices, "service_id", "left").join(listed_service, "service_id", "left").join(listed_plan, "healthplan_id", "left")
    cheap_video = (F.col("service_type") == VIDEO_LABEL) & (F.col("product_id") < rules.low_product_id)
    out = (F.col("product_family") == SMALL_PRODUCT) | F.col("_listed_service").isNotNull() | F.col("_listed_plan").isNotNull() | cheap_video
    in_person = F.col("service_type").isin("In person consult", CLINIC_LABEL)
    return rows.select(
        *[c for c in CLAIM_COLUMNS if c != "ipc_schema"],
        F.when(in_person, F.coalesce("ipc_schema", F.lit(PER_SERVICE))).alias("ipc_schema"),
        "subtotal_cost_to_reinsurance",
        F.when(out, False).otherwise(True).alias("reinsurance_participates"),
    )
