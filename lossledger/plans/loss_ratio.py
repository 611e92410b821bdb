"""Loss ratio by month end and plan class: claims paid over premium collected and earned."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossledger.functions.rules import date_diff, least_of, round_ratio
from lossledger.operators.aggregates import rollup_levels
from lossledger.operators.spines import month_grid
from lossledger.sources.tables import materialise

# Class labels, the window lengths of the trailing ratios, and the first cutoff's next month.
OVERALL, RETAIL, BUSINESS, SMALL_BUSINESS, LARGER_BUSINESS = "Overall", "B2C", "B2B", "B2B (1 - 9)", "B2B (10 or more)"
ALL_SERVICES = "All services"
TRAILING_MONTHS = (1, 3, 6, 12)
FIRST_MONTH = dt.date(2020, 11, 1)


def plan_classes(premium: DataFrame) -> DataFrame:
    """(healthplan_id, hp_class) of plans with at least one row that is not internal."""
    label = F.when(F.col("vertical") == RETAIL, RETAIL).otherwise(F.concat("vertical", F.lit(" ("), "business_group_size", F.lit(")")))
    outside = premium.where(~F.col("is_internal")).select("healthplan_id")
    rows = premium.select("healthplan_id", label.alias("hp_class")).distinct()
    return rows.join(outside, "healthplan_id", "left_semi")


def first_cutoff(day: Column, start: dt.date) -> Column:
    """The earliest month end at or after the day, not before the first cutoff (the day before ``start``)."""
    return F.greatest(F.last_day(day), F.lit(start - dt.timedelta(days=1)))


def last_cutoff(as_of: dt.date) -> dt.date:
    return as_of.replace(day=1) - dt.timedelta(days=1)


def cumulative_to_cutoff(facts: DataFrame, day: str, classes: Sequence[str], amount: str, grid: DataFrame, start: dt.date, out: str) -> DataFrame:
    """Running total per class at every cutoff of the grid, zero where nothing happened yet.

    The condition "day <= cutoff" is a bucket (the first cutoff that includes the day) and a running sum over the
    grid, so a fact is counted once rather than once per later cutoff.
    """
    bucket = facts.withColumn("date_date", first_cutoff(F.col(day), start)).groupBy("date_date", *classes).agg(F.sum(amount).alias("_sum"))
    along = Window.partitionBy(*classes).orderBy("date_date").rowsBetween(Window.unboundedPreceding, 0)
    rows = grid.join(bucket, ["date_date", *classes], "left")
    total = F.coalesce(F.sum("_sum").over(along), F.lit(0))
    return rows.withColumn(out, F.round(total, 2).cast("decimal(18,2)")).drop("_sum")


def earned_share(since: Column, through: Column, ended: Column, cutoff: Column) -> Column:
    """Part of an instalment earned by a cutoff. ``ended`` is the earliest of end of cover, cancellations and the
    as-of date; the share is 1 once the whole term is over by then, 0 before it starts, never negative."""
    upto = F.least(ended, cutoff)
    days = (date_diff(upto, since, "DAY") + 1).cast("bigint")
    term = (date_diff(through, since, "DAY") + 1).cast("bigint")
    # Rounded half up to ten digits in long arithmetic: days are fewer than 10 ** 7, so the products fit.
    up, down = days * F.signum(term).cast("bigint"), F.abs(term)
    units = F.call_function("div", up * F.lit(2 * 10**10) + down, down * 2)
    part = F.when((up > 0) & (down > 0), (units.cast("decimal(18,0)") * F.lit(Decimal("0.0000000001"))).cast("decimal(20,10)")).otherwise(0)
    return F.when(through <= upto, 1).when(since > cutoff, 0).otherwise(part).cast("decimal(12,10)")


def accrued_to_cutoff(
    collections: DataFrame, classes: DataFrame, start: dt.date, as_of: dt.date, null_policy: str = "skip"
) -> DataFrame:
    """(date_date, hp_class, accrued_and_collected_premium) at every cutoff.

    Per instalment and cutoff: what was collected by then, times the share earned by then. What is visible of an
    instalment changes only at a few cutoffs, so rows are first summed per instalment and first visible cutoff. Each
    resulting state is spread over the cutoffs until its share settles; from there on it is constant and is carried
    as one step up (and one down when the next state starts). So rows grow with the length of an instalment, not
    with the number of months up to today.
    """
    final = last_cutoff(as_of)
    keys = ["amendment_id", "installment_number", "hp_class"]
    seen = F.greatest("transaction_date", "amendment_subscription_date", "subscription_date")
    rows = collections.where(
        F.col("transaction_date").isNotNull() & F.col("amendment_subscription_date").isNotNull() & F.col("subscription_date").isNotNull()
    )
    rows = rows.join(classes, "healthplan_id").withColumn("_from", first_cutoff(seen, start)).where(F.col("_from") <= F.lit(final))
    # Dealt out by instalment, rows meet their month's others and the months after one another in one shuffle.
    state = rows.repartition(*keys).groupBy(*keys, "_from").agg(
        F.min("installment_valid_since").alias("_since"),
        F.min("installment_valid_through").alias("_through"),
        F.min("amendment_cancelation_date").alias("_amendment_end"),
        F.min("cancelation_date").alias("_plan_end"),
        F.sum("installment_net_premium_before_discount").alias("_paid"),
    )
    seen_so_far = Window.partitionBy(*keys).orderBy("_from")
    so_far = seen_so_far.rowsBetween(Window.unboundedPreceding, 0)
    state = state.select(
        *keys,
        "_from",
        F.lead("_from").over(seen_so_far).alias("_next"),
        F.min("_since").over(so_far).cast("date").alias("_since"),
        F.min("_through").over(so_far).cast("date").alias("_through"),
        F.min("_amendment_end").over(so_far).alias("_amendment_end"),
        F.min("_plan_end").over(so_far).alias("_plan_end"),
        F.sum("_paid").over(so_far).cast("decimal(20,6)").alias("_paid"),
    )
    ended = least_of(F.col("_amendment_end"), F.col("_through"), F.lit(as_of), F.col("_plan_end"), null_policy=null_policy)
    state = state.withColumn("_ended", ended)
    # The first cutoff from which the share no longer changes, within this state's own cutoffs.
    settled = first_cutoff(F.greatest(F.coalesce("_ended", "_since"), "_since"), start)
    until = F.coalesce(F.last_day(F.add_months("_next", -1)), F.lit(final))
    state = state.withColumn("_until", until).withColumn("_settled", F.least(F.greatest(settled, F.col("_from")), F.col("_until")))

    # One row per month up to the settled one, then the step up and the step down where they lie on the grid and differ.
    # Months are made into dates and amounts after spreading, in generated code and once per row.
    months = date_diff(F.col("_settled"), F.col("_from"), "MONTH")
    steps = F.when(F.col("_settled") >= F.col("_until"), 0).when(F.col("_next").isNull(), 1).otherwise(2)
    spread = state.withColumn("_months", months).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_months") + steps)))
    past = F.col("_i") - F.col("_months")
    cutoff = F.when(past <= 0, F.last_day(F.add_months("_from", F.col("_i")))).otherwise(F.col("_settled"))
    spread = spread.withColumn("_cutoff", cutoff)
    share = earned_share(F.col("_since"), F.col("_through"), F.col("_ended"), F.col("_cutoff"))
    if null_policy == "propagate":
        share = F.when(F.col("_since") > F.col("_cutoff"), F.lit(0).cast("decimal(12,10)")).when(F.col("_ended").isNotNull(), share)
    spread = spread.withColumn("_share", share)
    # Most rows have nothing or all of it earned: they need no product.
    zero, paid = F.lit(0).cast("decimal(28,6)"), F.col("_paid").cast("decimal(28,6)")
    part = F.when(F.col("_share") == 0, zero).when(F.col("_share") == 1, paid).otherwise(F.round(F.col("_paid") * F.col("_share"), 6).cast("decimal(28,6)"))
    day = F.when(past <= 0, F.col("_cutoff")).when(past == 1, F.last_day(F.add_months("_settled", 1))).otherwise(F.last_day(F.add_months("_until", 1)))
    spread = spread.select("hp_class", day.alias("date_date"), F.greatest(past, F.lit(0)).alias("_step"), F.coalesce(part, zero).alias("_value"))
    # A row is of one kind, so one sum is kept for each kind; months x classes x kinds are few.
    summed = spread.groupBy("hp_class", "date_date", "_step").agg(F.sum("_value").alias("_sum"))
    summed = summed.groupBy("hp_class", "date_date").agg(
        F.sum(F.when(F.col("_step") == 0, F.col("_sum")).otherwise(zero)).alias("_here"),
        F.sum(F.when(F.col("_step") == 1, F.col("_sum")).when(F.col("_step") == 2, -F.col("_sum")).otherwise(zero)).alias("_onward"),
    )

    grid = month_grid(classes.select("hp_class").distinct(), start, as_of)
    along = Window.partitionBy("hp_class").orderBy("date_date").rowsBetween(Window.unboundedPreceding, 0)
    total = F.coalesce("_here", F.lit(0)) + F.coalesce(F.sum("_onward").over(along), F.lit(0))
    # The grid is months x classes, so one window over all of it is small.
    first_seen = F.min(F.when(F.col("_here").isNotNull(), F.col("date_date"))).over(Window.partitionBy())
    filled = grid.join(summed, ["hp_class", "date_date"], "left").withColumn("_total", total)
    premium = F.when(F.col("date_date") >= first_seen, F.round("_total", 2).cast("decimal(18,2)"))
    return filled.select("date_date", "hp_class", premium.alias("accrued_and_collected_premium"))


def class_levels(class_col: str = "hp_class") -> dict[int, Column]:
    """Label of a class at each level: overall, business or retail, small or larger business, as it is."""
    c = F.col(class_col)
    return {
        0: F.lit(OVERALL),
        1: F.when(c == RETAIL, RETAIL).otherwise(BUSINESS),
        2: F.when(c == RETAIL, RETAIL).when(c == SMALL_BUSINESS, SMALL_BUSINESS).otherwise(LARGER_BUSINESS),
        3: c,
    }


def with_trailing_ratios(df: DataFrame, keys: Sequence[str], order: str, num: str, den: str) -> DataFrame:
    """Running ratio and the ratio of the changes over the last 1, 3, 6 and 12 rows, NULL on a zero denominator."""
    w = Window.partitionBy(*keys).orderBy(order)
    out = df.withColumn("mlr_running_total", round_ratio(F.col(num), F.col(den), 4))
    for n in TRAILING_MONTHS:
        change = round_ratio(F.col(num) - F.lag(num, n).over(w), F.col(den) - F.lag(den, n).over(w), 4)
        out = out.withColumn(f"mlr_last_{n}_months", change)
    return out


def claims_in_scope(claims: DataFrame, classes: DataFrame, as_of: dt.date) -> DataFrame:
    """Claims of classed plans paid and created by the last cutoff."""
    final = F.lit(last_cutoff(as_of))
    rows = claims.where((F.col("transaction_date") <= final) & (F.col("service_created_at") <= final))
    return rows.join(classes, "healthplan_id").withColumn("ss_class", F.lit(ALL_SERVICES))


def loss_ratio_report(
    premium: DataFrame, collections: DataFrame, claims: DataFrame, as_of: dt.date, start: dt.date = FIRST_MONTH, null_policy: str = "skip"
) -> DataFrame:
    """Four granularities by month end with running and trailing loss ratios."""
    classes = materialise(plan_classes(premium), "classes")
    grid = month_grid(classes.select("hp_class").distinct().withColumn("ss_class", F.lit(ALL_SERVICES)), start, as_of)
    # Both sides are months x classes. Written one after the other, what the one has shuffled is gone before the other begins.
    paid = cumulative_to_cutoff(
        claims_in_scope(claims, classes, as_of), "transaction_date", ["hp_class", "ss_class"], "subtotal", grid, start, "service_payments"
    )
    paid = materialise(paid, "paid")
    earned = materialise(accrued_to_cutoff(collections, classes, start, as_of, null_policy), "earned")
    finest = paid.join(earned, ["date_date", "hp_class"], "left")
    levels = rollup_levels(
        finest, class_levels(), "hp_class", ["date_date", "ss_class"], ["service_payments", "accrued_and_collected_premium"]
    )
    return with_trailing_ratios(
        levels, ["granularity_level", "hp_class", "ss_class"], "date_date", "service_payments", "accrued_and_collected_premium"
    )
