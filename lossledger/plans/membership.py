"""Plans, members and groups: cancellation, group state, head counts, size report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossledger.functions.rules import OPEN_END, json_text, least_of, local_date, size_band
from lossledger.operators.aggregates import distinct_array
from lossledger.operators.joins import join_role
from lossledger.operators.ordered import join_summary, with_key_aggregate
from lossledger.sources.tables import materialise

Tables = Mapping[str, DataFrame]

# Amendment and plan codes.
BASE_CATEGORIES = ("SA", "CS", "AS")
CANCELLING_CATEGORIES = ("CN", "DB", "FR")
APPROVED = "AP"
ACTIVE, INACTIVE, RENEWED = "AC", "IN", "RN"
OWNER_ROLE = "OW"
NO_REASON = "Other / not specified"


def _cancelling(amendments: DataFrame) -> DataFrame:
    return amendments.where(F.col("cancelled_amendment_id").isNotNull()).select(
        F.col("cancelled_amendment_id").alias("ca_of"),
        F.col("id").alias("ca_id"),
        F.col("signed_at").alias("ca_signed_at"),
        F.col("amendment_category").alias("ca_category"),
        F.col("review_result").alias("ca_review"),
        F.col("deleted").alias("ca_deleted"),
        F.col("amendment_extras").alias("ca_extras"),
    )


def _effective(prefix: str = "ca") -> Column:
    return (
        (F.col(f"{prefix}_review") == APPROVED)
        & F.col(f"{prefix}_deleted").isNull()
        & F.col(f"{prefix}_category").isin(*CANCELLING_CATEGORIES)
    )


def _approved_base(amendments: DataFrame) -> DataFrame:
    return amendments.where(
        (F.col("review_result") == APPROVED) & F.col("amendment_category").isin(*BASE_CATEGORIES) & F.col("deleted").isNull()
    )


def cancellation_dates(plans: DataFrame, amendments: DataFrame, null_policy: str = "skip") -> DataFrame:
    """(healthplan_id, cancelled_at): earliest of min(end of term, cancellation) over approved base amendments.

    A base amendment with cancelling rows counts only through those that are effective, and not at all when none is.
    An effective cancellation without a date takes the plan's own. A plan that was never cancelled keeps a row with
    NULL. Amendments are reduced to one row per base amendment, then per plan, before anything is joined to plans.
    """
    undated = _effective() & F.col("ca_signed_at").isNull()
    ca = _cancelling(amendments).groupBy("ca_of").agg(
        F.min(F.when(_effective(), F.col("ca_signed_at"))).alias("_dated"), F.max(undated).alias("_undated"), F.max(_effective()).alias("_effective")
    )
    base = _approved_base(amendments).select(F.col("id").alias("base_id"), F.col("health_plan_id").alias("healthplan_id"))
    pairs = base.join(ca, F.col("ca_of") == F.col("base_id"), "left").where(F.col("ca_of").isNull() | F.col("_effective"))
    per_plan = pairs.groupBy("healthplan_id").agg(
        F.min("_dated").alias("_dated"), F.max(F.col("ca_of").isNull() | F.coalesce("_undated", F.lit(False))).alias("_own")
    )
    live = plans.where(F.col("deleted").isNull()).select(F.col("id").alias("healthplan_id"), "valid_through", "cancelled_at")
    at = F.least("_dated", F.when(F.col("_own"), F.col("cancelled_at")))
    ended = F.when(at.isNotNull(), least_of(F.col("valid_through"), at, null_policy=null_policy))
    return live.join(per_plan, "healthplan_id").select("healthplan_id", ended.alias("cancelled_at"))


def cancellation_reasons(amendments: DataFrame, reasons: DataFrame) -> DataFrame:
    """(healthplan_id, cancel_reason) of each effective, signed cancelling amendment of a signed base amendment."""
    base = _approved_base(amendments).where(F.col("signed_at").isNotNull())
    base = base.select(F.col("id").alias("base_id"), F.col("health_plan_id").alias("healthplan_id"))
    ca = _cancelling(amendments).where(_effective() & F.col("ca_signed_at").isNotNull())
    coded = base.join(ca, F.col("ca_of") == F.col("base_id")).withColumn("code", json_text(F.col("ca_extras"), "cancel_reason"))
    named = coded.join(reasons, "code", "left").select("healthplan_id", F.coalesce("description", F.lit(NO_REASON)).alias("cancel_reason"))
    return named.distinct()


def cancellations(plans: DataFrame, amendments: DataFrame, reasons: DataFrame) -> DataFrame:
    dates = cancellation_dates(plans, amendments).where(F.col("cancelled_at").isNotNull())
    return dates.join(cancellation_reasons(amendments, reasons), "healthplan_id", "left").withColumn(
        "cancel_reason", F.coalesce("cancel_reason", F.lit(NO_REASON))
    )


def live_plans(plans: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Plans in force as records: not deleted, beside a live renewal's id. A plan all of whose renewal records are
    deleted is left out. Renewals are reduced to one row per plan first, so a plan stays one row. ``rows`` are the plans
    with other columns, where those are joined first (by default ``plans`` as they are)."""
    renewals = plans.where(F.col("previous_health_plan_id").isNotNull()).groupBy(F.col("previous_health_plan_id").alias("_prev"))
    renewals = renewals.agg(F.min(F.when(F.col("deleted").isNull(), F.col("id"))).alias("renewal_id"))
    live = (plans if rows is None else rows).where(F.col("deleted").isNull()).join(renewals, F.col("_prev") == F.col("id"), "left")
    return live.where(F.col("_prev").isNull() | F.col("renewal_id").isNotNull()).drop("_prev")


def business_owners(admins: DataFrame, businesses: DataFrame) -> DataFrame:
    """(owner, business_id, business_name) of each owner of a business."""
    names = businesses.select(F.col("id").alias("_b"), F.trim(F.coalesce("common_name", "legal_name")).alias("business_name"))
    owners = admins.where(F.col("role") == OWNER_ROLE).select(F.col("user_id").alias("owner"), "business_id")
    return owners.distinct().join(names, F.col("_b") == F.col("business_id"), "left").drop("_b")


def with_owner(plans: DataFrame, owners: DataFrame) -> DataFrame:
    """Adds what is known of the owner (all columns but ``owner``) to business-owned plans. Other plans have no owner to
    meet: they are spread, where a plain join would gather them in one task."""
    columns = {c: c for c in owners.columns if c != "owner"}
    return join_role(plans, owners, "owner_user_id", "owner", columns, when=F.col("is_owned_by_business"))


def with_business(plans: DataFrame, admins: DataFrame, businesses: DataFrame) -> DataFrame:
    """Adds business_id and business_name of the owner, for business-owned plans. Owners and names are joined first,
    so the plans are joined once."""
    return with_owner(plans, business_owners(admins, businesses))


def business_members(t: Tables, as_of: dt.date, internal_inverted: bool = False) -> DataFrame:
    """One row per business plan with its dates. ``internal_inverted`` gives the flag's sign as the size view's
    original had it; the default agrees with the premium report."""
    owned = live_plans(t["healthplan"]).where("is_owned_by_business")
    internal = t["internal_plan"].select(F.col("internal").alias("_internal")).distinct()
    canc = cancellation_dates(t["healthplan"], t["amendment"]).select(
        F.col("healthplan_id").alias("_hp"), local_date(F.col("cancelled_at")).alias("_cancelled")
    )
    rows = with_business(owned, t["business_admin"], t["business"])
    rows = rows.join(canc, F.col("_hp") == F.col("id"), "left").join(internal, F.col("_internal") == F.col("id"), "left")
    rows = rows.withColumn("_through", local_date(F.col("valid_through")))
    through, listed = F.col("_through"), F.col("_internal").isNotNull()
    # No DISTINCT: plans, owners, cancellations and the internal list have one row per key here.
    return rows.select(
        F.col("id").alias("healthplan_id"),
        "business_id",
        "business_name",
        F.col("beneficiary_member_id").alias("member_id"),
        local_date(F.col("signed_at")).alias("subscription_date"),
        F.coalesce("_cancelled", F.when(through < F.lit(as_of), through)).alias("cancelation_date"),
        (~listed if internal_inverted else listed).alias("is_internal"),
        F.col("state").alias("healthplan_state"),
    )


def business_states(members: DataFrame) -> DataFrame:
    """Per business: whether any member is active, the last cancellation once none is, and its number of rows."""
    per = members.groupBy("business_id").agg(
        F.max(F.when(F.col("healthplan_state") == ACTIVE, F.col("member_id"))).alias("_any"),
        F.max("cancelation_date").alias("_last"),
        F.count(F.lit(1)).alias("_n"),
    )
    state = F.when(F.col("business_id").isNotNull(), F.when(F.col("_any").isNotNull(), ACTIVE).otherwise(INACTIVE))
    return per.select("business_id", state.alias("business_state"), F.when(state == INACTIVE, F.col("_last")).alias("business_cancelation_date"), "_n")


def with_group_state(members: DataFrame) -> DataFrame:
    """Adds business_state, and the last cancellation as business_cancelation_date once no member is active."""
    return join_summary(members, business_states(members), ["business_id"], "_n")


def with_group(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Adds the state of the business and business_group: the listed group of the business, else its name. Both are
    facts of the business, so they are put together before one join to the members."""
    listed = groups.select("business_id", F.col("group").alias("_group"))
    facts = business_states(members).join(listed, "business_id", "left")
    named = join_summary(members, facts, ["business_id"], "_n")
    return named.withColumn("business_group", F.coalesce("_group", "business_name")).drop("_group")


def grouped_members(t: Tables, as_of: dt.date) -> DataFrame:
    """Business members with their group. The members are written first, since states and groups are joined back to
    them and would otherwise repeat their joins."""
    return with_group(materialise(business_members(t, as_of), "members"), t["business_group"])


def group_business_ids(members: DataFrame) -> DataFrame:
    return distinct_array(members, ["business_group"], "business_id", "business_ids")


def group_dates(members: DataFrame) -> DataFrame:
    return members.groupBy("business_group").agg(
        F.max("business_cancelation_date").alias("business_group_cancelation_date"),
        F.min("subscription_date").alias("business_group_incorporation_date"),
    )


def peak_concurrent(members: DataFrame, group: str, member: str, start: str, end: str, out: str) -> DataFrame:
    """Largest number of distinct members active on one day, per group.

    A member counts from ``start`` up to the day before ``end`` (NULL is open). A member's overlapping spells are
    cut so that they do not overlap, each remaining spell is +1 / -1, and deltas per day are summed up in order.
    Windows see at most one row per day and (group, member), then per day and group, whatever the row count.
    """
    open_end = F.lit(OPEN_END).cast("date")
    spells = members.where(F.col(member).isNotNull() & F.col(group).isNotNull() & F.col(start).isNotNull())
    spells = spells.groupBy(group, member, F.col(start).alias("_from")).agg(F.max(F.coalesce(F.col(end), open_end)).alias("_to"))
    before = Window.partitionBy(group, member).orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    spells = spells.withColumn("_reached", F.max("_to").over(before))
    spells = spells.withColumn("_from", F.greatest("_from", "_reached")).where(F.col("_from") < F.col("_to"))
    steps = F.array(
        F.struct(F.col("_from").alias("day"), F.lit(1).alias("delta")), F.struct(F.col("_to").alias("day"), F.lit(-1).alias("delta"))
    )
    per_day = spells.select(group, F.explode(steps).alias("s")).groupBy(group, "s.day").agg(F.sum("s.delta").alias("delta"))
    running = Window.partitionBy(group).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    peaks = per_day.withColumn("_n", F.sum("delta").over(running)).groupBy(group).agg(F.max("_n").alias("_peak"))
    groups = members.select(group).distinct()
    return groups.join(peaks, group, "left").select(group, F.coalesce("_peak", F.lit(0)).cast("bigint").alias(out))


def active_on(start: str, end: str, day: Column) -> Column:
    return (F.col(start) <= day) & (F.col(end).isNull() | (F.col(end) > day))


def active_after(members: DataFrame, days: int = 30) -> DataFrame:
    """Distinct members active ``days`` after the group's first subscription."""
    slim = members.select("business_group", "member_id", "subscription_date", "cancelation_date")
    rows = with_key_aggregate(slim, ["business_group"], {"_first": F.min("subscription_date")})
    inside = active_on("subscription_date", "cancelation_date", F.date_add("_first", days))
    # Distinct members first, so that a large group is counted from reduced parts.
    pairs = rows.groupBy("business_group", "member_id").agg(F.max(inside).alias("_in"))
    counted = F.count(F.when(F.col("_in"), F.col("member_id")))
    return pairs.groupBy("business_group").agg(counted.alias("active_after_30_days"))


def members_today(members: DataFrame) -> DataFrame:
    return members.where(F.col("healthplan_state") == ACTIVE).groupBy("business_group").agg(F.countDistinct("member_id").alias("members_today"))


def group_size_report(t: Tables, as_of: dt.date) -> DataFrame:
    """One row per business group: dates, ids, three head counts and their size bands."""
    members = materialise(grouped_members(t, as_of), "grouped_members")
    dates = group_dates(members)
    peak = peak_concurrent(members, "business_group", "member_id", "subscription_date", "cancelation_date", "max_simultaneous_members")
    merged = peak.join(members_today(members), "business_group", "full").join(active_after(members), "business_group", "full")
    today = F.coalesce("members_today", F.lit(0)).cast("bigint")
    after = F.coalesce("active_after_30_days", F.lit(0)).cast("bigint")
    merged = merged.join(dates, "business_group", "left").join(group_business_ids(members), "business_group", "left")
    return merged.select(
        "business_group",
        "business_ids",
        "business_group_incorporation_date",
        F.when(today == 0, F.col("business_group_cancelation_date")).alias("business_group_cancelation_date"),
        after.alias("members_30_days_after_incorporation"),
        "max_simultaneous_members",
        today.alias("members_as_of_today"),
        size_band(after).alias("members_30_days_after_incorporation_range"),
        size_band(F.col("max_simultaneous_members")).alias("max_simultaneous_members_range"),
        size_band(today).alias("members_as_of_today_range"),
    )


def with_group_dates(members: DataFrame) -> DataFrame:
    """Group dates beside each member row (a whole-partition MAX and MIN)."""
    return with_key_aggregate(
        members,
        ["business_group"],
        {
            "business_group_cancelation_date": F.max("business_cancelation_date"),
            "business_group_incorporation_date": F.min("subscription_date"),
        },
    )
