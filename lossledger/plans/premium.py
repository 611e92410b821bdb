"""Premium at amendment grain: exposure, amounts, discount, reinsurance."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossledger.functions.rules import (
    date_diff,
    json_text,
    least_of,
    local_date,
    money,
    number_text,
    safe_ratio,
    title_text,
    trunc_digits,
)
from lossledger.operators.joins import join_member_of, join_role
from lossledger.plans.membership import (
    APPROVED,
    CANCELLING_CATEGORIES,
    INACTIVE,
    RENEWED,
    Tables,
    business_owners,
    cancellations,
    group_size_report,
    live_plans,
    with_owner,
)
from lossledger.sources.tables import materialise

# Legends that mean the base cover, the categories a discount applies to, and the small product.
BASE_LEGENDS = ("Collective Subscription Amendment", "Subscription Amendment")
BASE_COVER = "Base Coverage"
DISCOUNTED = ("Base Coverage", "Maternity Add-On")
SMALL_PRODUCT, SMALL_INSURED = "mini", "0.3M"
SUBTOTAL_CATEGORY = "MDT"


def exposure_days(since: Column, through: Column, cancelled: Column, as_of: Column, null_policy: str = "skip") -> tuple[Column, Column]:
    """(days in force so far, share of the full term), both ends counted.

    ``skip`` takes a plan that was never cancelled up to the as-of date or its end. ``propagate`` leaves it NULL.
    """
    so_far = date_diff(least_of(as_of, through, cancelled, null_policy=null_policy), since, "DAY") + 1
    return so_far, safe_ratio(so_far.cast("double"), (date_diff(through, since, "DAY") + 1).cast("double"))


def amendment_facts(amendments: DataFrame, codes: DataFrame) -> DataFrame:
    """Approved live amendments that add premium, with money amounts, label and cancellation date."""
    cancelling = amendments.where(
        F.col("amendment_category").isin(*CANCELLING_CATEGORIES, "AC") & (F.col("review_result") == APPROVED) & F.col("deleted").isNull()
    ).select(F.col("cancelled_amendment_id").alias("_of"), local_date(F.col("signed_at")).alias("amendment_cancelation_date"))
    # Labels are made on the small code table, not on every amendment.
    label = F.when(F.col("legend").isin(*BASE_LEGENDS), BASE_COVER).otherwise(title_text(F.col("legend")))
    labels = codes.select(F.col("code").alias("_code"), label.alias("_label"))
    live = amendments.where(
        (F.col("premium_total_difference_cents") > 0) & F.col("deleted").isNull() & (F.col("review_result") == APPROVED)
    )
    rows = live.join(labels, F.col("_code") == F.col("amendment_category"), "left").join(cancelling, F.col("_of") == F.col("id"), "left")
    net = F.when(F.col("amendment_category") == SUBTOTAL_CATEGORY, F.col("premium_subtotal_difference_cents")).otherwise(
        F.col("premium_net_premium_difference_cents")
    )
    return rows.select(
        F.col("id").alias("amendment_id"),
        F.col("health_plan_id").alias("healthplan_id"),
        F.col("_label").alias("amendment_category"),
        local_date(F.col("signed_at")).alias("amendment_subscription_date"),
        "amendment_cancelation_date",
        local_date(F.col("valid_since")).alias("amendment_valid_since"),
        local_date(F.col("valid_through")).alias("amendment_valid_through"),
        money(net).alias("net_premium"),
        money(F.col("premium_subscription_type_surcharge_difference_cents")).alias("surcharge"),
        money(F.col("premium_subtotal_difference_cents")).alias("subtotal"),
        money(F.col("premium_total_difference_cents")).alias("total"),
    )


def discount_share(parameters: Column) -> Column:
    """Discount as a share cut to four digits, 0 when not stated."""
    percent = json_text(parameters, "discountPercent").cast("decimal(20,10)")
    return F.coalesce(trunc_digits(percent * F.lit(0.01).cast("decimal(3,2)"), 4), F.lit(0).cast("decimal(28,4)"))


def discount_backout(net: Column, category: Column, share: Column) -> tuple[Column, Column, Column]:
    """(share applied, premium before discount, discount amount)."""
    scope = category.isin(*DISCOUNTED)
    applied = F.when(scope, share).otherwise(F.lit(0).cast("decimal(28,4)"))
    gross_up = F.round(F.try_divide(net, (F.lit(1) - share).cast("decimal(10,4)")), 2).cast("decimal(18,2)")
    gross = F.when(scope & (share > 0), gross_up).otherwise(net)
    return applied, gross, (gross - net).cast("decimal(18,2)")


def ceded(category_in_scope: Column, product_family: Column, listed_plan: Column) -> Column:
    """Reinsurance takes part unless the plan is listed, the product is the small one, or the category is outside."""
    out = listed_plan | (product_family == SMALL_PRODUCT) | ~category_in_scope
    return F.when(out, False).otherwise(True)


def insured_millions(parameters: Column) -> Column:
    cents = json_text(parameters, "maximumCoverageCents").cast("decimal(24,2)")
    return F.round(cents / F.lit(100_000_000), 1).cast("double")


def insured_amount(product_family: Column, millions: Column) -> Column:
    return F.when(product_family == SMALL_PRODUCT, SMALL_INSURED).otherwise(F.concat(number_text(millions), F.lit("M")))


def plan_lookups(t: Tables, group_sizes: DataFrame) -> DataFrame:
    """Plans that are not deleted, cut to what the report needs, with their member, product and owner. These lookups have
    keys of their own; plans without such a key are spread, and business and group are put beside the owner first."""
    member = t["member"].select("id", "date_of_birth", "gender")
    sizes = group_sizes.select("business_ids", "business_group", F.col("max_simultaneous_members_range").alias("business_group_size"))
    owners = join_member_of(business_owners(t["business_admin"], t["business"]), "business_id", sizes, "business_ids").drop("business_ids")
    plans = t["healthplan"].where(F.col("deleted").isNull()).select(
        "id", "deleted", "uuid", "state", "inactive_reason", "subscription_type", "product_id", "beneficiary_member_id", "owner_user_id", "is_owned_by_business",
        F.col("collective_health_plan_id").isNotNull().alias("is_collective"),
        *[local_date(F.col(source)).alias(name) for name, source in (("_signed", "signed_at"), ("_since", "valid_since"), ("_through", "valid_through"))],
        insured_millions(F.col("product_parameters_values")).alias("_millions"),
        discount_share(F.col("product_parameters_values")).alias("_discount_share"),
    )
    # Only products that some plan has: those are few, however long the list is.
    sold = t["product"].join(plans.select(F.col("product_id").alias("id")).distinct(), "id", "left_semi")
    rows = join_role(plans, sold, "product_id", "id", {"product_family": "product_family"})
    rows = rows.withColumn("_millions", insured_amount(F.col("product_family"), F.col("_millions"))).withColumnRenamed("_millions", "insured_amount")
    rows = join_role(rows, member, "beneficiary_member_id", "id", {"date_of_birth": "date_of_birth", "gender": "gender"})
    return with_owner(rows, owners).drop("owner_user_id")


def plan_base(t: Tables, as_of: dt.date, group_sizes: DataFrame, null_policy: str = "skip") -> DataFrame:
    """One row per live plan with member, product, owner and exposure attributes. Each lookup has one row per key, so
    no DISTINCT over the wide rows is needed (several owners, reasons or groups of a plan do give several rows). What
    has the plan's own key is joined last, renewals, cancellations and amendments after one another, in one shuffle."""
    today = F.lit(as_of)
    canc = cancellations(t["healthplan"], t["amendment"], t["cancel_reason"]).select(
        F.col("healthplan_id").alias("_hp"), local_date(F.col("cancelled_at")).alias("_cancelled"), F.col("cancel_reason").alias("_reason")
    )
    internal = t["internal_plan"].select(F.col("internal").alias("_internal")).distinct()
    rows = live_plans(t["healthplan"], plan_lookups(t, group_sizes))
    rows = rows.join(canc, F.col("_hp") == F.col("id"), "left")
    rows = rows.join(internal, F.col("_internal") == F.col("id"), "left")
    signed, since, through, cancelled = (F.col(name) for name in ("_signed", "_since", "_through", "_cancelled"))
    expired = today > through
    so_far, share = exposure_days(since, through, cancelled, today, null_policy)
    reason = F.coalesce(
        F.col("_reason"),
        F.when(expired & F.col("renewal_id").isNull() & (F.col("state") == INACTIVE), "Did not renew").when(
            (F.col("inactive_reason") == RENEWED) | F.col("renewal_id").isNotNull(), "Plan was renewed"
        ),
    )
    return rows.select(
        F.col("id").alias("healthplan_id"),
        F.when(F.col("is_owned_by_business"), "B2B").otherwise("B2C").alias("vertical"),
        "product_id",
        "product_family",
        "uuid",
        "business_id",
        "business_name",
        "business_group",
        "business_group_size",
        "is_collective",
        F.col("beneficiary_member_id").alias("member_id"),
        "insured_amount",
        signed.alias("subscription_date"),
        F.when(expired | cancelled.isNotNull(), F.coalesce(cancelled, through)).alias("cancelation_date"),
        reason.alias("cancel_reason"),
        so_far.alias("healthplan_vigour_days_so_far"),
        share.alias("healthplan_vigour_days_so_far_prop"),
        F.col("_internal").isNotNull().alias("is_internal"),
        F.when((F.col("state") == "AC") & (today < through), "Active").otherwise("Inactive").alias("healthplan_state"),
        "subscription_type",
        date_diff(signed, F.to_date("date_of_birth", "yyyy-MM-dd"), "YEAR").alias("age_at_subscription"),
        "gender",
        "_discount_share",
    )


def listed_plans(plans: DataFrame, listed: DataFrame) -> DataFrame:
    """(healthplan_id, uuids) of the plans whose uuid is listed, so that reports meet the list by the plan's key."""
    names = listed.select(F.col("healthplan_uuid").alias("uuid")).distinct()
    found = plans.where(F.col("id").isNotNull()).select("id", "uuid").join(names, "uuid")
    return found.groupBy(F.col("id").alias("_plan")).agg(F.collect_set("uuid").alias("_listed"))


def premium_report(t: Tables, as_of: dt.date, group_sizes: DataFrame | None = None, null_policy: str = "skip") -> DataFrame:
    """One row per plan and premium amendment (a plan without one keeps a row of NULL amounts)."""
    sizes = materialise(group_size_report(t, as_of), "group_sizes") if group_sizes is None else group_sizes
    listed = listed_plans(t["healthplan"], t["non_ceded_plan"])
    rows = plan_base(t, as_of, sizes, null_policy)
    rows = rows.join(amendment_facts(t["amendment"], t["amendment_code"]), "healthplan_id", "left")
    rows = rows.join(listed, F.col("_plan") == F.col("healthplan_id"), "left")
    is_listed = F.coalesce(F.array_contains("_listed", F.col("uuid")), F.lit(False))
    ended = F.coalesce("amendment_cancelation_date", "cancelation_date")
    so_far, share = exposure_days(F.col("amendment_valid_since"), F.col("amendment_valid_through"), ended, F.lit(as_of), null_policy)
    applied, gross, discount = discount_backout(F.col("net_premium"), F.col("amendment_category"), F.col("_discount_share"))
    has_amendment = F.col("amendment_id").isNotNull()
    return rows.withColumns(
        {
            "amendment_vigour_days_so_far": so_far,
            "amendment_vigour_days_so_far_prop": share,
            "reinsurance_participates": F.when(
                has_amendment, ceded(F.col("amendment_category").isin(*DISCOUNTED), F.col("product_family"), is_listed)
            ).otherwise(True),
            "discountpercent": F.coalesce(applied, F.lit(0).cast("decimal(28,4)")),
            "net_premium_before_discount": gross,
            "discount": F.coalesce(discount, F.lit(0).cast("decimal(18,2)")),
            "amendment_cancelation_date": ended,
        }
    ).drop("_plan", "_listed", "_discount_share", "uuid")


def installment_gross(gross: Column, installment_net: Column, net: Column) -> Column:
    """Instalment before discount: gross premium scaled by the instalment's part of the net premium."""
    exact = F.try_divide((gross * installment_net).cast("decimal(30,4)"), net.cast("decimal(18,2)"))
    return F.round(exact, 6).cast("decimal(28,6)")
