"""Shapes of physical plans that decide whether a query survives large tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SMALL

QUERIES = entry.queries()


def plan(spark, name):
    return QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [
        "array_membership_join", "asof_breakpoint_fill", "breakpoint_ranges", "cumulative_to_cutoff", "interval_join_keyed", "interval_join_theta", "active_at_date",
        "grid_cross_join", "scalar_broadcast_filter", "correlated_count_asof", "peak_concurrent", "accrued_to_cutoff", "nearest_centroid", "signed_collections",
    ],
)
def test_no_pairwise_join(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["dedupe_first_per_key", "dedupe_latest_per_key", "collect_set_top10"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(spark, name)


def test_filters_and_columns_reach_the_scan(spark):
    df = QUERIES["filter_range"](spark, SMALL)
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "GreaterThan(o_totalprice,100000.0)" in text.split("PushedFilters:")[1]
    schema = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert "o_custkey" not in schema and "o_orderpriority" not in schema


def test_semi_join_widens_nothing(spark):
    assert "LeftSemi" in plan(spark, "semi_join_in")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_key_aggregates_add_up_instead_of_multiplying(spark, no_broadcast):
    """Every further key reads the table once more (the rows), and its summary was written."""
    from lossledger.operators.ordered import with_key_aggregate
    from lossledger.sources.tables import read_table

    rows = read_table(spark, SMALL, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    scans = []
    for key in ("o_custkey", "o_orderpriority", "o_orderstatus"):
        rows = with_key_aggregate(rows, [key], {f"n_{key}": F.count("o_orderkey")})
        text = rows._jdf.queryExecution().executedPlan().toString()
        scans.append(text.count("orders.parquet"))
    assert scans == [1, 1, 1]


def test_records_collapse_in_one_grouping(spark, no_broadcast):
    assert plan(spark, "collapse_latest").count("Exchange hashpartitioning") <= 5  # two joins of two sides and one grouping


@pytest.mark.parametrize("name", ["breakpoint_ranges", "asof_breakpoint_fill"])
def test_prices_are_ordered_range_by_range(spark, name):
    assert "SinglePartition" not in plan(spark, name)


def test_price_ranges_fill_without_one_task_over_all_rows(spark, no_broadcast):
    text = plan(spark, "asof_breakpoint_fill")
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_plans_without_owner_are_spread(spark):
    """Plans that no business owns have no owner to meet; in a join by owner they must not gather in one task."""
    from lossledger.plans.membership import with_business

    plans = spark.range(2000).select("id", F.lit(7).cast("long").alias("owner_user_id"), (F.col("id") % 100 == 0).alias("is_owned_by_business"))
    admins = spark.createDataFrame([(1, 7, "OW")], "business_id long, user_id long, role string")
    businesses = spark.createDataFrame([(1, " One ", None)], "id long, common_name string, legal_name string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        rows = with_business(plans, admins, businesses).withColumn("_task", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(rows) == 2000 and sum(r["business_name"] == "One" for r in rows) == 20
    alone = [r["_task"] for r in rows if r["business_id"] is None]
    assert len(alone) == 1980 and max(alone.count(k) for k in set(alone)) < 1000


def test_wide_rows_meet_doctors_and_members_once(spark):
    """Fares, specialities and addresses are put beside the doctor or member first: each join of the wide rows may shuffle them."""

    def joins(node):
        children = [node.children().apply(i) for i in range(node.children().size())]
        own = node.nodeName() == "Join" and "case_event_id" in children[0].output().mkString(",")
        return own + sum(joins(c) for c in children)

    assert joins(QUERIES["wide_fact"](spark, SMALL)._jdf.queryExecution().optimizedPlan()) <= 21


def test_transaction_times_are_dates_before_they_are_shuffled(spark):
    text = plan(spark, "signed_collections").splitlines()
    above = [n for n, line in enumerate(text) if "SortMergeJoin [amendment_id" in line or "HashJoin [amendment_id" in line][0]
    assert any("confirmed_at" in line for line in text) and not any("confirmed_at" in line for line in text[:above])
    assert not any("Exchange" in line and "confirmed_at" in text[n + 1] and "_date" not in text[n + 1] for n, line in enumerate(text[:-1]))


def test_the_loss_ratio_report_has_done_with_its_joins_side_by_side(spark):
    """Claims and collections are summed up one after the other, so that what the one has shuffled leaves the disk first:
    the result reads their sums, and no table of the size of claims or payments."""
    text = plan(spark, "loss_ratio_report")
    assert "/paid-" in text and "/earned-" in text
    assert not any(f"/{name}-" in text for name in ("premium", "payments", "claims")) and "lineitem" not in text and "events" not in text


def test_months_of_an_instalment_meet_in_one_shuffle(spark):
    text = plan(spark, "accrued_to_cutoff")
    assert sum("Exchange hashpartitioning(amendment_id" in line and "installment_number" in line for line in text.splitlines()) == 1
