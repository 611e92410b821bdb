"""Hand-built insurance tables: cancellation, head counts, payments, accrual and loss ratio."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lossledger.operators.spines import month_grid
from lossledger.plans import claims as C
from lossledger.plans import loss_ratio as L
from lossledger.plans import membership as M
from lossledger.plans import wide as W
from lossledger.plans.premium import exposure_days

D = dt.date.fromisoformat


def T(text):
    return dt.datetime.fromisoformat(text)


def test_cancellation_dates(spark):
    plans = spark.createDataFrame(
        [
            (1, T("2021-01-01"), None, None),  # never cancelled
            (2, T("2021-01-01"), T("2020-06-01"), None),  # cancelled on the plan itself
            (3, T("2021-01-01"), None, None),  # cancelled by amendment
            (4, T("2021-01-01"), T("2020-05-01"), None),  # cancelling amendment not approved: no base counts
            (5, T("2020-03-01"), T("2020-09-01"), None),  # cancelled after its end
            (6, T("2021-01-01"), T("2020-02-01"), T("2020-01-01")),  # deleted plan
            (7, T("2021-01-01"), T("2020-08-01"), None),  # effective cancellation without a date takes the plan's own
        ],
        "id int, valid_through timestamp_ntz, cancelled_at timestamp_ntz, deleted timestamp_ntz",
    )
    am = [(10 * i, i, None, "SA", "AP", T("2020-01-01"), None, None) for i in range(1, 8)]
    am += [(31, 3, 30, "CN", "AP", T("2020-04-01"), None, None), (32, 3, 30, "DB", "AP", T("2020-03-15"), None, None)]
    am += [(41, 4, 40, "CN", "RJ", T("2020-04-01"), None, None), (71, 7, 70, "FR", "AP", None, None, None)]
    amendments = spark.createDataFrame(
        am,
        "id int, health_plan_id int, cancelled_amendment_id int, amendment_category string, review_result string, signed_at timestamp_ntz, deleted timestamp_ntz, amendment_extras string",
    )
    got = {r.healthplan_id: r.cancelled_at for r in M.cancellation_dates(plans, amendments).collect()}
    assert got == {1: None, 2: T("2020-06-01"), 3: T("2020-03-15"), 5: T("2020-03-01"), 7: T("2020-08-01")}


def test_exposure_policies(spark):
    df = spark.createDataFrame([(D("2024-01-01"), D("2024-12-31"), None)], "s date, t date, c date")
    days, share = exposure_days(F.col("s"), F.col("t"), F.col("c"), F.lit(D("2024-01-31")))
    strict, _ = exposure_days(F.col("s"), F.col("t"), F.col("c"), F.lit(D("2024-01-31")), null_policy="propagate")
    row = df.select(days.alias("d"), share.alias("p"), strict.alias("n")).first()
    assert (row.d, row.n) == (31, None) and abs(row.p - 31 / 366) < 1e-12


def test_peak_concurrent_against_join_form(spark):
    rng = random.Random(11)
    day0 = D("2020-01-01")
    data = []
    for _ in range(900):
        g = "big" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None])
        s = day0 + dt.timedelta(rng.randrange(200))
        e = rng.choice([None, s + dt.timedelta(rng.randrange(-3, 60))])
        data.append((g, rng.choice([None, *range(40)]), s, e))
    data.append(("empty", None, day0, None))
    df = spark.createDataFrame(data, "g string, m int, s date, e date")
    got = {r.g: r.n for r in M.peak_concurrent(df, "g", "m", "s", "e", "n").collect()}
    want = {}
    for g in {r[0] for r in data}:
        rows = [r for r in data if r[0] == g and g is not None]
        days = {x for r in rows for x in (r[2], r[3]) if x}
        want[g] = max([len({m for _, m, s, e in rows if m is not None and s <= d and (e is None or e > d)}) for d in days] or [0])
    assert got == want


def test_burst_keeps_the_last_and_61_minutes_apart(spark):
    rows = [(1, 7, T("2024-01-01 10:00")), (2, 7, T("2024-01-01 11:00")), (3, 7, T("2024-01-01 12:01")), (4, 8, T("2024-01-01 23:50")), (5, 8, T("2024-01-02 00:10"))]
    df = spark.createDataFrame(rows, "id int, m int, ts timestamp_ntz")
    assert sorted(r.id for r in C.last_of_burst(df, ["m"], "ts", "id").collect()) == [2, 3, 5]


def test_payment_month_days_10_and_11(spark):
    df = spark.createDataFrame([(D("2024-03-10"),), (D("2024-03-11"),), (D("2024-01-05"),)], "d date")
    assert [r.m for r in df.select(C.payment_month(F.col("d")).alias("m")).collect()] == [D("2024-02-01"), D("2024-03-01"), D("2023-12-01")]


@pytest.mark.parametrize("flow, kind, want", [("OUT", "PY", 5), ("OUT", "RF", -5), ("IN", "DB", -5), ("IN", "FW", 5)])
def test_claim_sign(spark, flow, kind, want):
    df = spark.createDataFrame([(500, flow, kind)], "c bigint, f string, k string")
    assert df.select(C.signed_claim_amount(F.col("c"), F.col("f"), F.col("k")).alias("x")).first().x == want


def test_carry_forward_of_unit_cost(spark):
    counts = spark.createDataFrame([(D("2024-01-01"), 1, 4), (D("2024-02-01"), 1, 2), (D("2024-03-01"), 1, 5), (D("2024-03-01"), 2, 3)], "month date, doctor_id int, count_service bigint")
    costs = spark.createDataFrame(
        [(D("2024-01-01"), 1, Decimal("100.00")), (D("2024-03-01"), 1, Decimal("50.00")), (D("2024-03-01"), 2, Decimal("30.00"))], "month date, doctor_id int, subtotal decimal(18,2)"
    )

    def units(own):
        return {(r.month.month, r.doctor_id): r.unit_cost for r in C.unit_cost_carry_forward(counts, costs, D("2024-03-20"), own).collect()}

    assert units(False) == {(1, 1): 25, (2, 1): 25, (3, 1): None, (3, 2): None}
    assert units(True) == {(1, 1): 25, (2, 1): 25, (3, 1): 10, (3, 2): 10}


def test_services_whose_payouts_are_all_deleted_have_no_price(spark):
    t = {
        "coverage_ruling": spark.createDataFrame([(10, 1), (20, 2), (21, 2), (30, 3), (31, 3), (40, 4)], "id int, service_id int"),
        "coverage_payout": spark.createDataFrame(
            [(10, 500, 0, T("2024-01-01"), None), (20, 700, 0, T("2024-01-02"), T("2024-02-01")), (21, 800, 0, T("2024-01-02"), T("2024-02-01")), (30, 900, 0, T("2024-01-03"), T("2024-02-01"))],
            "service_coverage_ruling_id int, covered_subtotal_cents bigint, coinsured_subtotal_cents bigint, created_at timestamp_ntz, deleted timestamp_ntz",
        ),
    }
    services = spark.createDataFrame([(i,) for i in range(1, 6)], "service_id int")
    # 2 is out: all its payouts are deleted; 3 stays, its second ruling has no payout; 4 and 5 never had one
    assert sorted(r[0] for r in C.without_deleted_payouts(services, t).collect()) == [1, 3, 4, 5]
    prices = {r["service_id"]: r["price"] for r in C.video_reinsurance_price(services, t).collect()}
    assert prices == {i: Decimal("5.00") for i in (1, 3, 4, 5)}


def test_shares_of_a_months_cost_add_up(spark):
    services = spark.createDataFrame([(i, D("2024-01-05"), "x") for i in range(7)], "service_id int, service_created_at date, scheme string")
    units = spark.createDataFrame([(D("2024-01-01"), "x", Decimal(100) / 7)], "month date, scheme string, unit_cost decimal(38,16)")
    total = C.allocate_unit_cost(services, units, ["scheme"]).agg(F.sum("subtotal").alias("s")).first()["s"]
    assert abs(total - 100) < Decimal("0.00001")


def test_a_service_takes_its_newest_ruling(spark):
    modes = spark.createDataFrame([(1, 5, T("2024-01-01"), "a"), (2, 5, T("2024-03-01"), "b"), (3, 5, T("2024-03-01"), "c"), (4, 6, None, "d")], "id int, service_id int, updated_at timestamp_ntz, payout_mode string")
    assert sorted((r["service_id"], r["payout_mode"]) for r in W.newest_ruling(modes).collect()) == [(5, "c"), (6, "d")]


def test_open_month_takes_last_months_unit_cost(spark):
    counts = spark.createDataFrame([(D("2024-02-01"), "h", 4), (D("2024-03-01"), "h", 10)], "month date, s string, count_service bigint")
    costs = spark.createDataFrame([(D("2024-02-01"), "h", Decimal("100.00"))], "month date, s string, subtotal decimal(18,2)")
    got = {r.month.month: (r.unit_cost, r.monthly_total_cost) for r in C.unit_cost_monthly(counts, costs, ["s"], D("2024-03-20")).collect()}
    assert got == {2: (25, 100), 3: (25, 250)}


def test_payroll_month_equals_days(spark):
    people = spark.createDataFrame(
        [(1, D("2024-01-10"), D("2024-02-05"), Decimal("3100.00")), (2, D("2023-12-01"), None, Decimal("290.00"))], "doctor_id int, start_date date, end_date date, salary decimal(18,2)"
    )
    got = {r.month.month: r.subtotal for r in C.payroll_by_month(people, D("2024-01-01"), D("2024-02-29")).collect()}
    assert got == {1: Decimal("2490.00"), 2: Decimal("824.48")}


def test_left_joins_keep_rows_and_sums(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (None, 5)], "k int, amount int")
    dim = spark.createDataFrame([(1, "x")], "id int, name string")
    from lossledger.operators.joins import join_role

    audit = W.join_audit([("before", fact), ("after", join_role(fact, dim, "k", "id", {"name": "n"}))], "amount").collect()
    assert {(r.n_rows, r.total) for r in audit} == {(3, 35)}
    watched = W.JoinAudit("amount")
    rows = watched.watch(join_role(watched.watch(fact, "before"), dim.union(dim), "k", "id", {"name": "n"}), "after")
    assert rows.count() == 4
    assert [tuple(r) for r in watched.report(spark).collect()] == [("before", 3, 35), ("after", 4, 45)]


def test_rows_without_a_key_are_spread(spark):
    from lossledger.operators.joins import join_role

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fact = spark.range(4000).selectExpr("id", "id % 3 AS tag", "id % 50 AS k")
        dim = spark.range(50).selectExpr("id", "concat('n', id) AS name")
        found = join_role(fact, dim, "k", "id", {"name": "n"}, when=F.col("tag") == 0)
        assert found.where("(tag = 0 AND n = concat('n', k)) OR (tag > 0 AND n IS NULL)").count() == 4000
        sizes = [r[1] for r in found.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.count_if(F.col("tag") > 0)).collect()]
        assert len(sizes) > 1 and max(sizes) < 2 * sum(sizes) / len(sizes)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


START, AS_OF = D("2024-01-01"), D("2024-08-15")


def _cutoffs():
    out, d = [], START
    while d <= AS_OF.replace(day=1):
        out.append(d - dt.timedelta(1))
        d = (d + dt.timedelta(32)).replace(day=1)
    return out


def _share(s, t, ended, c):
    upto = min(ended, c)
    if t <= upto:
        return 1.0
    if s > c:
        return 0.0
    return max(0.0, ((upto - s).days + 1) / ((t - s).days + 1))


@pytest.mark.parametrize("policy", ["skip", "propagate"])
def test_accrual_against_brute_force(spark, policy):
    rng = random.Random(17)
    data = []
    for a in range(60):
        s = D("2023-11-15") + dt.timedelta(rng.randrange(250))
        t = s + dt.timedelta(rng.choice([0, 29, 90, 200]))
        signed = s - dt.timedelta(rng.randrange(30))
        ca, cp = (rng.choice([None, s + dt.timedelta(rng.randrange(-5, 150))]) for _ in range(2))
        for _ in range(rng.randrange(1, 4)):
            paid = rng.choice([None, s + dt.timedelta(rng.randrange(-20, 120))])
            data.append((a % 23, a, 1, T(f"{s} 00:00"), T(f"{t} 00:00"), ca, cp, Decimal(rng.randrange(-5000, 20000)) / 100, paid, signed, signed))
    rows = spark.createDataFrame(
        data,
        "healthplan_id int, amendment_id int, installment_number int, installment_valid_since timestamp_ntz, installment_valid_through timestamp_ntz, amendment_cancelation_date date,"
        " cancelation_date date, installment_net_premium_before_discount decimal(28,6), transaction_date date, amendment_subscription_date date, subscription_date date",
    )
    classes = spark.createDataFrame([(i, "B2C" if i % 2 else "B2B (1 - 9)") for i in range(20)], "healthplan_id int, hp_class string")
    got = {(r.date_date, r.hp_class): r.accrued_and_collected_premium for r in L.accrued_to_cutoff(rows, classes, START, AS_OF, policy).collect()}

    def in_class(r, cls):
        return r[0] < 20 and ("B2C" if r[0] % 2 else "B2B (1 - 9)") == cls

    started = min(c for c in _cutoffs() for r in data if r[0] < 20 and r[8] and max(r[8], r[9], r[10]) <= c)
    for c in _cutoffs():
        for cls in ("B2C", "B2B (1 - 9)"):
            total = 0.0
            for a in {r[1] for r in data if in_class(r, cls)}:
                seen = [r for r in data if r[1] == a and r[8] and max(r[8], r[9], r[10]) <= c]
                if not seen:
                    continue
                s, t, ca, cp = seen[0][3].date(), seen[0][4].date(), seen[0][5], seen[0][6]
                if policy == "propagate" and (ca is None or cp is None):
                    continue
                ended = min(x for x in (ca, cp, t, AS_OF) if x)
                total += sum(float(r[7]) for r in seen) * _share(s, t, ended, c)
            value = got[(c, cls)]
            if c < started:
                assert value is None
            else:
                assert abs(float(value) - total) < 0.011, (c, cls)
    assert len(got) == 2 * len(_cutoffs())


def test_earned_share_stays_in_bounds(spark):
    rng = random.Random(2)
    day = [D("2024-01-01") + dt.timedelta(rng.randrange(100)) for _ in range(400)]
    rows = [(day[i], day[i] + dt.timedelta(rng.randrange(60)), rng.choice(day), rng.choice(day)) for i in range(400)]
    df = spark.createDataFrame(rows, "s date, t date, e date, c date")
    share = L.earned_share(F.col("s"), F.col("t"), F.least("e", "t"), F.col("c"))
    low, high = df.agg(F.min(share), F.max(share)).first()
    assert 0 <= low and high <= 1


def test_levels_sum_to_the_overall_and_trailing_ratios(spark):
    classes = spark.createDataFrame([("B2C",), ("B2B (1 - 9)",), ("B2B (20 - 49)",)], "hp_class string")
    grid = month_grid(classes, START, AS_OF).withColumn("ss_class", F.lit("All services"))
    n = F.month("date_date")
    finest = grid.withColumn("service_payments", (n * 10).cast("decimal(18,2)")).withColumn("accrued_and_collected_premium", F.when(n > 2, n * 20).otherwise(0).cast("decimal(18,2)"))
    from lossledger.operators.aggregates import rollup_levels

    levels = rollup_levels(finest, L.class_levels(), "hp_class", ["date_date", "ss_class"], ["service_payments", "accrued_and_collected_premium"]).cache()
    sums = levels.groupBy("date_date", "granularity_level").agg(F.sum("service_payments").alias("s")).groupBy("date_date").agg(F.countDistinct("s").alias("n"))
    assert [r.n for r in sums.collect()] == [1] * len(_cutoffs())
    out = L.with_trailing_ratios(levels, ["granularity_level", "hp_class", "ss_class"], "date_date", "service_payments", "accrued_and_collected_premium")
    rows = {r.date_date: r for r in out.where("hp_class = 'B2C' and granularity_level = 3").collect()}
    assert rows[D("2024-02-29")].mlr_running_total is None  # zero premium
    assert rows[D("2024-04-30")].mlr_running_total == Decimal("0.5")
    assert rows[D("2024-04-30")].mlr_last_1_months == Decimal("0.5")
    assert rows[D("2024-03-31")].mlr_last_3_months == Decimal("0.5")  # (30 - 120) / (60 - 240)
