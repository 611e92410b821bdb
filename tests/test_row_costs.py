"""Steps that every row passes are long arithmetic in generated code, with the results of the plain rules."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from lossledger.functions import rules as R
from lossledger.operators.spines import month_grid
from lossledger.plans import loss_ratio as L


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "string"])
def test_local_dates_make_no_decimal_and_parse_no_zone(spark, kind):
    rng, zone = random.Random(4), ZoneInfo(R.LOCAL_ZONE)
    moments = [dt.datetime(1900, 1, 1) + dt.timedelta(microseconds=rng.randrange(150 * 365 * 86400 * 10**6)) for _ in range(300)]
    moments += [dt.datetime(1969, 12, 31, 23, 59, 59, 500000), dt.datetime(1970, 1, 1), dt.datetime(2022, 10, 30, 6, 59, 59), dt.datetime(2022, 10, 30, 7)]
    rows = spark.createDataFrame([(str(m),) for m in moments] + [(None,)], "s string").select("s", F.col("s").cast(kind).alias("a"))
    out = rows.select("s", F.col("a").cast("timestamp_ntz").alias("utc"), R.local_time(F.col("a")).alias("t"), R.local_date(F.col("a")).alias("d"))
    assert not any(word in _plan(out) for word in ("convert_timezone", "make_dt_interval", "decimal"))
    for r in out.collect():
        there = r.utc and r.utc.replace(tzinfo=dt.timezone.utc).astimezone(zone).replace(tzinfo=None)
        assert (r.t, r.d) == (there, there and there.date()), r


def test_earned_share_is_the_exact_ratio_rounded(spark):
    rng = random.Random(5)
    start = dt.date(2000, 1, 1)
    days = lambda n: start + dt.timedelta(rng.randrange(n))
    rows = [tuple(None if rng.random() < 0.05 else days(n) for n in (90, 900, 900, 900)) for _ in range(500)]
    df = spark.createDataFrame(rows, "s date, t date, e date, c date")
    got = df.select("*", L.earned_share(F.col("s"), F.col("t"), F.col("e"), F.col("c")).alias("x"))
    assert "decimal(38" not in _plan(got)  # no division of decimals
    for s, t, e, c, x in got.collect():
        upto = min((d for d in (e, c) if d), default=None)
        if t and upto and t <= upto:
            want = Decimal(1)
        elif (s and c and s > c) or not (s and t and upto) or t == s - dt.timedelta(1):
            want = Decimal(0)
        else:
            share = Decimal((upto - s).days + 1) / Decimal((t - s).days + 1)
            want = max(Decimal(0), share.quantize(Decimal("1e-10"), ROUND_HALF_UP))
        assert x == want, (s, t, e, c)


def test_accrual_values_months_in_generated_code(spark):
    D = dt.date
    paid = [
        (1, 1, 10, D(2024, 1, 5), D(2024, 1, 1), D(2024, 12, 31), "120.00"),
        (1, 1, 10, D(2024, 4, 5), D(2024, 1, 1), D(2024, 12, 31), "-30.00"),  # a second state of the same instalment
        (2, 1, 20, D(2024, 2, 5), D(2024, 2, 1), D(2024, 2, 20), "29.00"),  # settled when it is first seen
        (3, 1, 30, D(2024, 2, 5), D(2024, 5, 1), D(2024, 5, 30), "60.00"),  # paid before it starts
    ]
    rows = [(a, n, h, day, since, through, None, None, day, day, Decimal(x)) for a, n, h, day, since, through, x in paid]
    collections = spark.createDataFrame(
        rows,
        "amendment_id long, installment_number int, healthplan_id long, transaction_date date, installment_valid_since date, installment_valid_through date, "
        "amendment_cancelation_date date, cancelation_date date, amendment_subscription_date date, subscription_date date, installment_net_premium_before_discount decimal(28,6)",
    )
    classes = spark.createDataFrame([(10, "A"), (20, "A"), (30, "B")], "healthplan_id long, hp_class string")
    start, as_of = D(2024, 2, 1), D(2024, 8, 15)
    out = L.accrued_to_cutoff(collections, classes, start, as_of)
    assert "lambda" not in _plan(out)
    got = {(r[0], r[1]): r[2] for r in out.collect()}
    days = [r[0] for r in month_grid(classes.select("hp_class").distinct(), start, as_of).select("date_date").distinct().collect()]
    assert len(got) == 2 * len(days)
    for c in days:
        want = {"A": Decimal(0), "B": Decimal(0)}
        term = Decimal(min(c, as_of).timetuple().tm_yday)
        share = (term / 366).quantize(Decimal("1e-10"), ROUND_HALF_UP)
        want["A"] += (sum(Decimal(p[6]) for p in paid[:2] if p[3] <= c) * share).quantize(Decimal("1e-6"), ROUND_HALF_UP)
        want["A"] += Decimal(29) if c >= D(2024, 2, 29) else 0
        want["B"] += Decimal(60) if c >= D(2024, 5, 31) else 0
        for cls, total in want.items():
            assert got[c, cls] == total.quantize(Decimal("0.01"), ROUND_HALF_UP), (c, cls)


@pytest.mark.parametrize("name", ["claims_report", "loss_ratio_report"])
def test_reports_write_only_the_premium_columns_they_read(spark, monkeypatch, name):
    import queries.premium as Q
    from lossledger.plans.claims import PLAN_COLUMNS
    from queries.catalogue import SPARK

    class Written(Exception):
        pass

    def written(df, label):
        raise Written(df.columns)

    known = ["healthplan_id", "amendment_id", *PLAN_COLUMNS]
    accrued = ["net_premium", "net_premium_before_discount", "amendment_subscription_date", "subscription_date", "amendment_cancelation_date", "cancelation_date"]
    unread = ["insured_amount", "cancel_reason", "discount", "surcharge", "subtotal", "total", "reinsurance_participates"]
    whole = spark.createDataFrame([], ", ".join(f"{c} string" for c in (*known, *accrued, *unread)))
    monkeypatch.setattr(Q.P, "premium_report", lambda t, as_of: whole)
    monkeypatch.setattr(Q, "materialise", written)
    with pytest.raises(Written) as found:
        SPARK[name](spark, "nowhere")
    assert sorted(found.value.args[0]) == sorted(known if name == "claims_report" else known + accrued)
