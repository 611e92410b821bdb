"""Rules that engines read differently, one test each."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from lossledger.functions import rules as R
from lossledger.operators.aggregates import distinct_array, distinct_lengths, latest_by_key, repeated_text
from lossledger.models.embed import join_embeddings


def one(spark, expr, **values):
    df = spark.range(1)
    for name, (value, kind) in values.items():
        df = df.withColumn(name, F.lit(value).cast(kind))
    return df.select(expr.alias("x")).first()["x"]


def test_least_and_greatest_null_policy(spark):
    cols = [F.col("a"), F.col("b")]
    v = {"a": (5, "int"), "b": (None, "int")}
    assert one(spark, R.least_of(*cols), **v) == 5
    assert one(spark, R.greatest_of(*cols), **v) == 5
    assert one(spark, R.least_of(*cols, null_policy="propagate"), **v) is None
    assert one(spark, R.greatest_of(*cols, null_policy="propagate"), **v) is None


def test_money_rounds_half_up_on_decimals(spark):
    assert one(spark, R.to_money(F.col("a")), a=(1.005, "double")) == Decimal("1.01")
    assert one(spark, R.money(F.col("a")), a=(12345, "bigint")) == Decimal("123.45")


def test_year_and_month_count_boundaries(spark):
    v = {"a": ("2001-01-01", "date"), "b": ("2000-12-31", "date")}
    assert one(spark, R.date_diff(F.col("a"), F.col("b"), "YEAR"), **v) == 1
    assert one(spark, R.date_diff(F.col("a"), F.col("b"), "MONTH"), **v) == 1
    assert one(spark, R.date_diff(F.col("a"), F.col("b"), "DAY"), **v) == 1


def test_json_text_has_no_quotes(spark):
    assert one(spark, R.json_text(F.col("j"), "k"), j=('{"k": "R1"}', "string")) == "R1"
    assert one(spark, R.json_text(F.col("j"), "z"), j=('{"k": "R1"}', "string")) is None


def test_division_by_zero_is_null(spark):
    assert one(spark, R.safe_ratio(F.col("a"), F.lit(0)), a=(5, "int")) is None
    assert one(spark, R.round_ratio(F.col("a"), F.lit(0), 2), a=(5, "int")) is None
    assert one(spark, R.round_ratio(F.col("a"), F.lit(800), 2), a=(1, "int")) == Decimal("0.00")
    assert one(spark, R.round_ratio(F.col("a"), F.lit(200), 2), a=(1, "int")) == Decimal("0.01")


def test_all_null_group_has_no_array(spark):
    df = spark.createDataFrame([("a", None), ("b", "x"), ("b", None), ("b", "x")], "k string, v string")
    assert {r.k: r.s for r in distinct_array(df, ["k"], "v", "s").collect()} == {"a": None, "b": ["x"]}
    assert {r.k: r.s for r in repeated_text(df, ["k"], "v", "s").collect()} == {"a": None, "b": "x, x"}
    assert {r.k: r.n_values for r in distinct_lengths(df, ["k"], ["v"]).collect()} == {"a": None, "b": 1}


def test_not_of_null_drops_the_row(spark):
    df = spark.createDataFrame([("c", None), ("c", "own"), ("d", None)], "t string, p string")
    kept = df.where(~((F.col("t") == "c") & (F.col("p") == "own"))).collect()
    assert [(r.t, r.p) for r in kept] == [("d", None)]


def test_title_text_breaks_at_punctuation(spark):
    assert one(spark, R.title_text(F.col("s")), s=("MATERNITY add-on x/y_z", "string")) == "Maternity Add-On X/Y_Z"


def test_null_keys_never_join(spark):
    a = spark.createDataFrame([(1, None), (1, 2)], "m int, c int")
    b = spark.createDataFrame([(1, None, 9), (1, 2, 8)], "m int, c int, v int")
    assert sorted(r.v or 0 for r in join_embeddings(a, b, ["m", "c"]).collect()) == [0, 8]


def test_number_text_drops_trailing_zero(spark):
    assert one(spark, R.number_text(F.col("a")), a=(3.0, "double")) == "3"
    assert one(spark, R.number_text(F.col("a")), a=(3.5, "double")) == "3.5"


def test_latest_row_keeps_its_nulls_and_stays_whole(spark):
    df = spark.createDataFrame([(1, 1, 10, "a"), (1, 2, 20, None), (1, 2, 15, "b")], "k int, ts int, id int, v string")
    row = latest_by_key(df, ["k"], [F.col("ts"), F.col("id")], ["id", "v"]).first()
    assert (row.id, row.v) == (20, None)


def test_whole_minutes(spark):
    v = {"a": ("2024-01-01 00:00:50", "timestamp_ntz"), "b": ("2024-01-01 00:02:10", "timestamp_ntz")}
    assert one(spark, R.minutes_between(F.col("a"), F.col("b")), **v) == 1


def test_local_date_steps_back_at_night_and_ignores_the_session_zone(spark):
    v = {"a": ("2024-02-01 03:00:00", "timestamp_ntz")}
    assert one(spark, R.local_date(F.col("a")), **v) == dt.date(2024, 1, 31)
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert one(spark, R.local_date(F.col("a")), **v) == dt.date(2024, 1, 31)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_local_date_of_an_instant_ignores_the_session_zone(spark):
    for zone in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
        try:
            spark.conf.set("spark.sql.session.timeZone", zone)
            instants = spark.createDataFrame([(1_706_756_400_000_000,), (1_706_770_800_500_000,), (-1,)], "us bigint").select(F.timestamp_micros("us").alias("a"))
            got = [r[0] for r in instants.select(R.local_date(F.col("a")).cast("string")).collect()]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == ["2024-01-31", "2024-02-01", "1969-12-31"], zone


def test_trunc_cuts_towards_zero(spark):
    assert one(spark, R.trunc_digits(F.col("a"), 4), a=("-0.12349", "decimal(10,5)")) == Decimal("-0.1234")


def test_size_bands(spark):
    rows = spark.createDataFrame([(0,), (9,), (10,), (49,), (50,), (None,)], "n int").select(R.size_band(F.col("n")).alias("b")).collect()
    assert [r.b for r in rows] == ["1 - 9", "1 - 9", "10 - 19", "20 - 49", "50 or more", "50 or more"]


def test_sentinel(spark):
    df = spark.createDataFrame([("None", ""), ("x", "None"), ("", "y")], "a string, b string")
    rows = R.sentinel_to_null(df, ["a", "b"], also_empty=["b"]).collect()
    assert [(r.a, r.b) for r in rows] == [(None, None), ("x", None), ("", "y")]
