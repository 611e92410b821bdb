"""Split windows equal plain windows, whatever the buckets, with a hot key and NULL keys."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lossledger.operators import ordered as O
from lossledger.operators.joins import breakpoints, fill_from_breakpoints


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.4 else rng.choice([None, *[f"k{j}" for j in range(60)]])
        data.append((i, key, rng.randrange(5000), rng.choice([None, rng.randrange(100)])))
    return spark.createDataFrame(data, "id int, k string, t int, v int").cache()


def both(plain, split, columns):
    assert sorted(map(repr, plain.select(*columns).collect())) == sorted(map(repr, split.select(*columns).collect()))


@pytest.mark.parametrize("width", [1, 37, 10**6])
@pytest.mark.parametrize("keys", [["k"], []])
def test_neighbours(rows, keys, width):
    w = Window.partitionBy(*keys).orderBy("t", "id")
    plain = rows.withColumn("p", F.lag("v").over(w)).withColumn("n", F.lead("v").over(w))
    split = O.with_neighbours(rows, keys, ["t", "id"], "v", O.id_block(F.col("t"), width), prev="p", next="n")
    both(plain, split, ["id", "p", "n"])


@pytest.mark.parametrize("width", [1, 37, 10**6])
def test_running_sum_row_number_and_last_known(rows, width):
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    bucket = O.id_block(F.col("t"), width)
    plain = rows.withColumn("s", F.sum("id").over(w)).withColumn("l", F.last("v", ignorenulls=True).over(w))
    both(plain, O.with_running_sum(rows, ["k"], ["t", "id"], "id", bucket, "s"), ["id", "s"])
    both(plain, O.with_last_known(rows, ["k"], ["t", "id"], "v", bucket, "l"), ["id", "l"])
    number = rows.withColumn("n", F.row_number().over(Window.orderBy("t", "id")).cast("bigint"))
    both(number, O.with_row_number(rows, [], ["t", "id"], bucket, "n"), ["id", "n"])


def test_key_aggregate_with_hot_and_null_keys(rows):
    w = Window.partitionBy("k")
    plain = rows.withColumn("m", F.max("t").over(w)).withColumn("c", F.count("*").over(w))
    split = O.with_key_aggregate(rows, ["k"], {"m": F.max("t"), "c": F.count("*")})
    both(plain, split, ["id", "m", "c"])


def test_split_points_follow_the_order(spark):
    df = spark.createDataFrame([(f"name{i:05d}",) for i in range(2000)], "v string")
    points = O.split_points(df, "v", 8)
    assert points == sorted(points) and 1 <= len(points) <= 7
    sizes = df.groupBy(O.range_bucket(F.col("v"), points).alias("b")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("b").collect()
    assert all(a.hi < b.lo for a, b in zip(sizes, sizes[1:])) and max(s.n for s in sizes) < 1000


@pytest.mark.parametrize("width", [3, 10**6])
def test_breakpoints_against_brute_force(spark, width):
    rng = random.Random(5)
    prices = {i: rng.choice([None, 10 + i // 40, 10 + i // 40]) for i in rng.sample(range(2, 400), 150)}
    df = spark.createDataFrame(list(prices.items()), "id bigint, price int")
    first = {}
    for i in sorted(prices):
        if prices[i] is not None:
            first.setdefault(prices[i], i)
    starts = sorted((i, p) for p, i in first.items())
    got = {r.price: (r.first_id, r.last_id) for r in breakpoints(df, "id", "price", width).collect()}
    want = {}
    for n, (i, p) in enumerate(starts):
        want[p] = (1 if n == 0 else i, starts[n + 1][0] - 1 if n + 1 < len(starts) else max(prices))
    assert got == want
    filled = {r.id: r.f for r in fill_from_breakpoints(df, "id", "price", "f", width).collect()}
    assert filled == {i: next(p for p, (a, b) in want.items() if a <= i <= b) for i in prices}


def test_a_hot_key_stays_spread_when_its_aggregate_is_joined_back(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(8000).selectExpr("id", "if(id % 2 = 0, -1, id) AS k")
        found = O.with_key_aggregate(df, ["k"], {"n": F.count("*")})
        assert found.where("n = if(k = -1, 4000, 1)").count() == 8000
        sizes = [r[1] for r in found.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.count_if(F.col("k") == -1)).collect()]
        assert len(sizes) > 1 and max(sizes) < 2 * sum(sizes) / len(sizes)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
