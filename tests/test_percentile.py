import random

import pytest
from pyspark.sql import functions as F

from tessera.operators.percentile import DIGITS, exact_percentile, ordered_bits


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 == 0 else f"g{rng.randint(0, 30)}"
        v = rng.choice([round(rng.uniform(-50, 500), 2), float(rng.randint(0, 20)), None])
        rows.append((g, v))
    rows.append(("single", 7.5))
    rows.append(("nulls", None))
    rows += [(None, float(i)) for i in range(9)]
    return spark.createDataFrame(rows, "g string, v double")


@pytest.mark.parametrize("p", [0.0, 0.5, 0.99, 1.0, 0.37])
def test_grouped_matches_builtin_percentile(spark, data, p):
    want = {r.g: r.x for r in data.groupBy("g").agg(F.percentile("v", p).alias("x")).collect()}
    got = {r.g: r.x for r in exact_percentile(data, "v", p, ["g"], "x").collect()}
    assert set(got) == {g for g, x in want.items() if x is not None} and None in got
    for g, x in got.items():
        assert x == want[g], (g, x, want[g])


def test_global_and_empty(spark, data):
    want = data.agg(F.percentile("v", 0.5)).first()[0]
    assert exact_percentile(data, "v", 0.5).first()[0] == want
    none = exact_percentile(data.filter("false"), "v", 0.5).collect()
    assert len(none) == 1 and none[0][0] is None


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_does_not_depend_on_exchange_reuse(spark, reuse):
    old = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        df = spark.range(400_000, numPartitions=6).select(
            F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise("other").alias("g"),
            (F.col("id") * 7919 % 400_000).cast("double").alias("v"))
        for p in (0.5, 0.99):
            assert exact_percentile(df, "v", p).first()[0] == df.agg(F.percentile("v", p)).first()[0]
            want = {r.g: r.x for r in df.groupBy("g").agg(F.percentile("v", p).alias("x")).collect()}
            assert {r.g: r.x for r in exact_percentile(df, "v", p, ["g"], "x").collect()} == want and None in want
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)


def test_extreme_values(spark):
    inf = float("inf")
    for vals in ([inf, -inf, 1.0, 2.0], [float("nan"), 1.0, 3.0], [1e308, -1e308, 0.0], [5.0, 5.0], [-inf, -inf, inf]):
        df = spark.createDataFrame([(x,) for x in vals], "v double")
        for p in (0.0, 0.4, 1.0):
            assert repr(exact_percentile(df, "v", p).first()[0]) == repr(df.agg(F.percentile("v", p)).first()[0]), (vals, p)


def test_ordered_bits_order_as_the_values_do(spark):
    vals = sorted([0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1e300, -1e300, 1.5, 1.25, -1.25, float("inf"), float("-inf"), 3.0])
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*vals, float("nan")])], "i int, v double")
    rows = sorted((r.u % (1 << 64), r.i) for r in df.select("i", ordered_bits(F.col("v")).alias("u")).collect())
    assert [i for _, i in rows] == list(range(len(vals) + 1))


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_a_far_outlier_changes_nothing(spark, reuse):
    old = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        near = spark.range(200_000, numPartitions=5).select((F.col("id") * 7919 % 200_000 / 1000.0).alias("v"))
        df = near.unionByName(spark.createDataFrame([(1e300,), (-1e300,)], "v double"))
        # what the second round orders is a small part of the values, though nearly all lie in 200 of 2e300
        top = near.select(F.shiftrightunsigned(ordered_bits(F.col("v")), 64 - DIGITS[0]).alias("d")).groupBy("d").count().agg(F.max("count")).first()[0]
        assert top < 200_000 / 100
        for p in (0.0, 0.5, 0.99, 1.0):
            assert exact_percentile(df, "v", p).first()[0] == df.agg(F.percentile("v", p)).first()[0]
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)
