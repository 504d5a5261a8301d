from decimal import Decimal

from pyspark.sql import functions as F

from tessera.functions.columns import (avg_money, date_key, exact_ratio, surrogate_key, text)
from tessera.operators.conform import TableSpec, conform, dedupe, majority


def test_text_blank_to_null_keeps_inner_breaks(spark):
    df = spark.createDataFrame([("a",), ("",), ("   ",), (None,), ("  x\ny  ",)], "v string")
    got = [r[0] for r in df.select(text("v")).collect()]
    assert got == ["a", None, None, None, "x\ny"]


def test_surrogate_key_is_deterministic_and_null_parts_vanish(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    k = [r[0] for r in df.select(surrogate_key("x", "y")).collect()]
    only_a = spark.range(1).select(surrogate_key(F.lit("a"))).first()[0]
    assert k[0] == only_a  # ('a', NULL) hashes like ('a')
    assert k[1] != only_a and len(k[1]) == 64


def test_date_key(spark, ts):
    df = spark.createDataFrame([(ts("2001-02-03 23:59:00"),)], "t timestamp")
    assert df.select(date_key("t")).first()[0] == 20010203


def test_exact_ratio_rounds_half_up_without_float_error(spark):
    # 100 * 201 / 4000 = 5.025 exactly: HALF_UP gives 5.03 (a double would hold 5.02499..)
    df = spark.createDataFrame([(201, 4000), (-1, 8), (1, 0)], "a long, b long")
    got = [r[0] for r in df.select(exact_ratio("a", "b", 2, 100)).collect()]
    assert got == [5.03, -12.5, None]


def test_avg_money_exact(spark):
    df = spark.createDataFrame([(Decimal("5.00"),), (Decimal("5.01"),)], "v decimal(12,2)")
    assert df.agg(avg_money("v")).first()[0] == Decimal("5.01")  # 5.005 -> 5.01


def test_dedupe_deterministic_nulls_last_and_null_key_group(spark):
    df = spark.createDataFrame([("k", None), ("k", "b"), ("k", "a"), (None, "z"), (None, "y")],
                               "id string, v string")
    got = sorted(dedupe(df, ["id"]).collect(), key=lambda r: str(r.id))
    assert [(r.id, r.v) for r in got] == [(None, "y"), ("k", "a")]


def test_majority_resolves_pairs_with_alphabetical_ties(spark):
    df = spark.createDataFrame([("1", "b", "X"), ("1", "a", "Y"), ("1", "b", "X"), ("2", "c", "Z"), ("2", "a", "Z")],
                               "k string, city string, state string")
    got = {r.k: (r.city, r.state) for r in majority(df, "k", ["city", "state"]).collect()}
    assert got == {"1": ("b", "X"), "2": ("a", "Z")}


def test_conform_spec(spark, ts):
    df = spark.createDataFrame([("1", " Shipped ", "2001-01-01 10:00:00", ts("2001-08-02 00:00:00"))],
                               "id string, st string, t string, _loaded_at timestamp")
    spec = TableSpec(name="x", source="bronze.x", keys=["id"],
                     columns={"id": F.col("id"), "status": F.lower(F.trim("st")), "at": F.col("t").cast("timestamp")})
    out = conform(df, spec)
    assert out.columns == ["id", "status", "at", "_source", "_loaded_at"]
    r = out.first()
    assert r.status == "shipped" and r.at == ts("2001-01-01 10:00:00") and r._source == "bronze.x"
