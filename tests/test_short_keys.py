"""Key checks on keys that are shuffled as bytes."""

from pyspark.sql import functions as F

from tessera.functions.columns import short_key
from tessera.operators import quality as Q

HEX = "00ab" * 16
KEYS = [HEX, HEX.upper(), "1" + HEX[1:], HEX[:63], HEX + "0", "", "a", "\x00a", bytes.fromhex("41" * 32).decode(), "41" * 32, "4" * 31, "\x01" + "A" * 31, "\x00" + "4" * 31, bytes.fromhex(HEX)[1:].hex(), "\u00e9" * 15 + "x", "é" * 32, "g" * 64]


def test_short_keys_are_equal_where_the_keys_are(spark):
    df = spark.createDataFrame([(k,) for k in [*KEYS, None]], "k string").select("k", short_key("k").alias("b"))
    rows = df.collect()
    assert len({bytes(r.b) for r in rows if r.k is not None}) == len(KEYS) and [r.b for r in rows if r.k is None] == [None]
    assert {r.k: len(r.b) for r in rows if r.k in ("1" + HEX[1:], HEX, "a")} == {"1" + HEX[1:]: 32, HEX: 32, "a": 2}


def test_orphans_among_mixed_keys(spark):
    child = spark.createDataFrame([(k,) for k in [*KEYS, HEX, "x", "x", None]], "k string")
    parent = spark.createDataFrame([(k,) for k in [*KEYS[2:], HEX, HEX, None]], "p string")
    r = Q.fk_check(child, "k", parent, "p", "c", "p").first()
    assert r[:] == ("c.k", "p.p", len(KEYS) + 3, 3, 2)  # upper case and twice x
    assert Q.fk_check(child, "k", parent.limit(0), "p").first()[2:] == (len(KEYS) + 3,) * 2 + (len(KEYS) + 1,)
    assert Q.fk_check(spark.range(5).toDF("k"), "k", spark.range(3).toDF("p"), "p").first()[2:] == (5, 2, 2)  # other types as they are


def test_surrogate_keys_are_shuffled_as_bytes(spark):
    child = spark.range(2_000).select(F.sha2((F.col("id") % 1_500).cast("string"), 256).alias("k"))
    parent = spark.range(1_000).select(F.sha2(F.col("id").cast("string"), 256).alias("p"))
    report = Q.fk_check(child, "k", parent, "p")
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert report.first()[2:] == (2_000, 500, 500)
    assert "unhex" in plan


def test_lines_of_an_order_are_worked_out_once_for_their_keys_and_the_fact(spark):
    from tessera.plans.profiling import CONSTRAINT_REPORTS
    from tessera.plans.registry import _Both
    from tessera.plans.tables import RetailTables
    df = CONSTRAINT_REPORTS["dq_fk_violations"](_Both(RetailTables(spark, "/root/testdata/sf0.001")))
    plan = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    first = [i for i, line in enumerate(plan) if "Relation" in line and "l_orderkey" in line]
    filters = {plan[i - 1].strip(" :+-").split("#")[0] for i in first}
    assert first and all(f.startswith(("Filter isnotnull(concat(o, cast(l_orderkey", "Filter isnull(concat(o, cast(l_orderkey")) for f in filters), filters
