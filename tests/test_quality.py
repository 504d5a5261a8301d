import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.operators import quality as Q
from tessera.sources.schemas import SCHEMAS


def test_one_violation_per_check_is_counted(spark):
    df = spark.createDataFrame([
        ("o1", 1, "p", "s", None, D("1.00"), D("1.00")),
        ("o1", 0, "p", "s", None, D("1.00"), D("1.00")),      # sequence < 1
        ("o2", 1, "p", "s", None, D("-1.00"), D("1.00")),     # negative price
        ("o3", 1, "p", "s", None, None, D("1.00")),           # NULL price: CHECK passes, NOT NULL fails
    ], "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date timestamp, "
       "price decimal(10,2), freight_value decimal(10,2)").withColumn("_source", F.lit("x")) \
        .withColumn("_loaded_at", F.current_timestamp())
    got = {r.rule: r.violations for r in Q.violations(df, "order_items", SCHEMAS["order_items"]).collect()}
    assert got["order_items_sequence_positive"] == 1
    assert got["order_items_amounts_non_negative"] == 1
    assert got["price_not_null"] == 1 and got["order_id_not_null"] == 0


def test_enforce_fails_the_pass_and_passes_clean_rows(spark):
    bad = spark.createDataFrame([("r1", 6)], "review_id string, review_score int")
    with pytest.raises(PySparkException):
        Q.enforce(bad, "reviews").collect()
    good = spark.createDataFrame([("r1", 5)], "review_id string, review_score int")
    assert Q.enforce(good, "reviews").collect()[0].review_score == 5


def test_pk_and_fk_checks(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    pk = Q.pk_check(parent, "p", ["k"]).first()
    assert (pk.rows, pk.distinct_keys, pk.duplicate_key_rows, pk.null_key_rows) == (3, 2, 1, 0)
    fk = Q.fk_check(child, "k", parent, "k", "c", "p").first()
    assert (fk.child_rows, fk.orphan_rows, fk.distinct_orphan_values) == (4, 1, 1)


def test_key_check_counts_exact_duplicates(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "a"), ("1", "b"), (None, "c")], "k string, v string")
    r = Q.key_check(df, "t", ["k"]).first()
    assert (r.rows, r.distinct_keys, r.duplicate_key_rows, r.null_key_rows, r.exact_duplicate_rows) == (4, 2, 2, 1, 1)


def test_cast_check_bounded_sorted_samples(spark):
    df = spark.createDataFrame([(v,) for v in ["1", "x", "y", "z", "w", "", None, "y"]], "n string")
    r = Q.cast_check(df, "t", {"n": "int"}).first()
    assert r.failures == 5 and r.samples == "w, x, y"


def test_reconcile_layers_detects_disagreement(spark):
    mk = spark.createDataFrame
    fo = mk([("o1", D("10.00"), D("12.00"), True)], "order_id string, item_value decimal(12,2), "
                                                    "order_value decimal(12,2), is_fulfilled boolean")
    fi = mk([("o1", D("9.00"))], "order_id string, item_value decimal(12,2)")
    dc = mk([(D("12.00"),)], "lifetime_revenue decimal(12,2)")
    items = mk([(D("10.00"),)], "price decimal(10,2)")
    checks = Q.reconcile_layers({"order_items": items}, {"fact_order": fo, "fact_order_item": fi, "dim_customer": dc})
    ok = {r.check.split(":")[0]: r.ok for r in checks.collect()}
    assert ok == {"item value": False, "lifetime revenue": True}
    with pytest.raises(AssertionError):
        Q.assert_reconciled(checks)


def test_approximate_aggregates_within_bound(spark):
    df = spark.range(0, 20000).select((F.col("id") % 5003).alias("v"))
    approx = Q.profile_columns(df.selectExpr("CAST(v AS string) AS v"), "t", approx=True).first().approx_distinct
    assert abs(approx - 5003) / 5003 <= 0.05
    p_exact = df.agg(F.percentile("v", 0.5)).first()[0]
    p_approx = df.agg(F.percentile_approx("v", 0.5)).first()[0]
    assert abs(p_approx - p_exact) / p_exact <= 0.05


def test_value_reconciliation_buckets(spark):
    a = spark.createDataFrame([("o1", D("10.00")), ("o2", D("10.00")), ("o3", D("5.00"))], "k string, a decimal(12,2)")
    b = spark.createDataFrame([("o1", D("10.01")), ("o2", D("12.00")), ("o4", D("1.00"))], "k string, b decimal(12,2)")
    r = Q.value_reconciliation(a, b, "k", "a", "b", approx=False).first()
    assert (r.orders, r.match, r.paid_more_than_items, r.payments_but_no_items, r.items_but_no_payments) == \
           (4, 1, 1, 1, 1)
    assert isinstance(r.p99_abs_diff, float) and dt is not None


def test_assert_keys_fails_on_orphans_and_duplicates(spark):
    parent = spark.createDataFrame([("a",), ("a",)], "k string")
    child = spark.createDataFrame([("a",), ("zz",)], "k string")
    pk = Q.pk_check(parent, "parent", ["k"])
    fk = Q.fk_check(child, "k", parent, "k", "child", "parent")
    with pytest.raises(AssertionError, match="parent.*child.k"):
        Q.assert_keys(pk, fk)
    clean_pk = Q.pk_check(parent.distinct(), "parent", ["k"])
    clean_fk = Q.fk_check(child.filter("k = 'a'"), "k", parent, "k", "child", "parent")
    Q.assert_keys(clean_pk, clean_fk)


def test_alerts_and_gate(spark):
    import pytest
    from tessera.operators.quality import assert_no_alerts, drifted, stale
    fresh = spark.createDataFrame([("a", 3), ("b", 40), ("c", None)], "source string, days_behind int")
    assert {r.source: r.alert for r in stale(fresh, 30).collect()} == {"a": False, "b": True, "c": True}
    months = spark.createDataFrame([("1", None, None), ("2", 10.0, 0.5), ("3", -60.0, 0.0), ("4", 1.0, 9.0)],
                                   "month string, volume_drift_pct double, null_rate_change double")
    report = drifted(months, 50, 5)
    assert {r.month for r in report.filter("alert").collect()} == {"3", "4"}
    with pytest.raises(AssertionError):
        assert_no_alerts(report, "drift")
    assert_no_alerts(report.filter("month < '3'"), "drift")


def test_tolerance_is_taken_as_given(spark):
    from tessera.operators.quality import value_reconciliation
    a = spark.createDataFrame([("1", 10.0), ("2", 10.0)], "k string, x double").selectExpr("k", "cast(x as decimal(12,3)) x")
    b = spark.createDataFrame([("1", 10.002), ("2", 300.0)], "k string, y double").selectExpr("k", "cast(y as decimal(12,3)) y")
    count = {t: value_reconciliation(a, b, "k", "x", "y", tolerance=t).first().match for t in (0.001, 0.01, 1000)}
    assert count == {0.001: 0, 0.01: 1, 1000: 2}


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_reconcile_works_out_fact_order_once(spark):
    mk = spark.createDataFrame
    fo = mk([("o1", D("10.00"), D("12.00"), True), ("o2", D("1.00"), D("2.00"), False), (None, D("4.00"), D("5.00"), None)],
            "order_id string, item_value decimal(12,2), order_value decimal(12,2), is_fulfilled boolean")
    fi = mk([("o1", D("15.00"))], "order_id string, item_value decimal(12,2)")
    dc = mk([(D("12.00"),)], "lifetime_revenue decimal(12,2)")
    items = mk([("o1", D("10.00")), (None, D("5.00"))], "order_id string, price decimal(10,2)")
    checks = Q.reconcile_layers({"order_items": items}, {"fact_order": fo, "fact_order_item": fi, "dim_customer": dc})
    assert [tuple(r) for r in checks.select("gold_order", "gold_item", "silver_source", "ok").collect()] == [
        (D("15.00"), D("15.00"), D("15.00"), True), (D("12.00"), D("12.00"), None, True)]
    one = Q.reconcile_layers({"order_items": items}, {"fact_order": fo.withColumn("item_value", F.col("item_value") + D("0.01")), "fact_order_item": fi,
                                                      "dim_customer": dc})
    assert "Filter is_fulfilled" not in _plan(one)


def test_in_parts_keeps_all_rows(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), (None, "y"), ("b", None), (None, None)], "k string, v string")
    for keys in (["k"], ["k", "v"], ["k", "other"], ["other"]):
        assert sorted(map(str, Q.in_parts(df, keys).collect())) == sorted(map(str, df.collect()))


def test_exact_profile_shuffles_a_value_and_one_count(spark):
    df = spark.createDataFrame([(v,) for v in ["a", "a", " ", None, None, "abc"]], "v string")
    got = Q.profile_columns(df, "t", approx=False)
    assert tuple(got.first()) == ("t", "v", 6, 2, 1, 3, 1, 3)
    assert "distinct" not in _plan(got).replace("distinct_values", "")
