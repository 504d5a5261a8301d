"""Plan-shape checks: the properties the scale design relies on."""

import os

import pytest

from tessera.operators.conform import dedupe
from tessera.operators.sequence import order_sequence
from tessera.plans import analytics as A
from tessera.plans.tables import RetailTables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return RetailTables(spark, SF)


def _partial_limit_below_exchange(p: str) -> bool:
    lines = p.splitlines()
    partial = [i for i, ln in enumerate(lines) if "WindowGroupLimit" in ln and "Partial" in ln]
    exchange = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]
    return bool(partial) and bool(exchange) and min(partial) > min(exchange)  # printed below = runs before


def test_dedupe_cuts_hot_keys_before_the_shuffle(tables):
    assert _partial_limit_below_exchange(plan(dedupe(tables.bronze("order_items"), ["order_id", "order_item_id"])))


def test_order_sequence_is_a_bounded_top_k(tables):
    assert _partial_limit_below_exchange(plan(order_sequence(tables.gold("fact_order"), depth=2)))


@pytest.mark.parametrize("name", list(A.QUERIES))
def test_no_cross_products_and_filters_pushed(tables, name):
    class G:
        def __getitem__(self, t):
            return tables.gold(t)
    p = plan(A.run(name, G()))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_fulfilled_filter_reaches_the_scan(spark, tables, tmp_path_factory):
    # on written gold the is_fulfilled predicate is a Parquet pushed filter
    from tessera.session import checkpoint_dir
    import uuid
    path = f"{checkpoint_dir(spark)}/plan-{uuid.uuid4().hex[:6]}/fact_order"
    tables.gold("fact_order").write.parquet(path)
    fo = spark.read.parquet(path)
    p = plan(A.repeat_rate_variants(fo))
    assert "PushedFilters: [IsNotNull(is_fulfilled), EqualTo(is_fulfilled,true)]" in p
    assert "ReadSchema: struct<order_id:string,customer_key:string,purchased_at:timestamp,is_fulfilled:boolean>" in p


def test_item_reports_have_no_expand_and_months_reach_the_scan(tables, spark):
    for name in ("q1a_top_products", "q1b_top_categories"):
        class G:
            def __getitem__(self, t):
                return tables.gold(t)
        assert "Expand" not in plan(A.run(name, G()))
    assert "Expand" not in plan(tables.gold("fact_order"))
    import uuid
    from tessera.session import checkpoint_dir
    path = f"{checkpoint_dir(spark)}/plan-{uuid.uuid4().hex[:8]}"
    tables.gold("fact_order").write.parquet(path)
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        p = plan(A.monthly_revenue(spark.read.parquet(path), tables.gold("dim_date")))
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    assert "GreaterThanOrEqual(purchase_date_key" in p


def test_no_query_reshuffles_its_source(spark):
    from tessera.plans.registry import queries
    for name in ("q1a_top_products", "q3_delivery_extremes", "stg_geography", "dq_keys", "dim_customer"):
        assert "RoundRobin" not in plan(queries()[name](spark, "/root/testdata/sf0.001"))
