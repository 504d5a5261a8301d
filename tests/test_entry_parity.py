"""Driver contract and an oracle parity sample at sf0.001 (the full check is
``python tests/parity.py <sf_dir>``)."""

import os

import pytest

from tests.parity import compare, duck

SF = "/root/testdata/sf0.001"
SAMPLE = ["dedupe_line_items", "stg_geography", "stg_order_items", "fact_order", "dim_customer",
          "q1b_top_categories", "q3_delivery_extremes", "q5_cohort_retention", "q7_basket_by_state",
          "dq_keys", "dq_casts", "dq_fk_violations", "reconcile_layers", "dim_customer_history",
          "x8_campaign_targets", "dq_volume_drift", "dq_columns", "dq_columns_approx", "dq_group_sizes_approx",
          "dq_file_freshness", "dq_freshness_alerts", "dq_volume_alerts", "reconcile_rows", "dq_entity_dupes", "q1a_top_products"]

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def test_contract(spark):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert {q for q in set(qs) - set(sqls) if not q.startswith("op")} <= {"pipeline"}
    df = E.entry(spark)
    assert df.count() > 0 and "revenue" in df.columns


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", SAMPLE)
def test_oracle_parity(spark, con, name):
    import __spark_entry__ as E
    status, n, _, _ = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert status == ["OK"], status


def test_file_freshness_has_a_time(spark):
    from tessera.operators.quality import file_freshness
    (r,) = file_freshness({"orders": spark.read.parquet(f"{SF}/orders.parquet")}).collect()
    assert r.rows == 1500 and r.files == 1 and r.newest_file_at is not None
