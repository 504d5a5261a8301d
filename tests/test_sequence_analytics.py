from pyspark.sql import functions as F
import datetime as dt
import random
from decimal import Decimal as D

import pandas as pd

from tessera.operators.sequence import order_sequence
from tessera.plans import analytics as A

T = dt.datetime.fromisoformat


def _fact(spark, rows):
    return spark.createDataFrame(rows, "order_id string, customer_key string, purchased_at timestamp, "
                                       "is_fulfilled boolean, order_value decimal(12,2)")


def test_order_sequence_matches_brute_force(spark):
    rng = random.Random(7)
    base = T("2001-01-01 00:00:00")
    rows = []
    for i in range(400):
        cust = f"c{rng.randint(0, 40)}"
        if i % 50 == 0:
            cust = "hot"  # a heavy customer
        at = base + dt.timedelta(days=rng.randint(0, 30), minutes=rng.choice([0, 0, 3, 600]))
        rows.append((f"o{i:04d}", cust, at, rng.random() > 0.1, D("1.00")))
    df = _fact(spark, rows)
    got = {(r.customer_key, r.order_seq): (r.order_id, r.next_at, r.gap_days)
           for r in order_sequence(df, depth=3).collect()}
    pdf = pd.DataFrame(rows, columns=["order_id", "customer_key", "purchased_at", "is_fulfilled", "v"])
    pdf = pdf[pdf.is_fulfilled].sort_values(["customer_key", "purchased_at", "order_id"])
    want = {}
    for cust, g in pdf.groupby("customer_key"):
        g = g.reset_index(drop=True)
        for i in range(min(3, len(g))):
            nxt = g.purchased_at[i + 1] if i + 1 < len(g) and i < 2 else None
            gap = (nxt.date() - g.purchased_at[i].date()).days if nxt is not None else None
            want[(cust, i + 1)] = (g.order_id[i], None if nxt is None else nxt.to_pydatetime(), gap)
    assert got == want


def test_running_total_ties_share_value(spark):
    fi = spark.createDataFrame([
        ("o1", "k1", "cA", True, D("10.00"), D("10.00")), ("o2", "k2", "cA", True, D("10.00"), D("10.00")),
        ("o3", "k3", "cB", True, D("5.00"), D("5.00")),
    ], "order_id string, product_key string, customer_key string, is_fulfilled boolean, gross_item_value decimal(12,2), "
       "item_value decimal(12,2)")
    dp = spark.createDataFrame([("k1", "p1", "x"), ("k2", "p2", "y"), ("k3", "p3", "z")],
                               "product_key string, product_id string, category string")
    got = {r.category: r.cumulative_pct for r in A.top_categories(fi, dp).collect()}
    assert got == {"x": 80.0, "y": 80.0, "z": 100.0}


def test_gap_histogram_split_checkouts(spark):
    rows = [("o1", "a", T("2001-01-01 10:00:00"), True, D("1")), ("o2", "a", T("2001-01-01 10:05:00"), True, D("1")),
            ("o3", "b", T("2001-01-01 10:00:00"), True, D("1")), ("o4", "b", T("2001-01-01 10:05:05"), True, D("1")),
            ("o5", "c", T("2001-01-01 10:00:00"), True, D("1")), ("o6", "c", T("2001-01-03 09:00:00"), True, D("1")),
            ("o7", "d", T("2001-01-01 10:00:00"), True, D("1"))]
    got = {r.gap_days: (r.customers, r.within_5_minutes) for r in A.gap_histogram(_fact(spark, rows)).collect()}
    # 5m00s and 5m05s both round to 5.0/5.1 minutes: only the first is within 5
    assert got == {0: (2, 1), 2: (1, 0)}


def test_delivery_extremes_threshold_is_scalar_subquery(spark):
    fo = spark.createDataFrame(
        [(f"o{i}", f"k{i % 3}", True, i, 5 - i % 2, D("4.00") if i % 5 else None) for i in range(300)],
        "order_id string, customer_key string, is_fulfilled boolean, delivery_days int, days_early int, "
        "review_score decimal(3,2)")
    dc = spark.createDataFrame([("k0", "S0"), ("k1", "S1"), ("k2", "S2")], "customer_key string, customer_state string")
    out = A.delivery_extremes(fo, dc, A.Params(min_support=50))
    assert "CartesianProduct" not in out._jdf.queryExecution().executedPlan().toString()
    rows = out.collect()
    assert len(rows) == 3 and sum(r.extreme_orders for r in rows) == 3  # p99 of 0..299 = 296.01


def test_campaign_targets_has_both_groups(spark):
    import datetime as dt
    from tessera.functions.columns import surrogate_key
    from tessera.plans.analytics import campaign_targets
    people = [(f"p{i}", 1 if i % 5 else 2, float(i)) for i in range(60)]
    dim = spark.createDataFrame(people, "customer_unique_id string, lifetime_fulfilled_orders long, revenue double").select(
        surrogate_key("customer_unique_id").alias("customer_key"), "customer_unique_id", F.lit("SP").alias("customer_state"),
        "lifetime_fulfilled_orders", F.col("revenue").cast("decimal(12,2)").alias("lifetime_revenue"))
    fact = spark.createDataFrame([(f"p{i}", dt.datetime(2001, 6, 25), i % 20) for i in range(60)], "who string, purchased_at timestamp, delivery_days int").select(
        surrogate_key("who").alias("customer_key"), "purchased_at", "delivery_days", F.lit(True).alias("is_fulfilled"))
    got = campaign_targets(fact, dim).collect()
    want = set()
    once = sorted(r for p, n, r in people if n == 1)
    median = (once[(len(once) - 1) // 2] + once[len(once) // 2]) / 2
    for i, (p, n, r) in enumerate(people):
        days = (dt.date(2001, 8, 1) - (dt.date(2001, 6, 25) + dt.timedelta(days=i % 20))).days
        if n == 1 and r >= median and 21 <= days <= 30:
            want.add((p, days))
    assert {(r.customer_unique_id, r.days_since_delivery) for r in got} == want and len(got) >= 8
    assert {r.campaign_group for r in got} == {"holdout", "treatment"}


def test_packed_keys_stay_different_and_are_half_as_long(spark):
    from pyspark.sql import functions as F
    from tessera.plans.analytics import _packed
    sha = "ab" * 32
    texts = [sha, sha.upper(), sha[:-1], bytes.fromhex(sha).decode("latin-1"), "A" * 32, "\x00" * 32, "", "c1", "C1", "x"]
    got = spark.createDataFrame([(t,) for t in texts], "k string").select(_packed("k").alias("p"), F.length(_packed("k")).alias("n")).collect()
    assert len({bytes(r.p) for r in got}) == len(texts) and got[0].n == 32 and all(r.n != 32 for r in got[1:])
    assert spark.createDataFrame([(None,)], "k string").select(_packed("k").alias("p")).first().p is None
