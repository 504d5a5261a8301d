import datetime as dt
import random

import pytest

from tessera.operators.history import scd2


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_scd2_matches_brute_force_with_a_hot_key(spark, reuse):
    old = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    rng = random.Random(11)
    base = dt.datetime(2001, 1, 1)
    rows = []
    for i in range(600):
        k = "hot" if i % 2 == 0 else None if i % 7 == 0 else f"k{rng.randint(0, 25)}"
        rows.append((k, base + dt.timedelta(hours=rng.randint(0, 2000)), f"o{i:04d}",
                     rng.choice(["A", "A", "B", None])))
    df = spark.createDataFrame(rows, "k string, t timestamp, o string, z string")
    got = {(r.k, r.version): (r.z, r.valid_from, r.valid_to, r.is_current, r.events)
           for r in scd2(df, "k", "t", "o", "z").collect()}
    want = {}
    for k in {r[0] for r in rows}:
        ev = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2]))
        vers = []
        for i, (_, t, _, z) in enumerate(ev):
            if i == 0 or z != ev[i - 1][3]:
                vers.append([z, t, 0])
            vers[-1][2] += 1
        for v, (z, t, n) in enumerate(vers, start=1):
            nxt = vers[v][1] if v < len(vers) else None
            want[(k, v)] = (z, t, nxt, nxt is None, n)
    assert got == want
    spark.conf.set("spark.sql.exchange.reuse", old)


def test_equal_events_stay_in_one_version(spark):
    t = dt.datetime(2001, 1, 1)
    rows = [("k", t, "a", None)] + [("k", t + dt.timedelta(1), "b", "A")] * 5 + [("k", None, "c", "Z")]
    for n in (1, 3):
        got = scd2(spark.createDataFrame(rows, "k string, t timestamp, o string, z string").repartition(n), "k", "t", "o", "z").orderBy("version")
        assert [(r.z, r.valid_from, r.events, r.opened_by) for r in got.collect()] == [
            ("Z", None, 1, "c"), (None, t, 1, "a"), ("A", t + dt.timedelta(1), 5, "b")]


def test_events_are_shuffled_once(spark):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    df = spark.createDataFrame([(None, None, None, None)], "k string, t timestamp, o string, z string")
    plan = scd2(df, "k", "t", "o", "z")._jdf.queryExecution().executedPlan().toString()
    for k, v in old.items():
        spark.conf.set(k, v)
    assert plan.count("Exchange hashpartitioning") <= 9  # 19 when the steps were joined on key and slice, NULL-safe
