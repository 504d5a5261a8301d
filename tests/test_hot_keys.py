"""Operators under a key holding a third of the rows, against brute force."""

import random

import pandas as pd
import pytest

from tessera.operators import quality as Q
from tessera.operators.conform import dedupe, majority


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        k = "hot" if i % 3 == 0 else f"k{rng.randint(0, 200)}"
        rows.append((k, rng.choice(["a", "b", "c", None]), rng.randint(0, 50), rng.choice(["x", "y"])))
    return rows, spark.createDataFrame(rows, "k string, city string, n int, s string").repartition(6)


def test_dedupe_hot_key(skewed):
    rows, df = skewed
    got = {r.k: (r.city, r.n, r.s) for r in dedupe(df, ["k"]).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "city", "n", "s"])
    want = {}
    for k, g in pdf.groupby("k"):
        # other columns in name order (city, n, s), ascending, NULLs last
        g = g.sort_values(["city", "n", "s"], na_position="last")
        r = g.iloc[0]
        want[k] = (None if pd.isna(r.city) else r.city, int(r.n), r.s)
    assert got == want


def test_majority_hot_key(skewed):
    rows, df = skewed
    got = {r.k: (r.city, r.s) for r in majority(df, "k", ["city", "s"]).collect()}
    counts = {}
    for k, c, _, s in rows:
        counts.setdefault(k, {}).setdefault((c, s), 0)
        counts[k][(c, s)] += 1
    want = {}
    for k, m in counts.items():
        best = sorted(m.items(), key=lambda kv: (-kv[1], kv[0][0] is None, kv[0][0] or "", kv[0][1]))[0][0]
        want[k] = best
    assert got == want


def test_fk_check_hot_child_key(spark, skewed):
    rows, df = skewed
    parent = spark.createDataFrame([("hot",), ("k1",), ("k2",)], "k string")
    r = Q.fk_check(df, "k", parent, "k", "c", "p").first()
    orphans = [x for x in rows if x[0] not in {"hot", "k1", "k2"}]
    assert (r.child_rows, r.orphan_rows, r.distinct_orphan_values) == (3000, len(orphans), len({x[0] for x in orphans}))


def test_a_child_of_two_parents_is_worked_out_once(spark):
    child = dedupe(spark.range(300).selectExpr("if(id % 7 = 0, NULL, id % 50) AS a", "if(id % 5 = 0, NULL, id % 40) AS b", "id AS n"), ["a", "b"])
    one, two = spark.range(45).toDF("a"), spark.range(30).toDF("b")
    report = Q.union_all([Q.fk_check(child, "a", one, "a", "c", "one"), Q.fk_check(child, "b", two, "b", "c", "two")])
    rows = {(None if i % 7 == 0 else i % 50, None if i % 5 == 0 else i % 40) for i in range(300)}
    a, b = [x for x, _ in rows if x is not None], [y for _, y in rows if y is not None]
    assert [tuple(r)[2:] for r in report.collect()] == [
        (len(a), sum(x >= 45 for x in a), len({x for x in a if x >= 45})), (len(b), sum(y >= 30 for y in b), len({y for y in b if y >= 30}))]
    assert "ReusedExchange" in report._jdf.queryExecution().executedPlan().toString()
