import pytest

from tessera.operators.differences import row_differences, unequal_buckets

SCHEMA = "k string, i int, v string, w string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def found(left, right, buckets=16):
    return sorted(((r.k, r.i, r.left_rows, r.right_rows, r.difference) for r in row_differences(left, right, ["k", "i"], buckets).collect()), key=repr)


ROWS = [(f"k{n}", n % 3, "v", None if n % 5 else "w") for n in range(300)] + [(None, 1, "v", None), ("twice", 1, "a", "b"), ("twice", 1, "a", "b")]


def test_equal_tables_have_no_differences_in_any_order(spark):
    left, right = frame(spark, ROWS), frame(spark, ROWS[::-1]).repartition(3)
    assert unequal_buckets(left, right, ["k", "i"]).count() == 0 and found(left, right) == []


def test_planted_differences_are_found(spark):
    rows = [r for r in ROWS if r[0] != "k7"] + [("new", 0, None, None)]           # missing, added
    rows = [("k9", 0, "other", r[3]) if r[0] == "k9" else r for r in rows]         # changed
    rows = [("k11", 2, None, "v") if r[0] == "k11" else r for r in rows]           # NULL and value swap places
    rows = [r for r in rows if r[0] is not None] + [(None, 1, "v", "x")]           # a NULL key changed
    rows.remove(("twice", 1, "a", "b"))                                             # one copy fewer
    got = found(frame(spark, ROWS), frame(spark, rows))
    assert got == sorted([("k7", 1, 1, 0, "missing"), ("new", 0, 0, 1, "added"), ("k9", 0, 1, 1, "changed"), ("k11", 2, 1, 1, "changed"),
                          (None, 1, 1, 1, "changed"), ("twice", 1, 2, 1, "changed")], key=repr)
    assert got == found(frame(spark, ROWS), frame(spark, rows), buckets=1)
    assert unequal_buckets(frame(spark, ROWS), frame(spark, rows), ["k", "i"], 4096).count() <= 6


def test_empty_sides_and_shapes(spark):
    empty, one = frame(spark, []), frame(spark, [("a", 1, None, None)])
    assert found(empty, empty) == [] and found(one, empty) == [("a", 1, 1, 0, "missing")] and found(empty, one) == [("a", 1, 0, 1, "added")]
    assert found(one, one.select("w", "v", "i", "k")) == []
    with pytest.raises(ValueError, match="differ in columns"):
        row_differences(one, one.drop("w"), ["k"])


def test_only_bucket_rows_and_unequal_buckets_are_shuffled(spark):
    plan = row_differences(frame(spark, ROWS), frame(spark, ROWS), ["k", "i"])._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "strategy=broadcast" in plan
