from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.running import running_totals, with_running


def window(df, descending):
    o = F.col("o").desc() if descending else F.col("o").asc()
    return df.withColumns({"running": F.sum("v").over(Window.orderBy(o)), "total": F.sum("v").over(Window.partitionBy())})


def rows(df):
    return sorted((tuple(r) for r in df.select("id", "o", "v", "running", "total").collect()), key=repr)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("ranges", [1, 2, 7, 256])
def test_equals_the_window_with_ties_and_nulls(spark, descending, ranges):
    ids = spark.range(3_000)
    o = F.when(F.col("id") % 3 == 0, F.lit(40)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 97).cast("int")
    v = F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") * F.lit(Decimal("0.01"))).cast("decimal(12,2)")
    df = ids.select("id", o.alias("o"), v.alias("v"))
    assert rows(with_running(df, "o", "v", descending, ranges)) == rows(window(df, descending))


@pytest.mark.parametrize("data", [[], [(1, None, None)], [(1, 5, None), (2, 6, None)], [(1, None, 2.0), (2, 3, None), (3, 3, 1.0)]])
def test_small_and_null_tables(spark, data):
    df = spark.createDataFrame(data, "id long, o int, v double")
    for descending in (False, True):
        assert rows(with_running(df, "o", "v", descending)) == rows(window(df, descending))


def test_a_million_groups_without_one_task(spark):
    df = spark.range(1_000_000).select(F.col("id").alias("o"), F.lit(1).alias("v"))
    got = running_totals(df, "o", "v")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" in plan
    assert got.agg(F.count_if(F.col("running") != F.col("o") + 1), F.count(F.lit(1)), F.max("total")).first()[:] == (0, 1_000_000, 1_000_000)
    # no task orders many more than its share of the values
    share = got.select("o", F.spark_partition_id().alias("p")).groupBy("p").count().agg(F.max("count")).first()[0]
    assert share < 700_000
