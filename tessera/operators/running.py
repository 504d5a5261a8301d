"""Running totals over a whole table without one task that sees all of it.

A window without a partition key sorts the table in one task. Here it is a prefix sum in two phases: the
distinct order values are cut into ranges, each range is summed, and a value's running total is the
total of the ranges before its own plus the window inside it. Ties share the running value, as a RANGE frame
gives it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGES = 256


def _range_of(value: Column, cuts: list, first: int = 0) -> Column:
    """How many of the sorted ``cuts`` lie below ``value``, plus ``first``: a balanced tree of comparisons."""
    if not cuts:
        return F.lit(first)
    mid = len(cuts) // 2
    return F.when(value <= F.lit(cuts[mid]), _range_of(value, cuts[:mid], first)).otherwise(_range_of(value, cuts[mid + 1:], first + mid + 1))


def running_totals(df: DataFrame, order: str, value: str, descending: bool = False, ranges: int = RANGES) -> DataFrame:
    """(order, rows, sum, running, total), one row for each distinct value of ``order``: the sum of ``value`` of its rows, of all
    rows up to and with it, and of the table.

    ``order`` is a number, date or timestamp; NULL is a value like any other, first ascending and last descending. NULLs in
    ``value`` add nothing; a sum of NULLs alone is NULL. An empty table has no rows. The cuts are about
    ``ranges`` quantiles of the distinct values, so ties of any size do not weigh on them; they change the work, never the
    result. They come to the driver (``ranges`` values); rows never do."""
    per_value = df.groupBy(F.col(order).alias("_o")).agg(F.sum(value).alias("_s"), F.count(F.lit(1)).alias("rows"))
    kind = per_value.schema["_s"].dataType
    at = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    cuts = sorted(set(per_value.agg(F.percentile_approx("_o", at, 10_000)).first()[0] or []))
    cells = per_value.withColumn("_r", F.when(F.col("_o").isNull(), -1).otherwise(_range_of(F.col("_o"), cuts)))

    # each range's sum goes to every range (at most ranges * ranges small rows, summed map-side): no task orders all of them
    sums = cells.groupBy(F.col("_r").alias("_from")).agg(F.sum("_s").alias("_s"))
    before = F.col("_from") > F.col("_r") if descending else F.col("_from") < F.col("_r")
    offsets = (sums.select("_from", "_s", F.explode(F.sequence(F.lit(-1), F.lit(len(cuts)))).alias("_r"))
                   .groupBy("_r").agg(F.sum(F.when(before, F.col("_s"))).alias("_before"), F.sum("_s").alias("_total")))
    inside = F.sum("_s").over(Window.partitionBy("_r").orderBy(F.col("_o").desc() if descending else F.col("_o").asc()))
    placed = cells.withColumn("_inside", inside).join(offsets, "_r")
    running = F.coalesce(F.col("_before") + F.col("_inside"), F.col("_inside"), F.col("_before"))
    return placed.select(F.col("_o").alias(order), "rows", F.col("_s").alias("sum"), running.cast(kind).alias("running"),
                         F.col("_total").cast(kind).alias("total"))


def with_running(df: DataFrame, order: str, value: str, descending: bool = False, ranges: int = RANGES) -> DataFrame:
    """``df`` with ``running`` and ``total`` of ``value`` by ``order`` (``running_totals``). A frequent value of ``order`` meets one row,
    so a skewed join is split by Spark."""
    totals = running_totals(df, order, value, descending, ranges).select(F.col(order).alias("_o"), "running", "total")
    return df.join(totals, F.col(order).eqNullSafe(F.col("_o")), "left").drop("_o")
