"""Exact percentile (percentile_cont) that never sorts a whole group in one task.

Spark's ``percentile`` aggregate keeps a map of every distinct value of a group and merges it in one task: fine for
day counts, unbounded for money or coordinates under a hot key. This operator computes the same value
(same interpolation formula) by radix selection on the 64 bits of the double, made to order like the values:

1. the group's values are counted by their leading ``DIGITS[0]`` bits, and running counts over this histogram tell which
   leading bits the value of rank ``floor((n - 1) * p) + 1`` has and how many ranks are left to go;
2. only values with these bits go into the next round, which counts them by their next bits, and so on to the last bit;
3. the value after it is the least one above, taken by a partial aggregate.

Values far from the others move nothing: bits, not ranges, make the digits. What one task orders for a group is a histogram of at
most 2 ** max(DIGITS) counts, whatever the values. Digits are functions of the row and ranks of exact counts
alone, so the result does not depend on how often or where Spark works a branch out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.conform import join_null_safe

#: Bits counted in each round.
DIGITS = (22, 21, 21)
SIGN = -(1 << 63)


def ordered_bits(v: Column) -> Column:
    """The bits of a double as a LONG whose unsigned order is that of the values, with NaN above all (0.0 and -0.0 differ)."""
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), v).cast("long")
    return F.when(bits >= 0, bits.bitwiseXOR(F.lit(SIGN))).otherwise(F.bitwise_not(bits))


def exact_percentile(df: DataFrame, value: str, p: float, by: list[str] | None = None, alias: str = "percentile") -> DataFrame:
    """One row per group of ``by`` (one row overall when empty) with the ``p``-quantile of ``value`` as DOUBLE. NULL values are
    ignored; a group without values has no row; a NULL group is a group like any other; NaN is
    the greatest value. Without ``by`` there is always one row, NULL if empty."""
    by = list(by or [])
    values = df.select(*by, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    pairs = values.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c"))  # grouping makes -0.0 a 0.0
    pairs = pairs.withColumn("_u", ordered_bits(F.col("_v")))

    rows, wanted, done = pairs, None, 0
    for width in DIGITS:
        done += width
        if wanted is not None:  # only what has the leading bits found so far
            rows = _meet(rows, wanted, by, F.shiftrightunsigned("_u", 64 - done + width) == F.col("_bits"))
        digit = F.shiftrightunsigned("_u", 64 - done).bitwiseAND(F.lit((1 << width) - 1))
        carried = [] if wanted is None else [F.max("_rank").alias("_rank"), F.max("_more").alias("_more"), F.max("_share").alias("_share"),
                                             F.max("_bits").alias("_bits")]
        counts = rows.groupBy(*by, digit.alias("_d")).agg(F.sum("_c").alias("_n"), *carried)
        group = Window.partitionBy(*by)
        if wanted is None:
            place = (F.sum("_n").over(group) - 1).cast("double") * F.lit(float(p))
            counts = counts.withColumns({"_rank": F.floor(place) + 1, "_more": F.ceil(place) - F.floor(place), "_share": place - F.floor(place),
                                         "_bits": F.lit(0).cast("long")})
        end = F.sum("_n").over(group.orderBy("_d").rowsBetween(Window.unboundedPreceding, 0))
        wanted = (counts.withColumn("_end", end).filter((F.col("_end") - F.col("_n") < F.col("_rank")) & (F.col("_rank") <= F.col("_end")))
                  .select(*by, F.shiftleft("_bits", width).bitwiseOR(F.col("_d")).alias("_bits"),
                          (F.col("_rank") - (F.col("_end") - F.col("_n"))).alias("_rank"), "_n", "_more", "_share"))

    signed = F.col("_u").bitwiseXOR(F.lit(SIGN))
    found = F.col("_bits").bitwiseXOR(F.lit(SIGN))
    ends = _meet(pairs, wanted, by, signed >= found).groupBy(*by).agg(
        F.max(F.when(signed == found, F.col("_v"))).alias("_x"), F.min(F.when(signed > found, F.col("_v"))).alias("_y"),
        *[F.max(c).alias(c) for c in ("_rank", "_n", "_more", "_share")])
    above = F.when(F.col("_rank") + F.col("_more") <= F.col("_n"), F.col("_x")).otherwise(F.col("_y"))
    result = F.when(F.col("_more") == 0, F.col("_x")).otherwise((1 - F.col("_share")) * F.col("_x") + F.col("_share") * above)
    return ends.select(*by, result.alias(alias))


def _meet(rows: DataFrame, wanted: DataFrame, by: list[str], condition: Column) -> DataFrame:
    """The rows of a group that fulfil a condition on what is wanted of it (one row a group), with its columns."""
    rows = rows.select(*by, "_v", "_c", "_u")
    if by:
        return join_null_safe(rows, wanted, by).filter(condition)
    one = wanted.select(F.struct(*wanted.columns)).scalar()  # one row: a scalar, not a join
    return rows.withColumn("_w", one).select("_v", "_c", "_u", "_w.*").filter(condition)
