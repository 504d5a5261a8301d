"""Row-level differences between two tables that should hold the same rows (two layers, two versions, two builds).

Each side is reduced to one checksum a bucket of its keys: the number of rows and two sums of 64-bit row hashes, which
do not depend on the order of rows. The sums are worked map-side, so at most ``buckets`` rows a partition
are shuffled. Only rows of buckets whose checksums differ are then compared key by key; equal tables end after the first step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def _hash(cols: list[str], salt: int) -> Column:
    """64-bit hash; the flags keep a NULL apart from the column that is skipped for it."""
    flags = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cols])
    return F.xxhash64(F.lit(salt), flags, *[F.col(c) for c in cols])


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(_hash(keys, 0), F.lit(buckets))


def bucket_checksums(df: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, rows, sum1, sum2) of the non-empty buckets of ``keys``. Repeated rows count as often as they
    occur, a NULL is a value like any other."""
    def total(salt: int) -> Column:
        return F.sum(_hash(df.columns, salt).cast("decimal(20,0)"))
    return (df.groupBy(_bucket(keys, buckets).alias("bucket"))
              .agg(F.count(F.lit(1)).alias("rows"), total(1).alias("sum1"), total(2).alias("sum2")))


def unequal_buckets(left: DataFrame, right: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket) where the two sides do not hold the same rows: at most ``buckets`` rows."""
    sides = (bucket_checksums(left, keys, buckets).withColumn("side", F.lit(1))
             .unionByName(bucket_checksums(right, keys, buckets).withColumn("side", F.lit(-1))))
    off = [F.sum(F.col(c) * F.col("side")) != 0 for c in ("rows", "sum1", "sum2")]
    return sides.groupBy("bucket").agg((off[0] | off[1] | off[2]).alias("off")).filter("off").select("bucket")


def row_differences(left: DataFrame, right: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(keys, left_rows, right_rows, difference) for every key whose rows differ between the sides, as multisets:
    ``missing`` (on the left only), ``added`` (on the right only), ``changed`` (on both, with other values or
    another number of rows). The counts are those of all the key's rows in either table. NULL keys are a key; empty tables are fine. Both sides
    need the same columns and types.

    The list of unequal buckets is joined by broadcast: it has at most ``buckets`` numbers."""
    if sorted(left.dtypes) != sorted(right.dtypes):
        raise ValueError(f"sides differ in columns or types: {left.dtypes} and {right.dtypes}")
    right = right.select(*left.columns)
    off = F.broadcast(unequal_buckets(left, right, keys, buckets).withColumnRenamed("bucket", "_bucket"))

    def rows(df: DataFrame, l: int, r: int) -> DataFrame:
        kept = df.withColumn("_bucket", _bucket(keys, buckets)).join(off, "_bucket", "left_semi")
        return kept.select(*keys, _hash(left.columns, 1).alias("_h1"), _hash(left.columns, 2).alias("_h2"),
                           F.lit(l).alias("_l"), F.lit(r).alias("_r"))

    per_row = rows(left, 1, 0).unionByName(rows(right, 0, 1)).groupBy(*keys, "_h1", "_h2").agg(
        F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    per_key = per_row.groupBy(*keys).agg(F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows"),
                                         F.bool_or(F.col("_l") != F.col("_r")).alias("_off"))
    kind = F.when(F.col("right_rows") == 0, "missing").when(F.col("left_rows") == 0, "added").otherwise("changed")
    return per_key.filter("_off").select(*keys, "left_rows", "right_rows", kind.alias("difference"))
