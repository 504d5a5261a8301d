"""SCD type 2 history (X7): versions of an attribute per key over time.

A new version starts at a key's first event and at every event whose
attribute differs (NULL-safe) from the previous event's. The usual
``lag()`` over each key would push a hot key's whole history through one
task, so a key's history is cut into calendar months: a slice is a
function of the row alone, ``lag`` runs inside each slice, and a small table
with one row per (key, month) carries the previous slice's last value and the
number of versions before. ``valid_to`` comes from an equi-join to the next
version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def scd2(df: DataFrame, key: str, ts: str, tie: str, attr: str, slice_by: str = "month") -> DataFrame:
    """(key, version, attr, valid_from, valid_to, is_current, events, opened_by: ``tie`` of the first event).

    Events are ordered by time (NULL first), then ``tie``, then ``attr``. NULL keys are
    one key. ``slice_by`` is the calendar unit of a slice (finer for denser histories)."""
    # a key and its slice in one column: grouped, windowed and joined on it (NULLs in a struct are equal), so that the
    # events are shuffled once for all three
    part = F.struct(F.col(key), F.date_trunc(slice_by, F.col(ts)).alias("_slice"))
    rows = df.select(key, ts, tie, attr).withColumn("_part", part)
    order = F.struct(F.col(ts), F.col(tie), F.col(attr))
    local = Window.partitionBy("_part").orderBy(ts, tie, attr)
    differs = (F.row_number().over(local) > 1) & ~F.col(attr).eqNullSafe(F.lag(attr).over(local))
    rows = rows.withColumn("_change", differs.cast("int"))
    # by value, not by place: equal events are of one version, whatever their order
    rows = rows.withColumn("_upto", F.sum("_change").over(local.rangeBetween(Window.unboundedPreceding, 0)))
    over = Window.partitionBy(key).orderBy("_slice")  # one row per month of a key
    slices = rows.groupBy("_part").agg(F.min(order)[attr].alias("_first"), F.max(order)[attr].alias("_last"), F.sum("_change").alias("_n"))
    slices = slices.select("_part", F.col(f"_part.{key}").alias(key), F.col("_part._slice").alias("_slice"), "_first", "_last", "_n")
    # does a slice open a version? the first of a key does, and one that does not start with the value before
    opens = F.when(F.row_number().over(over) > 1, ~F.col("_first").eqNullSafe(F.lag("_last").over(over))).otherwise(F.lit(True))
    slices = slices.withColumn("_opens", opens.cast("int"))
    before = F.coalesce(F.sum(F.col("_n") + F.col("_opens")).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    slices = slices.select("_part", (before + F.col("_opens")).alias("_before"))
    versions = (rows.join(slices, "_part").withColumn("_version", F.struct(F.col(key), (F.col("_before") + F.col("_upto")).alias("version")))
                .groupBy("_version").agg(F.min(order).alias("_opened"), F.count(F.lit(1)).alias("events")))
    follows = F.struct(F.col(f"_version.{key}").alias(key), (F.col("_version.version") - 1).alias("version"))
    after = versions.select(follows.alias("_version"), F.col(f"_opened.{ts}").alias("valid_to"), F.lit(True).alias("_ended"))
    return versions.join(after, "_version", "left").select(
        F.col(f"_version.{key}").alias(key), F.col("_version.version").cast("int").alias("version"), F.col(f"_opened.{attr}").alias(attr),
        F.col(f"_opened.{ts}").alias("valid_from"), "valid_to", F.col("_ended").isNull().alias("is_current"), "events",
        F.col(f"_opened.{tie}").alias("opened_by"))
