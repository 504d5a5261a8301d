"""Type-2 history kept up to date by batches of events (X7, incremental).

The store holds two tables, bucketed by key: ``<name>_events`` (every event, appended) and ``<name>`` (the versions).
A batch may hold events of any time. For a key it touches, the versions that ended before the key's earliest new event
stay as they are; from the first event of the next version on, the key's events are ordered anew: a late event can
lengthen a version, split it, or open one before the first. Keys without an event in the batch are not worked on, and
buckets without one are neither read nor written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.conform import join_null_safe
from tessera.operators.history import scd2
from tessera.streaming.batches import BatchStore


def merge_history(store: BatchStore, batch_id: int, events: DataFrame, key: str, ts: str, tie: str, attr: str, name: str = "history",
                  slice_by: str = "month") -> None:
    """Merge ``events`` (one row each) into the history ``name`` of ``store``, whose versions are as ``scd2`` gives them.

    After any batches in any order the versions are those of ``scd2`` over all their events. NULL keys are one key, a NULL time comes first,
    and an event that is given twice counts twice, as in ``scd2``; a batch id that was merged before changes nothing."""
    batch = store.begin(batch_id)
    if batch.done:
        return
    log = f"{name}_events"
    known = store.parts(log)
    touched = batch.stage(events.select(key, ts, tie, attr), log, [key])
    fresh = store._open([p for p in batch.staged if p.name == log], touched)
    if fresh is None:  # no events
        batch.commit()
        return
    old_events, old = store._open(known, touched), batch.read(name, touched)
    if old is None:
        batch.stage(scd2(fresh, key, ts, tie, attr, slice_by), name, [key], replaces=True, touched=touched)
        batch.commit()
        return

    point = F.struct(F.col(ts), F.col(tie), F.col(attr))
    # `_cut`: the earliest new event of a key; NULL times are the earliest, and a struct around one is not NULL
    cuts = fresh.groupBy(key).agg(F.min(F.struct(F.col(ts).alias("at"))).alias("_cut"))
    placed = join_null_safe(old, cuts, [key], "left")
    stays = F.col("_cut").isNull() | (~F.col("is_current") & (F.struct(F.col("valid_to").alias("at")) < F.col("_cut")))
    placed = placed.withColumn("_stays", stays)
    opening = F.struct(F.col("valid_from").alias(ts), F.col("opened_by").alias(tie), F.col(attr))
    redo = placed.filter(~F.col("_stays")).groupBy(key).agg(
        F.min(F.struct("version", opening.alias("point"))).alias("_first")).select(
        key, (F.col("_first.version") - 1).alias("_kept"), F.col("_first.point").alias("_point"))
    again = join_null_safe(old_events, redo, [key]).filter(point >= F.col("_point")).select(key, ts, tie, attr)
    versions = scd2(again.unionByName(fresh), key, ts, tie, attr, slice_by)
    versions = join_null_safe(versions, redo.select(key, "_kept"), [key], "left").withColumn(
        "version", (F.col("version") + F.coalesce("_kept", F.lit(0))).cast("int"))
    batch.stage(placed.filter("_stays").select(*old.columns).unionByName(versions.select(*old.columns)), name, [key],
                replaces=True, touched=touched)
    batch.commit()
