"""Tables and key counts that are written a few at once."""

import threading
import uuid

import pytest
from pyspark.sql import functions as F

from tessera.operators import quality as Q
from tessera.operators.key_counts import KeyCounts
from tessera.session import scratch_path, side_by_side


def test_jobs_overlap_and_wait_for_what_they_need(spark):
    both = threading.Barrier(2, timeout=20)
    jobs = {"a": lambda _: both.wait() and 0 or 1, "b": lambda _: both.wait() and 0 or 2, "c": lambda done: done["a"] + done["b"], "d": lambda done: len(done)}
    assert side_by_side(spark, jobs, {"c": ("a", "b")}, at_once=2) == {"a": 1, "b": 2, "c": 3, "d": 0}
    assert list(side_by_side(spark, {n: lambda _: 1 for n in "zyx"})) == ["z", "y", "x"]
    with pytest.raises(ValueError, match="no"):
        side_by_side(spark, {"a": lambda _: (_ for _ in ()).throw(ValueError("no")), "b": lambda done: done["a"]}, {"b": ("a",)})


def test_key_counts_are_shuffled_once(spark):
    keys = KeyCounts(spark, scratch_path(spark, f"keys-{uuid.uuid4().hex[:8]}"), buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    df = spark.range(400).select((F.col("id") % 150).cast("string").alias("k"), F.col("id").alias("n"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(group := uuid.uuid4().hex, "key counts")
    try:
        keys.prepare([(df, "t", ["k"])])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    assert len([s for s in stages if tracker.getStageInfo(s) and tracker.getStageInfo(s).numCompletedTasks]) == 2
    assert keys.pk_check(df, "t", ["k"]).collect() == Q.pk_check(df, "t", ["k"]).collect()


def test_keys_of_other_types_meet_as_before(spark):
    keys = KeyCounts(spark, scratch_path(spark, f"keys-{uuid.uuid4().hex[:8]}"), buckets=2)
    child = spark.createDataFrame([("1",), ("2",), ("7",), (None,)], "k string")
    parent = spark.range(4).toDF("p")
    assert keys.fk_check(child, "k", parent, "p", "c", "p").first()[2:] == Q.fk_check(child, "k", parent, "p").first()[2:] == (3, 1, 1)
