"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Hashable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Name, Result = TypeVar("Name", bound=Hashable), TypeVar("Result")

# Settings every tessera job relies on: ANSI casts/arithmetic (strict), UTC
# timestamps, adaptive execution with skew-join splitting.
CORE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(
    master: str | None = None,
    app_name: str = "tessera",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the core settings.

    ``master`` is only set when given: on a cluster the launcher decides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(CORE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it). Only when it is
    unset and the master is local - tests - a fresh folder is made and
    registered; on a cluster a missing setting is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir is unset: on a cluster it must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), *parts)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of frames made inside go when their job is over, not when the driver's garbage
    collector finds them. For frames that are worked once; one that is returned to a caller is made outside."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def side_by_side(spark: SparkSession, jobs: dict[Name, Callable[[dict[Name, Result]], Result]], after: dict[Name, tuple[Name, ...]] | None = None,
                 at_once: int = 4) -> dict[Name, Result]:
    """Run ``jobs``, a few at once, so that the last tasks of one leave no core idle; returns their results, in the jobs' order. Each gets the results of the jobs
    that ``after`` names, which come before it in ``jobs``. The first failure is raised when the jobs under way are over; the others do not begin."""
    done: dict[Name, Future[Result]] = {}
    with ThreadPoolExecutor(at_once) as pool:  # a job only waits for earlier ones, which begin first
        def run(name: Name) -> Result:
            return jobs[name]({n: done[n].result() for n in (after or {}).get(name, ()) if n in done})

        for name in jobs:
            done[name] = pool.submit(inheritable_thread_target(spark)(run), name)
        try:
            return {name: f.result() for name, f in done.items()}
        except BaseException:
            pool.shutdown(wait=False, cancel_futures=True)
            raise
