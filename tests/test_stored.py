"""Tables written once: key counts, facts by month, runs published as a whole."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tessera.operators.key_counts import KeyCounts
from tessera.operators.quality import assert_no_alerts, domain_check, file_freshness, fk_check, pk_check, stale_files
from tessera.session import scratch_path
from tessera.sources.months import in_months, on_dates, write_by_month
from tessera.sources.sinks import current_version, open_run, open_table, publish_run, retire_versions, stage_table, write_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def base(spark):
    return scratch_path(spark, f"stored-test-{uuid.uuid4().hex[:8]}")


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def keyed(spark):
    parent = spark.createDataFrame([(f"p{i}",) for i in range(50)] + [("p1",), (None,)], "id string")
    child = spark.createDataFrame([(f"p{i % 60}", i) for i in range(600)] + [("p0", 1)] * 300 + [(None, 2)] * 5, "pid string, n int")
    return parent, child


def test_key_reports_from_stored_counts_need_no_shuffle(spark, base, no_broadcast):
    parent, child = keyed(spark)
    keys = KeyCounts(spark, base, buckets=4)
    pk = keys.pk_check(parent, "parent", ["id"])
    fk = keys.fk_check(child, "pid", parent, "id", "child", "parent")
    assert pk.collect() == pk_check(parent, "parent", ["id"]).collect()
    assert fk.collect() == fk_check(child, "pid", parent, "id", "child", "parent").collect()
    assert fk.first().orphan_rows == 100 and pk.first().duplicate_key_rows == 1 and pk.first().null_key_rows == 1
    assert "hashpartitioning" not in plan(pk) and "hashpartitioning" not in plan(fk) and "SortMergeJoin" in plan(fk)


def test_key_counts_are_written_once(spark, base):
    parent, _ = keyed(spark)
    keys = KeyCounts(spark, base, buckets=2)
    first = keys.of(parent, "parent", ["id"]).inputFiles()
    assert first and sorted(keys.of(parent, "parent", ["id"]).inputFiles()) == sorted(first)
    empty = keys.pk_check(parent.limit(0), "none", ["id"]).first()
    assert (empty.rows, empty.distinct_keys, empty.null_key_rows) == (0, 0, 0)


def facts(spark):
    day = F.expr("date_add(DATE '2020-01-01', CAST(id % 900 AS INT))")
    return spark.range(5_000).select(F.col("id").cast("string").alias("order_id"), F.date_format(day, "yyyyMMdd").cast("int").alias("purchase_date_key"))


def calendar(spark, base):
    day = F.expr("date_add(DATE '2020-01-01', CAST(id AS INT))")
    write_table(spark.range(900).select(F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"), F.quarter(day).alias("quarter")), f"{base}/t/cal")
    return open_table(spark, f"{base}/t/cal")


def test_months_prune_by_range_and_by_calendar(spark, base):
    fact = write_by_month(facts(spark), f"{base}/t/fact", splits=2)
    assert fact.count() == 5_000 and fact.select("order_id").distinct().count() == 5_000
    ranged = in_months(fact, "2020-03", "2020-05")
    assert ranged.count() == facts(spark).filter("purchase_date_key BETWEEN 20200301 AND 20200531").count()
    assert "PartitionFilters: [isnotnull(purchase_month" in plan(ranged)
    joined = on_dates(fact, calendar(spark, base).filter("quarter = 4"))
    assert "dynamicpruningexpression(purchase_month" in plan(joined)
    assert joined.count() == facts(spark).filter("purchase_date_key DIV 100 % 100 >= 10").count()
    files = {f.rsplit("/", 2)[1]: 0 for f in fact.inputFiles()}
    assert len(files) == 30 and len(fact.inputFiles()) <= 60


def frame(spark, n):
    return spark.createDataFrame([(n,)], "x int")


def test_a_run_is_published_as_a_whole(spark, base):
    with pytest.raises(FileNotFoundError):
        open_run(spark, base)
    for n in (1, 2):
        staged = {f"{base}/gold/{t}": stage_table(frame(spark, n), f"{base}/gold/{t}")[1] for t in ("a", "b")}
        if n == 2:  # staged and not published: nobody sees it
            assert {t: df.first().x for t, df in open_run(spark, base).items()} == {"gold/a": 1, "gold/b": 1}
        publish_run(spark, base, staged)
        assert {t: df.first().x for t, df in open_run(spark, base).items()} == {"gold/a": n, "gold/b": n}
        assert open_table(spark, f"{base}/gold/b").first().x == n
    write_table(frame(spark, 3), f"{base}/gold/a")  # a table of its own, later
    assert open_table(spark, f"{base}/gold/a").first().x == 3 and open_table(spark, f"{base}/gold/b").first().x == 2
    with pytest.raises(ValueError, match="tables of a run"):
        publish_run(spark, base, {f"{base}/elsewhere/gold/a": "v"})


def test_retired_versions_go_and_readers_keep_the_newest(spark, base):
    path = f"{base}/gold/t"
    assert retire_versions(spark, path) == []
    for n in range(4):
        write_table(frame(spark, n), path)
    staged = stage_table(frame(spark, 9), path)[0]  # a writer at work
    newest = current_version(spark, path)
    assert len(retire_versions(spark, path, keep=2)) == 2 and retire_versions(spark, path, keep=2) == []
    assert current_version(spark, path) == newest and open_table(spark, path).first().x == 3 and staged.first().x == 9
    with pytest.raises(ValueError):
        retire_versions(spark, path, keep=0)


def test_old_files_fail_a_run(spark, base):
    frame(spark, 1).write.parquet(f"{base}/t")
    report = file_freshness({"t": spark.read.parquet(f"{base}/t")})
    assert_no_alerts(stale_files(report, max_hours=24), "files")
    later = F.lit(dt.datetime.now() + dt.timedelta(hours=50)).cast("timestamp")
    with pytest.raises(AssertionError, match="files"):
        assert_no_alerts(stale_files(report, max_hours=24, now=later), "files")
    none = report.withColumn("newest_file_at", F.lit(None).cast("timestamp"))
    assert stale_files(none, 24).first().alert


def test_spellings_are_counted_without_an_expand_over_the_points(spark):
    df = spark.createDataFrame([("1", "2", "A ", "x"), ("99", "2", "a", "x"), ("1", "999", None, None), (None, "bad", "b", "y")],
                               "lat string, lng string, city string, state string")
    got = domain_check(df, "lat", "lng", (0, 10, 0, 10), "city", "state")
    assert got.first()[:] == (2, 3, 2, 2) and "Expand" not in plan(got)
    assert domain_check(df.limit(0), "lat", "lng", (0, 10, 0, 10), "city", "state").first()[:] == (0, 0, 0, 0)


SMALL = "/root/testdata/sf0.001"


def test_a_table_is_written_when_it_is_asked_for(spark):
    from tessera.plans.stored import Stored
    s = Stored(spark, SMALL)
    assert set(s.need("dim_date")) == {"orders", "dim_date"}
    first = s.tables["orders"].inputFiles()
    facts = s.need("fact_order")
    assert set(facts) == {"orders", "dim_date", "customers", "order_items", "order_payments", "order_reviews", "reviews", "fact_order"}
    assert s.tables["orders"].inputFiles() == first and current_version(spark, f"{s.base}/gold/fact_order") is not None
    assert facts["fact_order"].count() == facts["orders"].count() > 0


def test_stored_tables_are_written_small(spark, base):
    key = F.sha2(F.col("id").cast("string"), 256).alias("k")
    rows = spark.range(20_000).select(key)
    rows.write.parquet(f"{base}/plain")
    size = {n: sum(r.length for r in spark.read.format("binaryFile").load(p).select("length").collect())
            for n, p in (("plain", f"{base}/plain/*.parquet"), ("stored", f"{base}/t/k/versions/*/*.parquet"))
            if n == "plain" or write_table(rows, f"{base}/t/k").count() == 20_000}
    assert size["stored"] < 0.6 * size["plain"]
