import uuid

from pyspark.sql import functions as F

from tessera.operators.sketches import add_profiles, candidate_keys, merge_parts, sketch_parts, stored_profile
from tessera.session import scratch_path
from tessera.streaming.batches import BatchStore

SCHEMA = "k string, v string, w string, _source_file string"


def rows(n, start=0):
    return [(f"k{i}", str(i % 500), None if i % 4 else "  ", f"f{i % 3}") for i in range(start, start + n)]


def store(spark):
    return BatchStore(spark, scratch_path(spark, f"sketch-{uuid.uuid4().hex[:8]}"), buckets=4, splits=1)


def by_column(profile):
    return {r.column: r for r in profile.collect()}


def test_merged_parts_equal_the_profile_of_all_rows(spark):
    df = spark.createDataFrame(rows(20_000), SCHEMA)
    got = by_column(merge_parts(sketch_parts(df, "t", F.col("_source_file"))))
    assert {c: (r.parts, r.rows, r.nulls, r.blanks, r.min_len, r.max_len) for c, r in got.items()} == {
        "k": (3, 20_000, 0, 0, 2, 6), "v": (3, 20_000, 0, 0, 1, 3), "w": (3, 20_000, 15_000, 5_000, 2, 2)}
    assert abs(got["k"].approx_distinct - 20_000) <= 1_000 and abs(got["v"].approx_distinct - 500) <= 25 and got["w"].approx_distinct == 1
    half, high = got["v"].approx_quantiles
    assert abs(half - 250) <= 15 and abs(high - 495) <= 15
    assert got["k"].approx_quantiles is None and got["w"].approx_quantiles is None


def test_batches_add_up_and_a_replay_changes_nothing(spark):
    s, part = store(spark), F.col("_source_file")
    assert stored_profile(s) is None
    first, second = spark.createDataFrame(rows(6_000), SCHEMA), spark.createDataFrame(rows(6_000, 3_000), SCHEMA)
    add_profiles(s, 0, {"t": (first, part)})
    for _ in range(2):
        add_profiles(s, 1, {"t": (second, part), "u": (first.select("k", "_source_file"), part)})
    got = {(r.table, r.column): r for r in stored_profile(s).collect()}
    assert set(got) == {("t", "k"), ("t", "v"), ("t", "w"), ("u", "k")}
    assert got["t", "k"].rows == 12_000 and got["t", "k"].parts == 3 and abs(got["t", "k"].approx_distinct - 9_000) <= 450
    keys = {(r.table, r.column): r.candidate_key for r in candidate_keys(stored_profile(s)).collect()}
    assert keys == {("t", "k"): False, ("t", "v"): False, ("t", "w"): False, ("u", "k"): True}


def test_the_profile_reads_sketches_only(spark, tmp_path):
    s = store(spark)
    spark.createDataFrame(rows(100), SCHEMA).write.parquet(str(tmp_path / "t"))
    add_profiles(s, 0, {"t": (spark.read.parquet(str(tmp_path / "t")), F.col("_source_file"))})
    files = stored_profile(s).inputFiles()
    assert files and all(s.base in f and str(tmp_path) not in f for f in files)


def test_nulls_empty_tables_and_numbers_that_are_none(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert sketch_parts(empty, "t", F.col("_source_file")).count() == 0
    odd = spark.createDataFrame([(None, "NaN", None, None), (None, "1e400", "", "f"), ("a", "x", "2.5", "f")], SCHEMA)
    got = by_column(merge_parts(sketch_parts(odd, "t", F.col("_source_file")), quantiles=(0.0, 1.0)))
    assert (got["k"].parts, got["k"].nulls, got["k"].approx_distinct) == (2, 2, 1)
    assert got["v"].approx_distinct == 3 and got["w"].approx_quantiles == [2.5, 2.5] and got["w"].blanks == 1
    by_month = merge_parts(sketch_parts(odd, "t", F.col("_source_file")), by=("table", "part", "column"))
    assert by_month.count() == 6


def test_every_text_that_casts_to_a_number_passes_the_guard(spark):
    from tessera.operators.sketches import NUMERIC
    texts = ["1", "-1.5", "+.5", "5.", "1e5", "1E-3", " 7 ", "\t8\n", "NaN", "nan", "-inf", "Infinity", "+INFINITY", "1.0f", "1D", "0x1p3", "0X1.8P-1",
             "+NaN", "o123", "2001-08-02 00:00:00", "", " ", "1 2", "e5", ".", "1e", "--1", "delivered", "12a", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select("t", F.col("t").try_cast("double").alias("d"), F.col("t").rlike(NUMERIC).alias("ok")).collect()
    assert [r.t for r in got if r.d is not None and not r.ok] == []
    assert [r.t for r in got if r.t is not None and r.d is None and r.ok] == []
