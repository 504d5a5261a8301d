import os
import uuid

import pytest
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir
from tessera.sources.bronze import land, read_bronze_csv
from tessera.sources.schemas import SCHEMAS
from tessera.sources.sinks import (
    SchemaDriftError,
    conform_to_schema,
    open_table,
    register_tables,
    stage_table,
    write_table,
)


def _dir(spark, name):
    return os.path.join(checkpoint_dir(spark).replace("file:", ""), f"test-{name}-{uuid.uuid4().hex[:8]}")


def test_csv_quoted_line_break_and_doubled_quotes(spark):
    d = _dir(spark, "csv")
    os.makedirs(d)
    with open(f"{d}/reviews.csv", "w") as f:
        f.write('review_id,review_comment_message,review_score\n')
        f.write('r1,"first line\nsecond ""quoted"" line",5\n')
        f.write('r2,,4\n')
    df = read_bronze_csv(spark, f"{d}/reviews.csv", loaded_at="2001-08-02 00:00:00")
    rows = {r.review_id: r for r in df.collect()}
    assert rows["r1"].review_comment_message == 'first line\nsecond "quoted" line'
    assert rows["r2"].review_comment_message is None
    assert rows["r1"].review_score == "5"  # everything is text in bronze
    assert rows["r1"]._source_file.endswith("reviews.csv")
    assert dict(df.dtypes)["_loaded_at"] == "timestamp"


def test_land_is_rerunnable_and_refuses_a_new_shape(spark):
    d = _dir(spark, "land")
    os.makedirs(d)
    with open(f"{d}/a.csv", "w") as f:
        f.write("x,y\n1,2\n")
    first = land(spark, {"a": f"{d}/a.csv"}, f"{d}/bronze", loaded_at="2001-08-02 00:00:00")["a"].collect()
    again = land(spark, {"a": f"{d}/a.csv"}, f"{d}/bronze", loaded_at="2001-08-02 00:00:00")["a"].collect()
    assert first == again and len(first) == 1
    with open(f"{d}/a.csv", "w") as f:
        f.write("x,z,w\n1,2,3\n")
    with pytest.raises(SchemaDriftError):
        land(spark, {"a": f"{d}/a.csv"}, f"{d}/bronze")


def test_conform_to_schema_refuses_text_to_number(spark):
    df = spark.createDataFrame([("r1", "5")], "review_id string, review_score string")
    with pytest.raises(SchemaDriftError):
        conform_to_schema(df.withColumn("review_comment_title", F.lit(None).cast("string")), SCHEMAS["reviews"])


def test_write_table_enforces_constraints_in_the_write(spark):
    d = _dir(spark, "sink")
    ok = spark.createDataFrame([("r1", 5)], "review_id string, review_score int")
    cols = ["review_comment_title", "review_comment_message", "created_at", "answered_at"]
    full = ok.select("*", *[F.lit(None).alias(c) for c in cols], F.lit("t").alias("_source"),
                     F.current_timestamp().alias("_loaded_at"))
    back = write_table(full, f"{d}/reviews", schema=SCHEMAS["reviews"], table="reviews")
    assert back.count() == 1 and back.columns == SCHEMAS["reviews"].fieldNames()
    bad = full.withColumn("review_score", F.lit(9))
    with pytest.raises(Exception):
        write_table(bad, f"{d}/reviews", schema=SCHEMAS["reviews"], table="reviews")
    # the table that could not be replaced is as it was, and its shape is still guarded
    assert open_table(spark, f"{d}/reviews").select("review_id", "review_score").collect() == [("r1", 5)]
    with pytest.raises(SchemaDriftError):
        write_table(ok, f"{d}/reviews", schema=ok.schema)
    write_table(full.withColumn("review_score", F.lit(4)), f"{d}/reviews", schema=SCHEMAS["reviews"], table="reviews")
    assert open_table(spark, f"{d}/reviews").first().review_score == 4


def test_catalog_name_moves_to_the_published_version(spark):
    d = _dir(spark, "cat")
    layer = f"layer_{uuid.uuid4().hex[:8]}"
    for value in (1, 2):
        write_table(spark.createDataFrame([(value,)], "x int"), f"{d}/t")
        register_tables(spark, layer, {"t": f"{d}/t"})
        assert spark.table(f"{layer}.t").collect() == [(value,)]
    staged, _ = stage_table(spark.createDataFrame([(3,)], "x int"), f"{d}/t")
    assert staged.collect() == [(3,)] and spark.table(f"{layer}.t").collect() == [(2,)]


@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_files_with_columns_in_another_order_are_refused(spark, multi_line):
    d = _dir(spark, "headers")
    os.makedirs(d)
    for name, head, row in (("a", "order_id,status", "o1,shipped"), ("b", "status,order_id", "shipped,o2")):
        with open(f"{d}/{name}.csv", "w") as f:
            f.write(f"{head}\n{row}\n")
    with pytest.raises(Exception, match="header"):
        read_bronze_csv(spark, d, multi_line=multi_line).collect()
    assert read_bronze_csv(spark, f"{d}/b.csv", multi_line=multi_line).first().order_id == "o2"


def test_plain_csv_is_cut_into_splits(spark):
    d = _dir(spark, "split")
    os.makedirs(d)
    with open(f"{d}/big.csv", "w") as f:
        f.write("x,y\n" + "1,2\n" * 60_000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        files = [read_bronze_csv(spark, f"{d}/big.csv", multi_line=m).select(F.spark_partition_id().alias("p")).distinct().count()
                 for m in (False, True)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert files[0] > 1 and files[1] == 1
