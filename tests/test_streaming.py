import os
import uuid

import pytest

from tessera.session import checkpoint_dir
from tessera.streaming.incremental import current_state, ingest_files, upsert


def test_incremental_ingest_exactly_once_and_upsert(spark):
    base = os.path.join(checkpoint_dir(spark).replace("file:", ""), f"stream-{uuid.uuid4().hex[:8]}")
    src, sink, ckpt = f"{base}/in", f"{base}/bronze", f"{base}/ckpt"
    os.makedirs(src)
    cols = ["order_id", "order_status"]
    with open(f"{src}/f1.csv", "w") as f:
        f.write("order_id,order_status\no1,created\no2,created\n")
    ingest_files(spark, src, cols, sink, ckpt).awaitTermination()
    # a re-run with nothing new adds nothing
    ingest_files(spark, src, cols, sink, ckpt).awaitTermination()
    assert spark.read.parquet(sink).count() == 2
    with open(f"{src}/f2.csv", "w") as f:
        f.write("order_id,order_status\no1,delivered\no3,created\n")
    ingest_files(spark, src, cols, sink, ckpt).awaitTermination()
    changes = spark.read.parquet(sink)
    assert changes.count() == 4
    state = {r.order_id: r.order_status for r in current_state(changes, ["order_id"]).collect()}
    assert state == {"o1": "delivered", "o2": "created", "o3": "created"}


def test_stream_refuses_another_column_order(spark):
    base = os.path.join(checkpoint_dir(spark).replace("file:", ""), f"stream-{uuid.uuid4().hex[:8]}")
    os.makedirs(f"{base}/in")
    with open(f"{base}/in/f.csv", "w") as f:
        f.write("order_status,order_id\nshipped,o1\n")
    with pytest.raises(Exception, match="(?i)header|STREAM_FAILED"):
        ingest_files(spark, f"{base}/in", ["order_id", "order_status"], f"{base}/out", f"{base}/ckpt").awaitTermination()


def test_winner_of_one_file_does_not_depend_on_row_order(spark):
    rows = [("k", str(i), "f", "2001-01-01") for i in range(6)]
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        df = spark.createDataFrame(order, "k string, v string, _source_file string, _loaded_at string").repartition(3)
        assert [r.v for r in current_state(df, ["k"]).collect()] == ["5"]


def test_upsert_replaces_and_adds_by_key(spark):
    path = os.path.join(checkpoint_dir(spark), f"upsert-{uuid.uuid4().hex[:8]}")
    schema = "k string, v string, _source_file string, _loaded_at timestamp"

    def batch(rows):
        return spark.createDataFrame(rows, schema)

    import datetime as dt
    one, two = dt.datetime(2001, 1, 1), dt.datetime(2001, 1, 2)
    upsert(spark, batch([("a", "1", "f1", one), ("b", "1", "f1", one)]), ["k"], path)
    out = upsert(spark, batch([("a", "2", "f2", two), ("c", "2", "f2", two), ("b", "0", "f0", dt.datetime(2000, 1, 1))]), ["k"], path)
    assert sorted((r.k, r.v) for r in out.collect()) == [("a", "2"), ("b", "1"), ("c", "2")]
