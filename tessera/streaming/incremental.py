"""Incremental ingestion (X5) and upsert on key (X6) with Structured Streaming.

* ``ingest_files``: new CSV files in a folder -> an append-only bronze
  change log (Parquet file sink). The checkpoint plus the sink's commit log
  make it exactly-once: a restarted or retried run neither loses nor
  duplicates a file. ``availableNow`` processes what is there and stops, so
  the same code runs as a scheduled batch job or continuously.
* ``current_state``: upsert semantics on read - the latest version of every
  key, by load time then source file (a windowed top-1 per key, planned as
  a partial WindowGroupLimit before the shuffle).
* ``upsert_batch`` and ``upsert_stream``: the same, materialised by ``foreachBatch`` into a table of hash
  buckets; a batch that comes again changes nothing, and only touched buckets are rewritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tessera.operators.conform import dedupe
from tessera.sources.sinks import existing_schema, open_table, write_table
from tessera.streaming.batches import BatchStore


def text_schema(columns: list[str]) -> StructType:
    """All-string schema (bronze): streams need a declared schema."""
    return StructType([StructField(c, StringType(), True) for c in columns])


def ingest_files(spark: SparkSession, source_dir: str, columns: list[str], sink_path: str,
                 checkpoint_path: str, available_now: bool = True,
                 max_files_per_trigger: int | None = None, multi_line: bool = True) -> StreamingQuery:
    """Start the stream; returns the query (call ``awaitTermination()``). A file whose header is not
    ``columns`` in this order fails the query."""
    stream = read_changes(spark, source_dir, columns, max_files_per_trigger, multi_line)
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("path", sink_path).option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def current_state(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Latest row per key from an append-only change log (upsert on read): by load time, then source
    file, then every other column in name order, so that the winner does not depend on row order."""
    latest = ["_loaded_at", "_source_file"]
    rest = [c for c in sorted(changes.columns) if c not in (*keys, *latest)]
    return dedupe(changes, keys, [F.col(c).desc() for c in (*latest, *rest)])


def upsert(spark: SparkSession, changes: DataFrame, keys: list[str], path: str) -> DataFrame:
    """Merge ``changes`` into the table at ``path`` (X6): the latest row of every key over what is there and
    what is new becomes the table's next version, published when it is written in full."""
    old = existing_schema(spark, path)
    rows = changes if old is None else open_table(spark, path).unionByName(changes)
    return write_table(current_state(rows, keys), path, schema=old or changes.schema)


def upsert_batch(store: BatchStore, changes: DataFrame, batch_id: int, keys: list[str], name: str) -> None:
    """Merge one batch of changes into table ``name`` of ``store`` (X6): the winner of every key
    (``current_state``) over what its bucket holds and what is new. Buckets without a change keep their files; a batch
    id that was merged before changes nothing. NULL keys are a key."""
    batch = store.begin(batch_id)
    if batch.done:
        return
    new = current_state(changes, keys)  # a hot key is one row from here on
    touched = batch.touched(new, keys)
    old = batch.read(name, touched)
    rows = new if old is None else current_state(old.unionByName(new), keys)
    batch.stage(rows, name, keys, replaces=True, touched=touched)
    batch.commit()


def upsert_stream(changes: DataFrame, store: BatchStore, keys: list[str], name: str, checkpoint_path: str,
                  available_now: bool = True) -> StreamingQuery:
    """Start the upsert of a stream of changes (as ``ingest_files`` reads them: with ``_source_file`` and ``_loaded_at``); returns
    the query. After a crash between the merge and the stream's own commit the batch comes again under its id and is skipped."""
    writer = (changes.writeStream.option("checkpointLocation", checkpoint_path)
              .foreachBatch(lambda df, batch_id: upsert_batch(store, df, batch_id, keys, name)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_changes(spark: SparkSession, source_dir: str, columns: list[str], max_files_per_trigger: int | None = None,
                 multi_line: bool = True) -> DataFrame:
    """New CSV files in a folder as an all-text stream with file lineage and load time."""
    reader = (spark.readStream.schema(text_schema(columns))
              .option("header", True).option("enforceSchema", False)
              .option("multiLine", multi_line).option("escape", '"'))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (reader.csv(source_dir)
            .withColumn("_source_file", F.col("_metadata.file_path"))
            .withColumn("_loaded_at", F.current_timestamp()))
