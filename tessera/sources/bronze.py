"""Bronze landing: raw CSV files as all-string tables with lineage (IO1-IO5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.sinks import write_table


#: Tables whose text may hold line breaks; files of the others are split.
MULTI_LINE = ("order_reviews",)


def read_bronze_csv(spark: SparkSession, path: str, loaded_at: str | None = None, multi_line: bool = True) -> DataFrame:
    """Every column as STRING (names from the header, no inference); quoted
    fields may hold doubled quotes and, with ``multi_line``, line breaks (a file is then one
    split; without it a large file is cut into many). The header of every file must match
    the first one's: a file whose columns differ or stand in another order fails the read. Adds ``_source_file``
    (the file each row came from) and ``_loaded_at`` (one value per query,
    or the given literal)."""
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=multi_line, escape='"', enforceSchema=False)
    stamp = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    return df.withColumn("_source_file", F.col("_metadata.file_path")).withColumn("_loaded_at", stamp)


def land(spark: SparkSession, files: dict[str, str], base: str, loaded_at: str | None = None,
         multi_line: tuple[str, ...] = MULTI_LINE) -> dict[str, DataFrame]:
    """Land each ``table -> csv path`` as bronze Parquet at ``base/table``
    (one job per table, full overwrite, re-runnable). Returns the landed
    tables read back. A re-land with a different header fails instead of
    silently reshaping the table."""
    out = {}
    for table, path in files.items():
        df = read_bronze_csv(spark, path, loaded_at, table in multi_line)
        out[table] = write_table(df, f"{base}/{table}", schema=df.schema)
    return out
