"""Key checks on stored, co-partitioned key counts.

The keys of a table are written once as one row a key with its number of rows, bucketed by the key. A primary key report reads
those rows without a shuffle, and a foreign key report joins two such tables bucket by bucket. One key
is one row however often it occurs, so a bucket cannot become hot, as it would if the facts themselves were bucketed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import short_key
from tessera.operators.quality import all_text, count_rows, fk_report, pk_report
from tessera.session import shuffles_freed, side_by_side
from tessera.sources.sinks import STORED

BUCKETS = 64


class KeyCounts:
    """Key counts below ``base``, each written the first time it is asked for and reused by every later report.
    ``buckets`` is the same for all of them: about one for 128 MB of the largest table's keys. As many as the session has shuffle
    partitions, and the counts are written as they are shuffled."""

    def __init__(self, spark: SparkSession, base: str, buckets: int = BUCKETS):
        self.spark, self.base, self.buckets = spark, base, buckets
        self._tables: dict[tuple[bool | str, ...], str] = {}

    def prepare(self, wanted: list[tuple[DataFrame, str, list[str]]], short: bool = True) -> None:
        """Write the counts of (frame, table, keys) that are not there yet, a few at once."""
        missing = {(short, table, *keys): (df, keys) for df, table, keys in wanted if (short, table, *keys) not in self._tables}
        with shuffles_freed(self.spark):
            self._tables |= side_by_side(self.spark, {at: lambda _, job=job: self._write(*job, short) for at, job in missing.items()})

    def _write(self, df: DataFrame, keys: list[str], short: bool) -> str:
        name = f"key_counts_{uuid.uuid4().hex}"
        rows = df.select(*[short_key(k).alias(k) if short and all_text(df, [k]) else F.col(k) for k in keys])
        (count_rows(rows, keys).repartition(self.buckets, *keys).write.format("parquet").options(**STORED, path=f"{self.base}/{name}")
         .bucketBy(self.buckets, *keys).sortBy(*keys).saveAsTable(name))
        return name

    def of(self, df: DataFrame, table: str, keys: list[str], short: bool = True) -> DataFrame:
        """(keys, rows) of ``df``, read from its bucketed table. Rows are counted map-side before anything is shuffled; a
        NULL key is a key. Text keys are stored as ``short_key``, unless ``short`` is False."""
        self.prepare([(df, table, keys)], short)
        return self.spark.table(self._tables[(short, table, *keys)])

    def pk_check(self, df: DataFrame, table: str, keys: list[str]) -> DataFrame:
        """``quality.pk_check`` from the stored counts."""
        return pk_report(self.of(df, table, keys), table, keys)

    def fk_check(self, child: DataFrame, child_col: str, parent: DataFrame, parent_col: str, child_name: str, parent_name: str) -> DataFrame:
        """``quality.fk_check`` from the stored counts of both sides: a join of equal buckets."""
        short = child.schema[child_col].dataType == parent.schema[parent_col].dataType
        return fk_report(self.of(child, child_name, [child_col], short), child_col, self.of(parent, parent_name, [parent_col], short), parent_col,
                         child_name, parent_name)
