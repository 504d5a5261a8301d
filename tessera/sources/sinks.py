"""Writers: schema-conforming replacement by versions with a drift guard and in-pass
constraint enforcement (IO4, IO7, IO9)."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tessera.operators.quality import enforce


class SchemaDriftError(TypeError):
    pass


def conform_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the target columns by name, in target order, with explicit
    casts (ANSI: an overflowing value raises). Text is never implicitly
    cast to another type, and a missing column is an error."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise SchemaDriftError(f"missing columns: {missing}")
    cols = []
    for f in schema.fields:
        src = df.schema[f.name].dataType
        c = F.col(f.name)
        if src != f.dataType:
            if isinstance(src, StringType):
                raise SchemaDriftError(f"{f.name}: refusing implicit cast of text to {f.dataType.simpleString()}")
            c = c.cast(f.dataType)
        cols.append(c.alias(f.name, metadata=f.metadata))
    return df.select(*cols)


def _absent(e: AnalysisException) -> bool:
    return e.getCondition() == "PATH_NOT_FOUND"


#: How tables are written: keys are long hexadecimal text, which zstd about halves and the default leaves as it is; a dictionary
#: of up to 8 MB a column keeps a key that comes again from being written again.
STORED = {"compression": "zstd", "parquet.dictionary.page.size": str(8 << 20)}

RUN_LOG = "table string, version string, published_at timestamp"


def _log(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A publication log; None where there is none.
    Any other failure to read (a permission, a broken file) is an error, not 'no log'."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if _absent(e):
            return None
        raise


def _split(path: str) -> tuple[str, str]:
    """('<base>', '<layer>/<table>') of a table's path."""
    base, _, name = path.rpartition("/")
    base, _, layer = base.rpartition("/")
    return base, f"{layer}/{name}"


def published_versions(spark: SparkSession, path: str) -> DataFrame | None:
    """(version, published_at) of the table at ``path``: published on its own, or by a run over the folder it is in. None before the first one."""
    base, table = _split(path)
    own = _log(spark, f"{path}/published", "version string, published_at timestamp")
    runs = _log(spark, f"{base}/runs", RUN_LOG)
    of_runs = None if runs is None else runs.filter(F.col("table") == table).select("version", "published_at")
    if own is None or of_runs is None:
        return of_runs if own is None else own
    return own.unionByName(of_runs)


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the version that readers of the table at ``path`` see; None before the first one."""
    log = published_versions(spark, path)
    newest = None if log is None else log.orderBy(F.desc("published_at"), F.desc("version")).first()
    return None if newest is None else f"{path}/versions/{newest.version}"


def open_table(spark: SparkSession, path: str) -> DataFrame:
    """The published version of the table at ``path``."""
    where = current_version(spark, path)
    if where is None:
        raise FileNotFoundError(f"no published version of {path}")
    return spark.read.parquet(where)


def open_run(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """'<layer>/<table>' -> the version that the newest run over ``base`` published: one read of the log, so never tables of two runs."""
    log = _log(spark, f"{base}/runs", RUN_LOG)
    if log is None:
        raise FileNotFoundError(f"no published run of {base}")
    newest = log.groupBy("published_at").agg(F.collect_list(F.struct("table", "version")).alias("tables")).orderBy(F.desc("published_at")).first()
    return {t.table: spark.read.parquet(f"{base}/{t.table}/versions/{t.version}") for t in newest.tables}


def existing_schema(spark: SparkSession, path: str) -> StructType | None:
    where = current_version(spark, path)
    return None if where is None else spark.read.parquet(where).schema


def _shape(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def stage_table(df: DataFrame, path: str, schema: StructType | None = None, table: str | None = None,
                sort_by: list[str] | None = None, partition_by: list[str] | None = None,
                allow_schema_change: bool = False) -> tuple[DataFrame, str]:
    """Write a new version of the Parquet table at ``path`` that no reader sees yet; returns it read
    back, and its name for ``publish``. A version that fails is never published, so the
    one before it stays as it is.

    * ``schema``: conform to it (and refuse to change the shape of an existing table unless
      ``allow_schema_change``).
    * ``table``: enforce that table's CHECK and NOT NULL rules in the same
      pass as the write (the write fails on a violation).
    * ``sort_by``: cluster rows inside each file (min/max statistics then
      prune row groups on those columns) without an extra shuffle.
    The returned frame reads the written files, so downstream plans start
    from storage (lineage is cut; a lost executor recomputes from files).
    """
    spark = df.sparkSession
    out = conform_to_schema(df, schema) if schema is not None else df
    if schema is not None and not allow_schema_change:
        old = existing_schema(spark, path)
        if old is not None and _shape(old) != _shape(out.schema):
            raise SchemaDriftError(f"{path}: existing shape {_shape(old)} differs from {_shape(out.schema)}")
    if table is not None:
        out = enforce(out, table, schema)
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    version = uuid.uuid4().hex
    writer = out.write.mode("error").format("parquet").options(**STORED)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{path}/versions/{version}")
    written = spark.read.schema(out.schema) if schema is not None else spark.read
    return written.parquet(f"{path}/versions/{version}"), version


def publish(spark: SparkSession, path: str, version: str) -> None:
    """Let readers of ``path`` see ``version``: one row appended to the table's publication log, which
    Spark commits as a whole or not at all. Earlier versions stay readable by their folder."""
    row = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("published_at"))
    row.coalesce(1).write.mode("append").parquet(f"{path}/published")


def publish_run(spark: SparkSession, base: str, staged: dict[str, str]) -> None:
    """Let readers see the versions of ``staged`` (path '<base>/<layer>/<table>' -> version), all of them or none: one file of a
    row a table appended to the log of runs."""
    rows = [(_split(path)[1], version) for path, version in staged.items()]
    if any(_split(path)[0] != base for path in staged):
        raise ValueError(f"tables of a run lie in {base}/<layer>/<table>: {sorted(staged)}")
    log = spark.createDataFrame(rows, "table string, version string").withColumn("published_at", F.current_timestamp())
    log.coalesce(1).write.mode("append").parquet(f"{base}/runs")


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of the store with all it holds; False if it was not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def retire_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete the folders of all published versions of the table at ``path`` but the newest ``keep`` (at least one); returns their names. A version
    that was never published is left alone: a writer may be at work on it. Readers of a retired version fail, so
    ``keep`` covers the longest read."""
    if keep < 1:
        raise ValueError("keep is at least 1")
    log = published_versions(spark, path)
    if log is None:
        return []
    names = [r.version for r in log.orderBy(F.desc("published_at"), F.desc("version")).select("version").collect()]
    kept = set(names[:keep])
    gone = []
    for name in dict.fromkeys(n for n in names[keep:] if n not in kept):
        if delete_folder(spark, f"{path}/versions/{name}"):
            gone.append(name)
    return gone


def write_table(df: DataFrame, path: str, schema: StructType | None = None, table: str | None = None,
                sort_by: list[str] | None = None, partition_by: list[str] | None = None,
                allow_schema_change: bool = False) -> DataFrame:
    """Replace the Parquet table at ``path`` (``stage_table``, then ``publish``) and return it read back."""
    written, version = stage_table(df, path, schema, table, sort_by, partition_by, allow_schema_change)
    publish(df.sparkSession, path, version)
    return written


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, quoted fields and doubled quotes (readable by ``read_bronze_csv``)."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", True).csv(path)


def register_tables(spark: SparkSession, layer: str, tables: dict[str, str]) -> None:
    """Expose the published versions in the catalog as ``<layer>.<name>`` (external
    Parquet tables), so they can be read with ``spark.table("gold.fact_order")`` or SQL. An entry that
    exists is moved to the new version's folder; the files are untouched."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    for name, path in tables.items():
        where = current_version(spark, path)
        if spark.catalog.tableExists(f"{layer}.{name}"):
            spark.sql(f"ALTER TABLE {layer}.{name} SET LOCATION '{where}'")
            spark.catalog.refreshTable(f"{layer}.{name}")
        else:
            spark.sql(f"CREATE TABLE {layer}.{name} USING parquet LOCATION '{where}'")
