"""Column profiles kept as mergeable sketches.

Each part of a table (a landed file, a month) is profiled once, when it arrives: one row a part and column, with counts,
a HyperLogLog of the values and a KLL of the numbers as columns. The profile of all data, or of any parts, is
a union of those rows: old files are not read again, and a month that comes in two files is simply two rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.quality import source_columns, union_all
from tessera.streaming.batches import BatchStore

LG_K = 13  # 2^13 registers a column: a relative standard deviation of 1.2 %
KLL_K = 400  # rank error of about 0.7 %
PROFILES = "profiles"
#: Every text that a cast to double takes, and few others. The cast throws (and catches) an error for each text that is no number, which
#: costs some 10 microseconds; most columns hold only such texts.
NUMERIC = (r"^[\x00-\x20]*[-+]?(?i:nan|inf|infinity|0x[0-9a-f.]+p[-+]?[0-9]+[fd]?"
           r"|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[-+]?[0-9]+)?[fd]?)[\x00-\x20]*$")


def sketch_parts(df: DataFrame, table: str, part: Column, columns: list[str] | None = None, lg_k: int = LG_K, kll_k: int = KLL_K) -> DataFrame:
    """(table, part, column, rows, nulls, blanks, min_len, max_len, distinct_sketch, value_sketch), one row for each part and
    column, from one pass over ``df``.

    A part is the text of ``part``; rows where it is NULL are the part ''. The sketches skip NULLs; ``value_sketch`` holds
    the values that can be read as numbers. Rows are combined map-side, so a part of any size
    costs a few KB a column in the shuffle. An empty table has no parts."""
    cols = columns or source_columns(df)
    rows = df.select(F.coalesce(part.cast("string"), F.lit("")).alias("_part"), *[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(cols)])
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i in range(len(cols)):
        c = F.col(f"c{i}")
        number = F.when(c.rlike(NUMERIC), c.try_cast("double"))
        aggs += [F.count_if(c.isNull()).alias(f"n{i}"), F.count_if(F.trim(c) == "").alias(f"b{i}"),
                 F.min(F.length(c)).alias(f"lo{i}"), F.max(F.length(c)).alias(f"hi{i}"),
                 F.hll_sketch_agg(c, F.lit(lg_k)).alias(f"d{i}"),
                 F.kll_sketch_agg_double(F.when(~F.isnan(number), number), F.lit(kll_k)).alias(f"v{i}")]
    per_column = F.array(*[F.struct(
        F.lit(table).alias("table"), F.col("_part").alias("part"), F.lit(c).alias("column"), F.col("_rows").alias("rows"),
        F.col(f"n{i}").alias("nulls"), F.col(f"b{i}").alias("blanks"), F.col(f"lo{i}").alias("min_len"), F.col(f"hi{i}").alias("max_len"),
        F.col(f"d{i}").alias("distinct_sketch"), F.col(f"v{i}").alias("value_sketch")) for i, c in enumerate(cols)])
    return rows.groupBy("_part").agg(*aggs).select(F.inline(per_column))


def merge_parts(parts: DataFrame, by: tuple[str, ...] = ("table", "column"), quantiles: tuple[float, ...] = (0.5, 0.99)) -> DataFrame:
    """The profile of all rows behind ``parts``: per table and column (or other ``by``) parts, rows, nulls, blanks, min_len, max_len,
    approx_distinct and approx_quantiles (the value at each rank of ``quantiles``; NULL for a column without numbers)."""
    merged = parts.groupBy(*by).agg(
        F.count_distinct("part").alias("parts"), *[F.sum(c).alias(c) for c in ("rows", "nulls", "blanks")],
        F.min("min_len").alias("min_len"), F.max("max_len").alias("max_len"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("approx_distinct"), F.kll_merge_agg_double("value_sketch").alias("_values"))
    ranks = F.array(*[F.lit(float(q)) for q in quantiles])
    found = F.when(F.kll_sketch_get_n_double("_values") > 0, F.kll_sketch_get_quantile_double("_values", ranks))
    return merged.withColumn("approx_quantiles", found).drop("_values")


def add_profiles(store: BatchStore, batch_id: int, arrived: dict[str, tuple[DataFrame, Column]]) -> None:
    """Profile what a batch brought, ``{table: (rows, part)}``, and keep it in ``store``. A batch that comes again changes nothing."""
    batch = store.begin(batch_id)
    if batch.done:
        return
    frames = [sketch_parts(df, table, part) for table, (df, part) in arrived.items()]
    batch.stage(union_all(frames), PROFILES, ["table", "part"])
    batch.commit()


def stored_profile(store: BatchStore, **options) -> DataFrame | None:
    """``merge_parts`` of all that ``store`` holds, read from the sketches alone; None before the first batch."""
    parts = store.read(PROFILES)
    return None if parts is None else merge_parts(parts, **options)


def candidate_keys(profile: DataFrame, least: float = 0.9) -> DataFrame:
    """The profile with ``candidate_key``: the column has no NULL or blank and at least ``least`` times as many values as rows, by the sketch."""
    full = (F.col("nulls") == 0) & (F.col("blanks") == 0)
    return profile.withColumn("candidate_key", full & (F.col("approx_distinct") >= F.col("rows") * least))
