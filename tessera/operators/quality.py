"""Data quality: profiling (D1-D18), constraints (C1-C14), reconciliation.

Every report is one lazy DataFrame (no driver round trips, no
createDataFrame from collected rows). Multi-row reports over one table are
one aggregate pass unpivoted with ``inline``; reports over several tables
are unions of one-row aggregates. Joins against a parent happen after the
child side is aggregated to distinct keys, so a key holding a large share
of the rows is combined map-side first.
"""

from __future__ import annotations

from decimal import Decimal

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tessera.functions.columns import any_null, short_key
from tessera.operators.percentile import exact_percentile

# ---------------------------------------------------------------- constraints
# CHECK rules of the source system's DDL (a NULL result passes).
CHECKS: dict[str, list[tuple[str, str]]] = {
    "products": [("products_dimensions_non_negative",
                  "coalesce(weight_g, 0) >= 0 AND coalesce(length_cm, 0) >= 0 AND coalesce(height_cm, 0) >= 0 "
                  "AND coalesce(width_cm, 0) >= 0 AND coalesce(photos_qty, 0) >= 0")],
    "orders": [("orders_status_known",
                "order_status IN ('created', 'approved', 'invoiced', 'processing', 'shipped', 'delivered', "
                "'unavailable', 'canceled')")],
    "order_items": [("order_items_amounts_non_negative", "price >= 0 AND freight_value >= 0"),
                    ("order_items_sequence_positive", "order_item_id >= 1")],
    "order_payments": [("order_payments_amounts_non_negative",
                        "payment_value >= 0 AND coalesce(payment_installments, 0) >= 0"),
                       ("order_payments_sequence_positive", "payment_sequential >= 1")],
    "reviews": [("reviews_score_in_range", "review_score BETWEEN 1 AND 5")],
    "fact_order": [("fact_order_amounts_non_negative",
                    "item_value >= 0 AND freight_value >= 0 AND order_value >= 0"),
                   ("fact_order_review_score_in_range", "review_score IS NULL OR review_score BETWEEN 1 AND 5")],
    "fact_order_item": [("fact_order_item_amounts_non_negative", "item_value >= 0 AND freight_value >= 0")],
    "dim_customer": [("dim_customer_lifetime_non_negative", "lifetime_orders >= 1 AND lifetime_revenue >= 0")],
}


def rules_for(table: str, schema: StructType | None = None) -> list[tuple[str, Column]]:
    """CHECK rules plus NOT NULL rules (from the declared schema) as
    (name, passes) pairs; ``passes`` is never NULL."""
    out = [(name, F.coalesce(F.expr(sql), F.lit(True))) for name, sql in CHECKS.get(table, [])]
    if schema is not None:
        out += [(f"{f.name}_not_null", F.col(f.name).isNotNull()) for f in schema.fields if not f.nullable]
    return out


def violations(df: DataFrame, table: str, schema: StructType | None = None) -> DataFrame:
    """(table, rule, violations) for every rule, in one aggregate pass."""
    rules = rules_for(table, schema)
    if not rules:
        return df.sparkSession.createDataFrame([], "table string, rule string, violations bigint")
    agg = df.agg(*[F.count_if(~ok).alias(f"_v{i}") for i, (_, ok) in enumerate(rules)])
    rows = F.array(*[F.struct(F.lit(table).alias("table"), F.lit(name).alias("rule"),
                              F.col(f"_v{i}").alias("violations")) for i, (name, _) in enumerate(rules)])
    return agg.select(F.inline(rows))


def in_parts(df: DataFrame, keys: list[str]) -> DataFrame:
    """The same rows in two parts, those with all ``keys`` first. A join on the keys leaves out their NULLs, and Spark does so at the scan: beside
    such a join in one plan the first part is the join's own scan and shuffle, and only the NULLs are read once more. Keys that ``df`` does not have are left out."""
    keys = [k for k in keys if k in df.columns]
    if not keys:
        return df
    missing = any_null(keys)
    return df.filter(reduce(operator.and_, [F.col(k).isNotNull() for k in keys])).unionByName(df.filter(missing))


def enforce(df: DataFrame, table: str, schema: StructType | None = None) -> DataFrame:
    """Same rows and columns, but any violated rule raises while the plan runs.

    The test wraps the first column of the frame, so it is evaluated in the
    same pass as the write that consumes the frame.
    """
    rules = rules_for(table, schema)
    if not rules:
        return df
    ok = reduce(operator.and_, [c for _, c in rules])
    names = ", ".join(n for n, _ in rules)
    first = df.columns[0]
    guarded = F.when(ok, F.col(first)).otherwise(
        F.raise_error(F.lit(f"constraint violated on {table} (one of: {names})")))
    return df.withColumn(first, guarded)


def count_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rows): one row a key, counted map-side first."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


def all_text(df: DataFrame, columns: list[str]) -> bool:
    return all(df.schema[c].dataType == StringType() for c in columns)


def pk_check(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """(table, key, rows, distinct_keys, duplicate_key_rows, null_key_rows).
    Two partial aggregations; hot keys combine map-side."""
    return pk_report(count_rows(df, keys), table, keys)


def pk_report(counts: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """The row of ``pk_check`` from a table's ``count_rows``."""
    return counts.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(any_null(keys), F.col("rows"))), F.lit(0)).alias("null_key_rows"),
    ).select(F.lit(table).alias("table"), F.lit(", ".join(keys)).alias("key"), "rows", "distinct_keys",
             (F.col("rows") - F.col("distinct_keys")).alias("duplicate_key_rows"), "null_key_rows")


def fk_check(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str,
             child_name: str | None = None, parent_name: str | None = None) -> DataFrame:
    """(child, parent, child_rows, orphan_rows, distinct_orphan_values).

    NULL child values are not orphans. The child is reduced to
    (value, rows) before meeting the parent's distinct values, so the join
    is between two duplicate-free sets. NULLs are left out by the last aggregate: a filter
    would reach the child's scan, and a child of several parents would be worked out
    once for each, as its shuffles would not be the same any more. Text keys meet as ``short_key``.
    """
    if all_text(child, [child_col]) and all_text(parent, [parent_col]):
        child = child.select(short_key(child_col).alias(child_col))
        # no key is NULL after the filter; said so, the join asks no more of the parent's scan than other joins on the key do
        known = F.coalesce(short_key(parent_col), F.lit(b""))
        parent = parent.filter(F.col(parent_col).isNotNull()).select(known.alias(parent_col))
    return fk_report(count_rows(child, [child_col]), child_col, parent.select(parent_col).distinct(), parent_col,
                     child_name or "child", parent_name or "parent")


def fk_report(child_counts: DataFrame, child_col: str, parent_keys: DataFrame, parent_col: str,
              child_name: str, parent_name: str) -> DataFrame:
    """The row of ``fk_check`` from the child's ``count_rows`` and the parent's distinct keys."""
    c = child_counts.select(F.col(child_col).alias("k"), "rows")
    p = parent_keys.select(F.col(parent_col).alias("k")).withColumn("_hit", F.lit(True))
    orphan = F.col("_hit").isNull() & F.col("k").isNotNull()
    return c.join(p, "k", "left").agg(
        F.coalesce(F.sum(F.when(F.col("k").isNotNull(), F.col("rows"))), F.lit(0)).alias("child_rows"),
        F.coalesce(F.sum(F.when(orphan, F.col("rows"))), F.lit(0)).alias("orphan_rows"),
        F.count_if(orphan).alias("distinct_orphan_values"),
    ).select(F.lit(f"{child_name}.{child_col}").alias("child"), F.lit(f"{parent_name}.{parent_col}").alias("parent"),
             "child_rows", "orphan_rows", "distinct_orphan_values")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ------------------------------------------------------------- reconciliation
def reconcile_layers(silver: dict[str, DataFrame], gold: dict[str, DataFrame]) -> DataFrame:
    """Item value agrees across fact_order, fact_order_item and the
    silver source; lifetime revenue agrees with fulfilled order value.
    One row per check with ``ok``; totals are scalar aggregates."""
    fo, fi, dc = gold["fact_order"], gold["fact_order_item"], gold["dim_customer"]

    def total(col: str | Column) -> Column:
        return F.round(F.sum(col), 2).cast("decimal(22,2)")

    # both totals of fact_order in one row, so that it is worked out once
    fulfilled = total(F.when(F.col("is_fulfilled"), F.col("order_value")))
    of_orders = fo.agg(F.struct(total("item_value").alias("items"), fulfilled.alias("fulfilled")).alias("t")).scalar()
    item = fo.sparkSession.range(1).select(
        F.lit("item value: fact_order vs fact_order_item").alias("check"),
        of_orders["items"].alias("gold_order"),
        fi.agg(total("item_value")).scalar().alias("gold_item"),
        in_parts(silver["order_items"], ["order_id"]).agg(total("price")).scalar().alias("silver_source"))
    revenue = fo.sparkSession.range(1).select(
        F.lit("lifetime revenue: dim_customer vs fact_order").alias("check"),
        of_orders["fulfilled"].alias("gold_order"),
        dc.agg(total("lifetime_revenue")).scalar().alias("gold_item"),
        F.lit(None).cast("decimal(22,2)").alias("silver_source"))
    both = item.unionByName(revenue)
    agree = (F.col("gold_order") == F.col("gold_item")) & \
        (F.col("silver_source").isNull() | (F.col("silver_source") == F.col("gold_order")))
    return both.withColumn("ok", F.coalesce(agree, F.lit(False)))


#: (silver table, gold table, what one gold row stands for): equal counts, layer to layer.
ROW_COUNTS = (("orders", "fact_order", "order_id"), ("order_items", "fact_order_item", "order_id, order_item_id"),
              ("products", "dim_product", "product_id"), ("sellers", "dim_seller", "seller_id"),
              ("customers", "dim_customer", "customer_unique_id"))


def reconcile_rows(silver: dict[str, DataFrame], gold: dict[str, DataFrame]) -> DataFrame:
    """X2 (rows): per pair of layers, the silver table's distinct keys and the gold table's rows, with ``ok``."""
    out = []
    for source, target, key in ROW_COUNTS:
        keys = silver[source].groupBy(*key.split(", ")).agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("n"))
        out.append(keys.select(F.lit(f"{target} rows vs {source} keys").alias("check"), F.col("n").alias("silver_keys"),
                               gold[target].agg(F.count(F.lit(1))).scalar().alias("gold_rows")))
    return union_all(out).withColumn("ok", F.col("silver_keys") == F.col("gold_rows"))


def stale(report: DataFrame, max_days: int) -> DataFrame:
    """A freshness report with ``alert``: the source lags more than ``max_days``, or has no time at all."""
    return report.withColumn("alert", F.coalesce(F.col("days_behind") > max_days, F.lit(True)))


def stale_files(report: DataFrame, max_hours: float, now: Column | None = None) -> DataFrame:
    """X3 (files): a ``file_freshness`` report with ``hours_old`` and ``alert``: the newest file is older than ``max_hours`` at ``now``
    (the time of the query), or there is none."""
    age = F.unix_micros(now if now is not None else F.current_timestamp()) - F.unix_micros("newest_file_at")
    hours = F.floor(age / 3_600_000_000)
    return report.withColumn("hours_old", hours).withColumn("alert", F.coalesce(age > max_hours * 3_600_000_000, F.lit(True)))


def drifted(report: DataFrame, max_volume_pct: float, max_null_change: float) -> DataFrame:
    """A drift report with ``alert``: the month's rows or NULL rate moved by more than allowed."""
    moved = (F.abs("volume_drift_pct") > max_volume_pct) | (F.abs("null_rate_change") > max_null_change)
    return report.withColumn("alert", F.coalesce(moved, F.lit(False)))


def assert_no_alerts(report: DataFrame, name: str) -> None:
    """Fail the run if any row of a report has ``alert`` (reads the first ten of those rows)."""
    bad = report.filter("alert").drop("alert").limit(10).collect()
    if bad:
        raise AssertionError(f"{name}: {[r.asDict() for r in bad]}")


def assert_keys(pk_report: DataFrame, fk_report: DataFrame) -> None:
    """Fail the run on duplicate/NULL primary keys or orphan foreign keys
    (reads only the offending report rows: one per failing key)."""
    dup = pk_report.filter((F.col("duplicate_key_rows") > 0) | (F.col("null_key_rows") > 0)).select("table")
    orphans = fk_report.filter(F.col("orphan_rows") > 0).select(F.col("child").alias("table"))
    bad = [r["table"] for r in dup.unionByName(orphans).collect()]
    if bad:
        raise AssertionError(f"key constraints violated: {bad}")


def assert_reconciled(checks: DataFrame) -> None:
    """Fail the run when a reconciliation check disagrees (two rows read)."""
    bad = [r["check"] for r in checks.filter(~F.col("ok")).select("check").collect()]
    if bad:
        raise AssertionError(f"reconciliation failed: {bad}")


# ------------------------------------------------------------------ profiling
def source_columns(df: DataFrame) -> list[str]:
    """Columns of the source, without the '_'-prefixed lineage columns."""
    return [c for c in df.columns if not c.startswith("_")]


def shape(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows, source_columns, columns) for several tables."""
    return union_all([
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows",
            F.lit(len(source_columns(df))).alias("source_columns"),
            F.lit(", ".join(source_columns(df))).alias("columns"))
        for name, df in tables.items()])


def profile_columns(df: DataFrame, table: str, approx: bool = True, rsd: float = 0.02) -> DataFrame:
    """Per source column: rows, nulls, blanks, distinct, min/max length.

    ``approx=True``: one aggregate pass with a HyperLogLog per column
    (``approx_distinct``, relative SD ``rsd``; a few KB per column at any
    scale), unpivoted with ``inline``.
    ``approx=False``: exact ``distinct_values``. Cells are unpivoted to
    (column, value) and counted, and the counts of the distinct values are
    summed by column: only a value and one count are shuffled, and lengths are
    taken of distinct values. N distinct counts in one wide aggregate
    would be rewritten into an Expand of N rows x N columns per input row.
    """
    cols = source_columns(df)
    if not approx:
        cells = df.select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(cols)
        ])).alias("c")).select("c.i", "c.v")
        v, n = F.col("v"), F.col("n")
        values = cells.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))

        def rows_where(cond: Column) -> Column:
            return F.sum(F.when(cond, n).otherwise(F.lit(0)))

        per_col = values.groupBy("i").agg(
            F.sum("n").alias("rows"), rows_where(v.isNull()).alias("nulls"),
            rows_where(F.trim(v) == "").alias("blanks"), F.count("v").alias("distinct_values"),
            F.min(F.length(v)).alias("min_len"), F.max(F.length(v)).alias("max_len"))
        name = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("i") + 1)
        return per_col.select(F.lit(table).alias("table"), name.alias("column"), "rows", "nulls", "blanks",
                              "distinct_values", "min_len", "max_len")
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        col = F.col(c)
        aggs += [F.count_if(col.isNull()).alias(f"n{i}"),
                 F.count_if(F.trim(col) == "").alias(f"b{i}"),
                 F.approx_count_distinct(col, rsd).alias(f"d{i}"),
                 F.min(F.length(col)).alias(f"lo{i}"),
                 F.max(F.length(col)).alias(f"hi{i}")]
    rows = F.array(*[F.struct(F.lit(table).alias("table"), F.lit(c).alias("column"),
                              F.col("__rows").alias("rows"), F.col(f"n{i}").alias("nulls"),
                              F.col(f"b{i}").alias("blanks"), F.col(f"d{i}").alias("approx_distinct"),
                              F.col(f"lo{i}").alias("min_len"), F.col(f"hi{i}").alias("max_len"))
                     for i, c in enumerate(cols)])
    return df.agg(*aggs).select(F.inline(rows))


def key_check(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """D3: (table, key, rows, distinct_keys, duplicate_key_rows,
    null_key_rows, exact_duplicate_rows) in one plan: distinct (key, SHA-256 of the
    row) first (partial aggregate), then per key, then a global aggregate. Only
    keys and digests are shuffled, however wide the rows."""
    row = F.sha2(F.to_json(F.struct(*source_columns(df)), {"ignoreNullFields": "false"}), 256)
    distinct_rows = df.select(*keys, row.alias("_row")).groupBy(*keys, "_row").agg(F.count(F.lit(1)).alias("n"))
    per_key = distinct_rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("variants"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(any_null(keys), F.col("n"))), F.lit(0)).alias("null_key_rows"),
        F.coalesce(F.sum("variants"), F.lit(0)).alias("_distinct_rows"),
    ).select(F.lit(table).alias("table"), F.lit(", ".join(keys)).alias("key"), "rows", "distinct_keys",
             (F.col("rows") - F.col("distinct_keys")).alias("duplicate_key_rows"), "null_key_rows",
             (F.col("rows") - F.col("_distinct_rows")).alias("exact_duplicate_rows"))


def cast_check(df: DataFrame, table: str, types: dict[str, str], samples: int = 3) -> DataFrame:
    """Per column: failures (non-blank text that does not cast) and up
    to ``samples`` failing values, smallest first.

    Samples come from a bounded top-k (``row_number() <= samples`` per
    column after a distinct), never from an unbounded collect.
    """
    fails = [F.when(F.col(c).isNotNull() & (F.trim(F.col(c)) != "") & F.col(c).try_cast(t).isNull(),
                    F.col(c)) for c, t in types.items()]
    counts = df.agg(*[F.count(f).alias(f"f{i}") for i, f in enumerate(fails)]).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("target_type"), F.col(f"f{i}").alias("failures"))
        for i, (c, t) in enumerate(types.items())])))
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), f.alias("value"))
                                          for c, f in zip(types, fails)])).alias("p")) \
              .select("p.column", "p.value").filter(F.col("value").isNotNull()).distinct()
    w = Window.partitionBy("column").orderBy("value")
    top = (pairs.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= samples)
                .groupBy("column")
                .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_rn", "value"))),
                                              lambda s: s["value"]), ", ").alias("samples")))
    return counts.join(top, "column", "left").select(
        F.lit(table).alias("table"), "column", "target_type", "failures",
        F.coalesce("samples", F.lit("")).alias("samples"))


def null_matrix(df: DataFrame, by: str, cols: list[str], count_name: str = "rows") -> DataFrame:
    """Per value of ``by``: rows and how many have each column NULL."""
    return (df.groupBy(by).agg(F.count(F.lit(1)).alias(count_name),
                               *[F.count_if(F.col(c).isNull()).alias(f"no_{c}") for c in cols])
            .orderBy(F.col(count_name).desc(), F.col(by)))


def ordering_check(df: DataFrame, pairs: dict[str, tuple[str, str]], ts: str) -> DataFrame:
    """Count of rows where ``earlier`` > ``later`` per named pair (both
    parsed tolerantly), plus the first/last value of ``ts``."""
    def t(c):
        return F.col(c).try_cast("timestamp")
    return df.agg(*[F.count_if(t(later) < t(earlier)).alias(name) for name, (earlier, later) in pairs.items()],
                  F.min(t(ts)).alias("first_value"), F.max(t(ts)).alias("last_value"))


def volume_by_period(df: DataFrame, ts: str, fmt: str = "yyyy-MM", name: str = "orders") -> DataFrame:
    """Rows per period of ``ts`` (text parsed tolerantly)."""
    return (df.groupBy(F.date_format(F.col(ts).try_cast("timestamp"), fmt).alias("month"))
              .agg(F.count(F.lit(1)).alias(name)).orderBy("month"))


def count_histogram(df: DataFrame, key: str, size_name: str, count_name: str) -> DataFrame:
    """How many keys have 1, 2, ... rows."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(size_name))
              .groupBy(size_name).agg(F.count(F.lit(1)).alias(count_name)).orderBy(size_name))


def functional_dependency(df: DataFrame, key: str, attrs: dict[str, str], keys_name: str) -> DataFrame:
    """Keys, and how many keys see more than one value of each
    attribute. ``attrs`` maps output name -> attribute column; the special
    attribute ``*`` counts keys with more than one row."""
    per_key = df.groupBy(key).agg(  # more than one value: the least is not the greatest (NULLs count as none)
        *[(F.count(F.lit(1)) > 1 if a == "*" else F.min(a) != F.max(a)).alias(f"_{i}")
          for i, a in enumerate(attrs.values())])
    return per_key.agg(F.count(F.lit(1)).alias(keys_name),
                       *[F.count_if(f"_{i}").alias(name) for i, name in enumerate(attrs)])


def value_reconciliation(a: DataFrame, b: DataFrame, key: str, a_total: str, b_total: str,
                         tolerance: float = 0.01, approx: bool = True) -> DataFrame:
    """Compare two per-key totals (full outer join of two per-key
    aggregates). Keys missing on one side are counted, not matched."""
    j = a.join(b, key, "full_outer").withColumn("diff", F.col(b_total) - F.col(a_total))
    tol = F.lit(Decimal(str(tolerance)))
    if approx:
        pct = F.percentile_approx(F.abs("diff"), 0.99)
    else:  # differences have unbounded distinct values: distributed exact p99
        pct = exact_percentile(j.select(F.abs("diff").alias("d")), "d", 0.99, alias="p").scalar()
    return j.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.abs("diff") <= tol).alias("match"),
        F.count_if(F.col("diff") > tol).alias("paid_more_than_items"),
        F.count_if(F.col("diff") < -tol).alias("paid_less_than_items"),
        F.count_if(F.col(a_total).isNull()).alias("payments_but_no_items"),
        F.count_if(F.col(b_total).isNull()).alias("items_but_no_payments"),
        F.round(pct, 2).cast("double").alias("p99_abs_diff"))


def columns_within(tables: dict[str, DataFrame], bound: float = 0.05) -> DataFrame:
    """D2 both ways: the exact profile, and whether the one-pass sketch's distinct count is within ``bound`` (or 2)."""
    exact = union_all([profile_columns(df, t, approx=False) for t, df in tables.items()])
    sketch = union_all([profile_columns(df, t, approx=True).select("table", "column", "approx_distinct") for t, df in tables.items()])
    off = F.abs(F.col("approx_distinct") - F.col("distinct_values"))
    return exact.join(sketch, ["table", "column"]).select(
        *exact.columns, (off <= F.greatest(F.lit(2.0), F.col("distinct_values") * bound)).alias("approx_within_bound"))


def group_sizes_within(df: DataFrame, key: str, keys_name: str, bound: float = 0.05) -> DataFrame:
    """D13 both ways: the exact sizes, and whether the sketched median is within ``bound`` (or 1)."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    median, sketch = F.percentile(F.col("n").cast("double"), 0.5), F.percentile_approx("n", 0.5)
    return sizes.agg(F.count(F.lit(1)).alias(keys_name), F.min("n").alias("min_rows"), median.alias("median_rows"),
                     F.max("n").alias("max_rows"),
                     (F.abs(sketch - median) <= F.greatest(F.lit(1.0), median * bound)).alias("approx_within_bound"))


def group_size_stats(df: DataFrame, key: str, keys_name: str, approx: bool = True) -> DataFrame:
    """Keys and min/median/max rows per key."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    med = F.percentile_approx("n", 0.5) if approx else F.percentile(F.col("n").cast("double"), 0.5)
    return sizes.agg(F.count(F.lit(1)).alias(keys_name), F.min("n").alias("min_rows"),
                     med.alias("median_rows"), F.max("n").alias("max_rows"))


def domain_check(df: DataFrame, lat: str, lng: str, box: tuple[float, float, float, float],
                 city: str, state: str) -> DataFrame:
    """Points outside a (lat_min, lat_max, lng_min, lng_max) box, and raw vs. normalised spellings.

    The points are first brought to one row per (city, state), which is partly done before the shuffle; only those few
    rows are then spread over the three distinct counts."""
    la, lo = F.col(lat).try_cast("double"), F.col(lng).try_cast("double")
    lat_min, lat_max, lng_min, lng_max = box
    outside = (la < lat_min) | (la > lat_max) | (lo < lng_min) | (lo > lng_max)
    places = df.groupBy(F.col(city).alias("_city"), F.col(state).alias("_state")).agg(F.count_if(outside).alias("_out"))
    spellings = F.array(F.col("_city"), F.lower(F.trim("_city")), F.col("_state"))
    values = places.select("_out", F.posexplode(spellings).alias("_i", "_v")).groupBy("_i", "_v").agg(F.sum("_out").alias("_out"))

    def distinct(i: int) -> Column:
        return F.count_if((F.col("_i") == i) & F.col("_v").isNotNull())
    return values.agg(
        F.coalesce(F.sum(F.when(F.col("_i") == 2, F.col("_out"))), F.lit(0)).alias("outside_box"),
        distinct(0).alias("distinct_city_raw"), distinct(1).alias("distinct_city_normalised"), distinct(2).alias("distinct_states"))


def lookup_gaps(items: DataFrame, lookup: DataFrame, key: str, value: str) -> DataFrame:
    """Rows, rows without a key, keys without a lookup value, distinct
    keys. The lookup is deduped on its key first (no fan-out)."""
    lk = lookup.groupBy(key).agg(F.max(value).alias(value))
    j = items.select(key).join(lk, key, "left")
    return j.agg(F.count(F.lit(1)).alias("products"),
                 F.count_if(F.col(key).isNull()).alias("no_category"),
                 F.count_if(F.col(key).isNotNull() & F.col(value).isNull()).alias("category_without_translation"),
                 F.count_distinct(key).alias("distinct_categories"))


def volume_drift(df: DataFrame, ts: str, null_col: str, window: int = 3) -> DataFrame:
    """Rows per month against the average of the previous ``window``
    months, and the month's NULL rate of ``null_col`` with its change on the
    previous month. Windows run over months only (already aggregated)."""
    from tessera.functions.columns import exact_ratio
    monthly = (df.groupBy(F.date_format(F.col(ts).try_cast("timestamp"), "yyyy-MM").alias("month"))
                 .agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(null_col).isNull()).alias("_nulls")))
    prev = Window.orderBy("month").rowsBetween(-window, -1)
    ps, pn = F.sum("rows").over(prev), F.count("rows").over(prev)
    rate = exact_ratio("_nulls", "rows", 2, 100)
    return (monthly.select(
                "month", "rows",
                exact_ratio(ps, pn, 2).alias("prev_avg_rows"),
                exact_ratio(F.col("rows") * pn - ps, ps, 1, 100).alias("volume_drift_pct"),
                rate.alias("null_rate_pct"))
            .withColumn("null_rate_change", F.col("null_rate_pct") - F.lag("null_rate_pct").over(Window.orderBy("month")))
            .orderBy("month"))


def freshness(tables: dict[str, tuple[DataFrame, str]], as_of: str) -> DataFrame:
    """Per source, rows, the latest business timestamp and how many days
    it lags ``as_of`` (one-row aggregates, unioned)."""
    return union_all([
        df.agg(F.count(F.lit(1)).alias("rows"), F.max(F.col(ts).try_cast("timestamp")).alias("latest_at"))
          .select(F.lit(name).alias("source"), "rows", "latest_at",
                  F.datediff(F.lit(as_of).cast("date"), F.col("latest_at")).alias("days_behind"))
        for name, (df, ts) in tables.items()])


def file_freshness(frames: dict[str, DataFrame]) -> DataFrame:
    """X3 (files): per source, rows, files and the newest file's modification
    time, from the scan's hidden ``_metadata`` columns (no data columns read).
    ``frames`` must be plain file scans."""
    return union_all([
        df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_modification_time").alias("m"))
          .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("f").alias("files"),
               F.max("m").alias("newest_file_at"))
          .select(F.lit(name).alias("source"), "rows", "files", "newest_file_at")
        for name, df in frames.items()])
