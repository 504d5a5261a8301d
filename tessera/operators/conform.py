"""Generic conforming operators (bronze -> silver building blocks).

* ``with_metadata``  stamp the lineage source
* ``dedupe``         one row per key, deterministic tie-break
* ``conform``        rename/cast projection -> dedupe -> stamp, driven by a spec
* ``majority``       most common attribute tuple per key
"""

from __future__ import annotations

import operator
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_metadata(df: DataFrame, source: str) -> DataFrame:
    """Add the ``_source`` lineage column."""
    return df.withColumn("_source", F.lit(source))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL equals NULL; the left side's key columns are kept."""
    names = {k: f"_r_{k}" for k in keys}
    other = right.withColumnsRenamed(names)
    match = reduce(operator.and_, [F.col(k).eqNullSafe(F.col(names[k])) for k in keys])
    return left.join(other, match, how).drop(*names.values())


def default_order(df: DataFrame, keys: list[str]) -> list[Column]:
    """Every non-key column, in name order, ascending, NULLs last."""
    return [F.col(c).asc_nulls_last() for c in sorted(df.columns) if c not in keys]


def dedupe(df: DataFrame, keys: list[str], order_by: list[Column] | None = None) -> DataFrame:
    """Keep one row per key; the first under ``order_by`` wins.

    NULL keys form one group. The ``row_number() = 1`` filter is planned as
    a partial WindowGroupLimit before the shuffle, so a key holding a large
    share of the rows is cut to one row per input partition map-side.
    """
    order = order_by if order_by is not None else default_order(df, keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


@dataclass(frozen=True)
class TableSpec:
    """How one bronze table conforms into one silver table.

    ``columns`` maps target name -> expression over the bronze columns, in
    target order. ``keys`` is the primary key used for dedupe.
    """

    name: str
    source: str
    columns: dict[str, Column]
    keys: list[str]
    order_by: list[Column] | None = field(default=None)


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Project with renames/casts, dedupe on the key, stamp lineage.

    Output columns: the spec's columns in order, then ``_source``, ``_loaded_at``.
    """
    renamed = df.select(*[expr.alias(name) for name, expr in spec.columns.items()],
                        F.col("_loaded_at"))
    out = with_metadata(dedupe(renamed, spec.keys, spec.order_by), spec.source)
    return out.select(*spec.columns.keys(), "_source", "_loaded_at")


def majority(df: DataFrame, key: str, attrs: list[str],
             extra: list[Column] | None = None) -> DataFrame:
    """Most common ``attrs`` tuple per ``key`` (resolved as a tuple, so the
    attributes stay consistent with each other).

    Ties go to the smallest tuple, NULLs last. ``extra`` aggregates are
    computed per (key, tuple) and kept for the winner. Counting is a
    partially aggregated groupBy, so a hot key is combined map-side.
    """
    counted = df.groupBy(key, *attrs).agg(F.count(F.lit(1)).alias("_n"), *(extra or []))
    order = [F.col("_n").desc()] + [F.col(a).asc_nulls_last() for a in attrs]
    return dedupe(counted, [key], order).drop("_n")
