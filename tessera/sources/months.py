"""Facts laid out by month of purchase (P11, Q2): a filter on months, or on the calendar, opens only those folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.sinks import write_table

MONTH = "purchase_month"  # yyyyMM


def _month(date_key: str) -> Column:
    return F.floor(F.col(date_key) / 100).cast("int")


def write_by_month(fact: DataFrame, path: str, splits: int = 8, spread_by: str = "order_id") -> DataFrame:
    """Replace the table at ``path`` by ``fact`` in one folder a month, and return it read back with the column ``purchase_month``.

    A month's rows are dealt to ``splits`` tasks, so files, by a hash of ``spread_by``: a month that holds a third of
    all rows is still written by ``splits`` tasks, and a small one makes at most ``splits`` files. Rows are sorted by date within a file."""
    salt = F.pmod(F.xxhash64(spread_by), F.lit(splits))
    dealt = fact.withColumn(MONTH, _month("purchase_date_key")).repartition(F.col(MONTH), salt)
    return write_table(dealt, path, sort_by=[MONTH, "purchase_date_key"], partition_by=[MONTH])


def in_months(fact: DataFrame, first: str, last: str) -> DataFrame:
    """Rows of a table by month, from month ``first`` to ``last`` (yyyy-MM). Other months' folders are not listed for reading."""
    lo, hi = (int(m.replace("-", "")) for m in (first, last))
    return fact.filter(F.col(MONTH).between(lo, hi))


def on_dates(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """A table by month joined to the (filtered) rows of the calendar. The month is part of the join, so Spark reads only the
    months that the calendar's filter leaves, which it knows when the query runs."""
    calendar = dates.withColumn(MONTH, _month("date_key")).withColumnRenamed("date_key", "purchase_date_key")
    return fact.join(calendar, [MONTH, "purchase_date_key"])
