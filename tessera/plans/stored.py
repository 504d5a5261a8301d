"""Reports and queries over tables that are written once: key checks on co-partitioned key counts, facts by month, profiles from sketches."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import exact_ratio
from tessera.operators.key_counts import KeyCounts
from tessera.operators.quality import union_all
from tessera.operators.running import running_totals, with_running
from tessera.operators.sketches import add_profiles, candidate_keys, stored_profile
from tessera.plans import analytics as A
from tessera.plans.pipeline import build_tables
from tessera.plans.tables import RetailTables
from tessera.session import scratch_path
from tessera.sources.months import in_months, on_dates, write_by_month
from tessera.sources.schemas import FOREIGN_KEYS, KEYS, SCHEMAS
from tessera.streaming.batches import BatchStore


class Stored:
    """Silver and gold of a data folder as written tables, and what is derived from them once. A table, and the tables it is built
    from, is written the first time it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.base = scratch_path(spark, f"stored-{uuid.uuid4().hex[:12]}")
        self.bronze = RetailTables(spark, sf_dir).all_bronze()
        self.tables: dict[str, DataFrame] = {}
        self.keys = KeyCounts(spark, f"{self.base}/keys", buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
        self._by_month: DataFrame | None = None

    def need(self, *names: str) -> dict[str, DataFrame]:
        """The written tables, at least the named ones."""
        self.tables |= build_tables(self.bronze, self.base, set(names), self.tables)
        return self.tables

    def orders_by_month(self) -> DataFrame:
        if self._by_month is None:
            self._by_month = write_by_month(self.need("fact_order")["fact_order"], f"{self.base}/months/fact_order", splits=1)
        return self._by_month


_STORED: dict[tuple[str, str], Stored] = {}  # written once a session and data folder


def stored(spark: SparkSession, sf_dir: str) -> Stored:
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _STORED:
        _STORED[at] = Stored(spark, sf_dir)
    return _STORED[at]


def dq_pk_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every primary key, checked on stored key counts."""
    s = stored(spark, sf_dir)
    tables = s.need(*SCHEMAS)
    s.keys.prepare([(tables[n], n, KEYS[n]) for n in SCHEMAS])
    return union_all([s.keys.pk_check(tables[n], n, KEYS[n]) for n in SCHEMAS])


def dq_fk_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every foreign key, checked on stored key counts."""
    s = stored(spark, sf_dir)
    tables = s.need(*SCHEMAS)
    s.keys.prepare([(tables[n], n, [key]) for c, cc, p, pc in FOREIGN_KEYS for n, key in ((c, cc), (p, pc))])
    return union_all([s.keys.fk_check(tables[c], cc, tables[p], pc, c, p) for c, cc, p, pc in FOREIGN_KEYS])


def q2_monthly_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 on facts by month."""
    s, p = stored(spark, sf_dir), A.DEFAULT
    return A.monthly_revenue(in_months(s.orders_by_month(), p.month_from, p.month_to), s.need("dim_date")["dim_date"], p)


def q2_fourth_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fulfilled orders and revenue of each month of the fourth quarters, which the calendar names."""
    s = stored(spark, sf_dir)
    dates = s.need("dim_date")["dim_date"].filter(F.col("quarter") == 4).select("date_key", "year_month")
    return (on_dates(s.orders_by_month().filter("is_fulfilled"), dates).groupBy(F.col("year_month").alias("month"))
            .agg(F.count(F.lit(1)).alias("orders"), F.sum("order_value").cast("decimal(22,2)").alias("revenue")))


def w6_customer_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's share of all revenue, and that of all customers who spent as much or more."""
    people = stored(spark, sf_dir).need("dim_customer")["dim_customer"].select("customer_unique_id", "lifetime_revenue")
    both = with_running(people, "lifetime_revenue", "lifetime_revenue", descending=True)
    return both.select("customer_unique_id", "lifetime_revenue", F.col("running").cast("decimal(22,2)").alias("running_revenue"),
                       exact_ratio("lifetime_revenue", "total", 4, 100).alias("pct_of_revenue"),
                       exact_ratio("running", "total", 2, 100).alias("cumulative_pct"))


def w6_daily_running_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fulfilled revenue of each day and up to it."""
    days = running_totals(stored(spark, sf_dir).need("fact_order")["fact_order"].filter("is_fulfilled"), "purchase_date_key", "order_value")
    return days.select("purchase_date_key", F.col("rows").alias("orders"), F.col("sum").cast("decimal(22,2)").alias("revenue"),
                       F.col("running").cast("decimal(22,2)").alias("running_revenue"))


#: Bronze table -> the time that says which month a row belongs to.
DATED = {"orders": "order_purchase_timestamp", "order_items": "shipping_limit_date", "order_reviews": "review_creation_date"}


def dq_columns_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The column profile from one stored sketch row a month and column; the months come in two batches, one of them twice."""
    t = RetailTables(spark, sf_dir)
    store = BatchStore(spark, scratch_path(spark, f"profiles-{uuid.uuid4().hex[:12]}"), buckets=4, splits=1)
    for batch in (0, 1, 1):
        arrived = {}
        for table, ts in DATED.items():
            month = F.date_format(F.col(ts).try_cast("timestamp"), "yyyy-MM")
            arrived[table] = (t.bronze(table).filter(F.crc32(F.coalesce(month, F.lit("")).cast("binary")) % 2 == batch), month)
        add_profiles(store, batch, arrived)
    return candidate_keys(stored_profile(store)).select("table", "column", "parts", "rows", "nulls", "blanks", "min_len", "max_len", "candidate_key")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    dq_pk_stored, dq_fk_stored, q2_monthly_stored, q2_fourth_quarters, w6_customer_concentration, w6_daily_running_revenue, dq_columns_stored)}
