"""Registry of every query: name -> (spark, sf_dir) -> DataFrame.

Each entry runs over the driver's full tables at ``sf_dir``; the plan holds
only the lineage the query needs (bronze views -> silver -> gold -> query).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.differences import row_differences
from tessera.operators.quality import reconcile_layers, reconcile_rows, union_all
from tessera.plans import analytics as A
from tessera.plans import core as C
from tessera.plans import incremental as I
from tessera.plans import profiling as P
from tessera.plans import stored as T
from tessera.plans.tables import GOLD_INPUTS, SILVER_INPUTS, RetailTables

Query = Callable[[SparkSession, str], DataFrame]

SILVER_NAMES = {
    "stg_geography": "geography",
    "stg_categories": "product_categories",
    "stg_customers": "customers",
    "stg_sellers": "sellers",
    "stg_products": "products",
    "stg_orders": "orders",
    "stg_order_items": "order_items",
    "stg_order_payments": "order_payments",
    "stg_reviews": "reviews",
    "stg_order_reviews": "order_reviews",
}


class _Both:
    """silver+gold lookup by bare table name."""

    def __init__(self, t: RetailTables):
        self.t = t

    def __getitem__(self, name: str) -> DataFrame:
        return self.t.silver(name) if name in SILVER_INPUTS else self.t.gold(name)


def _named(name: str, fn: Query) -> Query:
    fn.__name__ = name
    return fn


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "dedupe_line_items": C.dedupe_line_items,
        "text_clean": C.text_clean,
        "surrogate_keys": C.surrogate_keys,
    }
    for q, t in SILVER_NAMES.items():
        out[q] = _named(q, lambda spark, sf, t=t: RetailTables(spark, sf).silver(t))
    for t in GOLD_INPUTS:
        out[t] = _named(t, lambda spark, sf, t=t: RetailTables(spark, sf).gold(t))
    for q in A.QUERIES:
        out[q] = _named(q, lambda spark, sf, q=q: A.run(q, _Both(RetailTables(spark, sf))))
    for q, build in P.BRONZE_REPORTS.items():
        def run(spark, sf, build=build):
            t = RetailTables(spark, sf)
            return build(t.bronze, t.profiling_order_items)
        out[q] = _named(q, run)
    for q, build in P.CONSTRAINT_REPORTS.items():
        out[q] = _named(q, lambda spark, sf, build=build: build(_Both(RetailTables(spark, sf))))

    def files(spark, sf):
        from tessera.operators.quality import file_freshness
        report = file_freshness({t: spark.read.parquet(f"{sf}/{t}.parquet")
                               for t in ("orders", "lineitem", "customer", "supplier", "part", "nation")})
        return report.select("source", "rows", "files", F.col("newest_file_at").isNotNull().alias("dated"))
    out["dq_file_freshness"] = _named("dq_file_freshness", files)

    def recon(spark, sf):
        t = RetailTables(spark, sf)
        return reconcile_layers(t.all_silver(), t.all_gold())
    out["reconcile_layers"] = _named("reconcile_layers", recon)

    def recon_rows(spark, sf):
        t = RetailTables(spark, sf)
        return reconcile_rows(t.all_silver(), t.all_gold())
    out["reconcile_rows"] = _named("reconcile_rows", recon_rows)

    def differing(spark, sf):
        t = RetailTables(spark, sf)
        owed = t.silver("order_items").groupBy("order_id").agg(F.sum(F.col("price") + F.col("freight_value")).cast("decimal(12,2)").alias("total"))
        paid = t.silver("order_payments").groupBy("order_id").agg(F.sum("payment_value").cast("decimal(12,2)").alias("total"))
        head = ["order_id", "order_status", "purchased_at"]
        pairs = {"items and payments": (owed, paid),
                 "orders and fact_order": (t.silver("orders").select(*head), t.gold("fact_order").select(*head))}
        return union_all([row_differences(a, b, ["order_id"]).select(F.lit(name).alias("pair"), F.col("order_id").alias("key"), "left_rows",
                                                                     "right_rows", "difference") for name, (a, b) in pairs.items()])
    out["row_differences"] = _named("row_differences", differing)
    out |= I.QUERIES | T.QUERIES
    return out
