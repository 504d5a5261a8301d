"""Lazily built, memoized retail tables over the driver data.

``RetailTables(spark, sf_dir)`` builds a bronze, silver or gold table only
when asked, and only from the tables it depends on, so a query's plan
contains just its own lineage. Nothing is computed here: every table is a
lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.operators import gold as G
from tessera.operators import silver as S
from tessera.sources import retail_views as RV

# silver table -> (builder, bronze inputs)
SILVER_INPUTS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "geography": (S.build_geography, ("customers", "sellers", "geolocation")),
    "product_categories": (S.build_product_categories, ("products", "product_category_translation")),
    "customers": (S.build_customers, ("customers",)),
    "sellers": (S.build_sellers, ("sellers",)),
    "products": (S.build_products, ("products",)),
    "orders": (S.build_orders, ("orders",)),
    "order_items": (S.build_order_items, ("order_items",)),
    "order_payments": (S.build_order_payments, ("order_payments",)),
    "reviews": (S.build_reviews, ("order_reviews",)),
    "order_reviews": (S.build_order_reviews, ("order_reviews",)),
}

# gold table -> (builder, inputs as "layer:table")
GOLD_INPUTS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "dim_date": (G.build_dim_date, ("silver:orders",)),
    "dim_product": (G.build_dim_product, ("silver:products", "silver:product_categories")),
    "dim_seller": (G.build_dim_seller, ("silver:sellers", "silver:geography")),
    "fact_order": (G.build_fact_order, ("silver:orders", "silver:customers", "silver:order_items",
                                        "silver:order_payments", "silver:order_reviews", "silver:reviews")),
    "dim_customer": (G.build_dim_customer, ("silver:customers", "silver:orders", "silver:geography",
                                            "gold:fact_order")),
    "fact_order_item": (G.build_fact_order_item, ("silver:order_items", "silver:orders", "silver:customers")),
    "dim_customer_history": (G.build_dim_customer_history, ("silver:customers", "silver:orders")),
}


class RetailTables:
    """Memoized lazy tables. ``overrides`` maps "layer:table" to an existing
    DataFrame (e.g. a table read back from storage)."""

    def __init__(self, spark: SparkSession, sf_dir: str, loaded_at: str = RV.LOADED_AT,
                 overrides: dict[str, DataFrame] | None = None):
        self.spark, self.sf_dir, self.loaded_at = spark, sf_dir, loaded_at
        self._memo: dict[str, DataFrame] = dict(overrides or {})

    def _get(self, key: str, build: Callable[[], DataFrame]) -> DataFrame:
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def bronze(self, name: str) -> DataFrame:
        return self._get(f"bronze:{name}",
                         lambda: RV.BUILDERS[name](self.spark, self.sf_dir, self.loaded_at))

    def profiling_order_items(self) -> DataFrame:
        return self._get("bronze:order_items_profiling",
                         lambda: RV.bronze_order_items(self.spark, self.sf_dir, self.loaded_at, profiling=True))

    def silver(self, name: str) -> DataFrame:
        fn, inputs = SILVER_INPUTS[name]
        return self._get(f"silver:{name}", lambda: fn(*[self.bronze(b) for b in inputs]))

    def gold(self, name: str) -> DataFrame:
        fn, inputs = GOLD_INPUTS[name]
        return self._get(f"gold:{name}", lambda: fn(*[self.table(i) for i in inputs]))

    def table(self, key: str) -> DataFrame:
        layer, name = key.split(":")
        return {"bronze": self.bronze, "silver": self.silver, "gold": self.gold}[layer](name)

    def all_bronze(self) -> dict[str, DataFrame]:
        return {n: self.bronze(n) for n in RV.BRONZE_TABLES}

    def all_silver(self) -> dict[str, DataFrame]:
        return {n: self.silver(n) for n in SILVER_INPUTS}

    def all_gold(self) -> dict[str, DataFrame]:
        return {n: self.gold(n) for n in GOLD_INPUTS}
