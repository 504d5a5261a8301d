"""Declared schemas of the 16 silver and gold tables, with keys.

Types, nullability and column comments follow the source system's DDL.
``KEYS`` are the primary keys and ``FOREIGN_KEYS`` the references, both
checked (not merely declared) by ``tessera.operators.quality``.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

S, I, L, D, TS, B, DT = StringType(), IntegerType(), LongType(), DoubleType(), TimestampType(), BooleanType(), DateType()
M10, M12, SCORE = DecimalType(10, 2), DecimalType(12, 2), DecimalType(3, 2)


def _f(name: str, t: DataType, nullable: bool = True, comment: str | None = None) -> StructField:
    return StructField(name, t, nullable, {"comment": comment} if comment else {})


def _lineage() -> list[StructField]:
    return [_f("_source", S, False), _f("_loaded_at", TS, False)]


SCHEMAS: dict[str, StructType] = {
    "geography": StructType([
        _f("zip_code_prefix", S, False, "first five digits of the postal code; string keeps leading zeros"),
        _f("city", S, comment="most common city for the prefix"), _f("state", S),
        _f("latitude", D, comment="median of the geolocation points"), _f("longitude", D), *_lineage()]),
    "product_categories": StructType([
        _f("category_name", S, False), _f("category_name_english", S, comment="NULL when untranslated"),
        *_lineage()]),
    "customers": StructType([
        _f("customer_id", S, False, "one per order: an order-customer, not a person"),
        _f("customer_unique_id", S, False, "the person"), _f("zip_code_prefix", S, False), *_lineage()]),
    "sellers": StructType([_f("seller_id", S, False), _f("zip_code_prefix", S, False), *_lineage()]),
    "products": StructType([
        _f("product_id", S, False), _f("category_name", S), _f("name_length", I), _f("description_length", I),
        _f("photos_qty", I), _f("weight_g", I), _f("length_cm", I), _f("height_cm", I), _f("width_cm", I),
        *_lineage()]),
    "orders": StructType([
        _f("order_id", S, False), _f("customer_id", S, False), _f("order_status", S, False),
        _f("purchased_at", TS, False), _f("approved_at", TS), _f("delivered_to_carrier_at", TS),
        _f("delivered_to_customer_at", TS), _f("estimated_delivery_at", TS, comment="promised at purchase"),
        *_lineage()]),
    "order_items": StructType([
        _f("order_id", S, False), _f("order_item_id", I, False, "line sequence from 1"),
        _f("product_id", S, False), _f("seller_id", S, False), _f("shipping_limit_date", TS),
        _f("price", M10, False), _f("freight_value", M10, False), *_lineage()]),
    "order_payments": StructType([
        _f("order_id", S, False), _f("payment_sequential", I, False), _f("payment_type", S, False),
        _f("payment_installments", I), _f("payment_value", M10, False), *_lineage()]),
    "reviews": StructType([
        _f("review_id", S, False), _f("review_score", I, False), _f("review_comment_title", S),
        _f("review_comment_message", S), _f("created_at", TS), _f("answered_at", TS), *_lineage()]),
    "order_reviews": StructType([_f("review_id", S, False), _f("order_id", S, False), *_lineage()]),
    "dim_date": StructType([
        _f("date_key", I, False, "yyyyMMdd"), _f("date", DT, False), _f("year", I, False),
        _f("quarter", I, False), _f("month", I, False), _f("year_month", S, False),
        _f("week_of_year", I, False), _f("day_of_week", I, False, "1 = Sunday"),
        _f("day_name", S, False), _f("is_weekend", B, False)]),
    "dim_product": StructType([
        _f("product_key", S, False), _f("product_id", S, False),
        _f("category", S, comment="English, else original, else 'unknown'"), _f("category_portuguese", S),
        _f("weight_g", I), _f("photos_qty", I), _f("volume_cm3", L, comment="NULL if any side is missing")]),
    "dim_seller": StructType([
        _f("seller_key", S, False), _f("seller_id", S, False), _f("seller_city", S), _f("seller_state", S),
        _f("seller_zip_code_prefix", S)]),
    "dim_customer": StructType([
        _f("customer_key", S, False), _f("customer_unique_id", S, False), _f("customer_city", S),
        _f("customer_state", S), _f("customer_zip_code_prefix", S), _f("customer_latitude", D),
        _f("customer_longitude", D), _f("first_order_at", TS), _f("last_order_at", TS),
        _f("lifetime_orders", L, False, "all statuses"), _f("lifetime_fulfilled_orders", L, False),
        _f("lifetime_revenue", M12, False, "fulfilled orders only"), _f("is_repeat_customer", B, False)]),
    "fact_order": StructType([
        _f("order_id", S, False, "degenerate dimension"), _f("customer_key", S, False),
        _f("purchase_date_key", I, False), _f("purchased_at", TS, False), _f("order_status", S, False),
        _f("is_fulfilled", B, False), _f("item_value", M12, False), _f("freight_value", M12, False),
        _f("order_value", M12, False), _f("amount_paid", M12), _f("item_count", I, False),
        _f("distinct_product_count", I, False), _f("distinct_seller_count", I, False),
        _f("primary_payment_type", S), _f("max_installments", I), _f("review_score", SCORE),
        _f("review_count", I, False), _f("delivery_days", I), _f("days_early", I),
        _f("is_late", B, comment="NULL, not false, when never delivered")]),
    "fact_order_item": StructType([
        _f("order_id", S, False), _f("order_item_id", I, False), _f("customer_key", S, False),
        _f("product_key", S, False), _f("seller_key", S, False), _f("purchase_date_key", I, False),
        _f("purchased_at", TS, False), _f("order_status", S, False), _f("is_fulfilled", B, False),
        _f("item_value", M12, False), _f("freight_value", M12, False), _f("gross_item_value", M12, False)]),
    "dim_customer_history": StructType([
        _f("customer_key", S, False), _f("customer_unique_id", S, False),
        _f("version", I, False, "1 = the first location"), _f("zip_code_prefix", S),
        _f("valid_from", TS, False), _f("valid_to", TS, comment="NULL for the current version"),
        _f("is_current", B, False), _f("orders_in_version", L, False)]),
}

KEYS: dict[str, list[str]] = {
    "geography": ["zip_code_prefix"], "product_categories": ["category_name"],
    "customers": ["customer_id"], "sellers": ["seller_id"], "products": ["product_id"],
    "orders": ["order_id"], "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"], "reviews": ["review_id"],
    "order_reviews": ["review_id", "order_id"], "dim_date": ["date_key"], "dim_product": ["product_key"],
    "dim_seller": ["seller_key"], "dim_customer": ["customer_key"], "fact_order": ["order_id"],
    "fact_order_item": ["order_id", "order_item_id"],
    "dim_customer_history": ["customer_key", "version"],
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("customers", "zip_code_prefix", "geography", "zip_code_prefix"),
    ("sellers", "zip_code_prefix", "geography", "zip_code_prefix"),
    ("products", "category_name", "product_categories", "category_name"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("order_payments", "order_id", "orders", "order_id"),
    ("order_reviews", "review_id", "reviews", "review_id"),
    ("order_reviews", "order_id", "orders", "order_id"),
    ("fact_order", "customer_key", "dim_customer", "customer_key"),
    ("fact_order", "purchase_date_key", "dim_date", "date_key"),
    ("fact_order_item", "customer_key", "dim_customer", "customer_key"),
    ("fact_order_item", "product_key", "dim_product", "product_key"),
    ("fact_order_item", "seller_key", "dim_seller", "seller_key"),
    ("fact_order_item", "purchase_date_key", "dim_date", "date_key"),
    ("dim_customer_history", "customer_key", "dim_customer", "customer_key"),
]

SILVER_ORDER = ["geography", "product_categories", "customers", "sellers", "products", "orders",
                "order_items", "order_payments", "reviews", "order_reviews"]
GOLD_ORDER = ["dim_date", "dim_product", "dim_seller", "fact_order", "dim_customer", "fact_order_item",
              "dim_customer_history"]
