"""One DuckDB SQL string per registered query."""

from oracle_sql.analytics import analytics_sql
from oracle_sql.quality import bronze_sql, constraint_sql
from oracle_sql.stored import stored_sql
from oracle_sql.views import with_ctes

SILVER = {
    "stg_geography": "s_geography",
    "stg_categories": "s_product_categories",
    "stg_customers": "s_customers",
    "stg_sellers": "s_sellers",
    "stg_products": "s_products",
    "stg_orders": "s_orders",
    "stg_order_items": "s_order_items",
    "stg_order_payments": "s_order_payments",
    "stg_reviews": "s_reviews",
    "stg_order_reviews": "s_order_reviews",
}
GOLD = ("dim_date", "dim_product", "dim_seller", "dim_customer", "fact_order", "fact_order_item",
        "dim_customer_history")


CORE = {
    "dedupe_line_items": """
        SELECT * FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_discount, l_extendedprice,
                 l_linestatus, l_partkey, l_quantity, l_returnflag, l_shipdate, l_suppkey, l_tax) = 1""",
    "text_clean": """
        SELECT doc_id, lang, NULLIF(trim(text), '') AS text, CAST(length(NULLIF(trim(text), '')) AS INTEGER) AS clean_chars
        FROM documents""",
    "surrogate_keys": """
        SELECT o_orderkey, c_custkey, sha256(concat_ws('||', CAST(c_custkey AS VARCHAR))) AS customer_key,
               sha256(concat_ws('||', c_mktsegment, CAST(c_nationkey AS VARCHAR))) AS segment_key,
               CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS order_date_key
        FROM customer JOIN orders ON c_custkey = o_custkey""",
}


#: Incremental forms end where the full builds do.
INCREMENTAL = {"x5_fact_order": "g_fact_order", "x5_dim_customer": "g_dim_customer", "x6_upsert_orders": "s_orders",
               "x7_history_merge": "g_dim_customer_history"}


def oracle_sql() -> dict[str, str]:
    out = dict(CORE)
    out.update({q: with_ctes(f"SELECT * FROM {cte}") for q, cte in SILVER.items()})
    out.update({t: with_ctes(f"SELECT * FROM g_{t}") for t in GOLD})
    out.update({q: with_ctes(f"SELECT * FROM {cte}") for q, cte in INCREMENTAL.items()})
    out.update(analytics_sql())
    out.update(bronze_sql())
    out.update(constraint_sql())
    out.update(stored_sql())
    return out
