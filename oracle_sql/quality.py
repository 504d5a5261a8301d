"""DuckDB SQL for the data-quality reports.

Bronze reports read string-level bronze CTEs (``bs_*``) that reproduce the
landed text exactly; constraint reports read the silver/gold CTEs.
"""

from oracle_sql.views import K, PURCHASED, STATUS, _days, _hours, _zip, with_ctes

V = "VARCHAR"
BRONZE_STR = {
    "bs_customers": """SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city,
                              customer_state FROM b_customers""",
    "bs_geolocation": f"""
        SELECT {_zip('c_nationkey')} AS geolocation_zip_code_prefix,
               CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS {V}) AS geolocation_lat,
               CAST(-CAST(c_acctbal AS DECIMAL(12,2)) AS {V}) AS geolocation_lng,
               c_mktsegment AS geolocation_city, n_name AS geolocation_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey, range(2) r(copy)
        WHERE c_nationkey % 7 <> 3 AND (copy = 0 OR c_custkey % 4 = 0)""",
    "bs_order_items": f"""
        SELECT 'o' || CAST(l_orderkey AS {V}) AS order_id, CAST(l_linenumber AS {V}) AS order_item_id,
               'p' || CAST(l_partkey AS {V}) AS product_id, 's' || CAST(l_suppkey AS {V}) AS seller_id,
               CAST(l_shipdate AS {V}) AS shipping_limit_date,
               CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS {V}) AS price,
               CAST(CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(10,2))
                    AS {V}) AS freight_value,
               l_orderkey
        FROM lineitem""",
    "bs_order_payments": f"""
        SELECT 'o' || CAST({K} AS {V}) AS order_id, CAST(seq AS {V}) AS payment_sequential,
               CASE WHEN seq = 2 THEN 'voucher' WHEN {K} % 4 = 0 THEN 'boleto' WHEN {K} % 4 = 1 THEN 'voucher'
                    ELSE 'credit_card' END AS payment_type,
               CAST(CASE WHEN seq = 2 THEN 1 ELSE {K} % 10 + 1 END AS {V}) AS payment_installments,
               CAST(CAST(CAST(o_totalprice AS DECIMAL(12,2))
                    * CASE WHEN seq = 2 THEN 0.40 WHEN {K} % 3 = 0 THEN 0.60 ELSE 1.00 END::DECIMAL(3,2)
                    AS DECIMAL(12,2)) AS {V}) AS payment_value
        FROM orders, range(1, 3) s(seq)
        WHERE {K} % 200 <> 7 AND (seq = 1 OR {K} % 3 = 0)""",
    "bs_order_reviews": f"""
        SELECT review_id, order_id, CAST(review_score AS {V}) AS review_score, review_comment_title,
               review_comment_message, CAST(created_at AS {V}) AS review_creation_date,
               CAST(answered_at AS {V}) AS review_answer_timestamp
        FROM b_order_reviews""",
    "bs_orders": f"""
        SELECT 'o' || CAST({K} AS {V}) AS order_id, 'oc' || CAST({K} AS {V}) AS customer_id,
               {STATUS} AS order_status,
               CAST({PURCHASED} AS {V}) AS order_purchase_timestamp,
               CAST(CASE WHEN ({STATUS}) <> 'canceled' THEN {PURCHASED} + {_hours(f'{K} % 6 + 1')} END AS {V})
                 AS order_approved_at,
               CAST(CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderdate + {_days('1')} + {_hours(f'{K} % 12')}
                    END AS {V}) AS order_delivered_carrier_date,
               CAST(CASE WHEN o_orderstatus = 'F' THEN o_orderdate
                    + {_days(f'2 + ({K} * 31) % 41 + CASE WHEN {K} % 37 = 0 THEN {K} % 60 ELSE 0 END')}
                    + {_hours(f'{K} % 24')} END AS {V}) AS order_delivered_customer_date,
               CAST(o_orderdate + {_days('25')} AS {V}) AS order_estimated_delivery_date
        FROM orders""",
    "bs_products": f"""
        SELECT 'p' || CAST(p_partkey AS {V}) AS product_id,
               CASE WHEN p_partkey % 50 <> 0 THEN lower(p_type) END AS product_category_name,
               CAST(length(p_name) AS {V}) AS product_name_lenght,
               CAST(length(p_name) + length(p_type) AS {V}) AS product_description_lenght,
               CAST(p_size % 6 AS {V}) AS product_photos_qty, CAST(p_size * 100 AS {V}) AS product_weight_g,
               CAST(p_size AS {V}) AS product_length_cm, CAST(p_size % 10 + 1 AS {V}) AS product_height_cm,
               CASE WHEN p_partkey % 20 <> 0 THEN '5' END AS product_width_cm
        FROM part""",
    "bs_sellers": "SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state FROM b_sellers",
    "bs_product_category_translation": """
        SELECT category_name AS product_category_name, category_name_english AS product_category_name_english
        FROM s_translation""",
}
BRONZE_COLUMNS = {
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
                  "customer_state"],
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city",
                    "geolocation_state"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
                    "freight_value"],
    "order_payments": ["order_id", "payment_sequential", "payment_type", "payment_installments",
                       "payment_value"],
    "order_reviews": ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
                      "review_creation_date", "review_answer_timestamp"],
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
               "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"],
    "products": ["product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
                 "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
                 "product_width_cm"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "product_category_translation": ["product_category_name", "product_category_name_english"],
}
DUCK_TYPES = {"timestamp": "TIMESTAMP", "int": "INTEGER", "double": "DOUBLE", "decimal(12,2)": "DECIMAL(12,2)"}


def _w(sql: str) -> str:
    extra = ",\n".join(f"{n} AS ({s}\n)" for n, s in BRONZE_STR.items())
    extra += ",\nbs_order_items_prof AS (SELECT * REPLACE (CASE WHEN l_orderkey % 97 = 0 THEN 'n/a' " \
             "ELSE price END AS price) FROM bs_order_items)"
    return with_ctes(sql, extra=extra)


def _t(table: str) -> str:
    return f"(SELECT {', '.join(BRONZE_COLUMNS[table])} FROM bs_{table})"


def _big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def bronze_sql() -> dict[str, str]:
    from tessera.plans.profiling import CASTS, FK_CHECKS, KEY_CHECKS  # the report configuration (data)
    q = {}
    q["dq_shape"] = " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS rows, {len(c)} AS source_columns, '{', '.join(c)}' AS columns "
        f"FROM {_t(t)}" for t, c in BRONZE_COLUMNS.items())
    parts = []
    for t, cols in BRONZE_COLUMNS.items():
        for c in cols:
            parts.append(
                f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", count(*) AS rows, "
                f"{_big(f'count_if({c} IS NULL)')} AS nulls, {_big(f'count_if(trim({c}) = {chr(39)}{chr(39)})')} AS blanks, "
                f"count(DISTINCT {c}) AS distinct_values, CAST(min(length({c})) AS INTEGER) AS min_len, "
                f"CAST(max(length({c})) AS INTEGER) AS max_len FROM {_t(t)}")
    q["dq_columns"] = " UNION ALL ".join(parts)
    parts = []
    for t, keys in KEY_CHECKS:
        k = ", ".join(keys)
        anynull = " OR ".join(f"{c} IS NULL" for c in keys)
        parts.append(
            f"SELECT '{t}' AS \"table\", '{k}' AS key, (SELECT count(*) FROM {_t(t)}) AS rows, "
            f"(SELECT count(*) FROM (SELECT DISTINCT {k} FROM {_t(t)})) AS distinct_keys, "
            f"(SELECT count(*) FROM {_t(t)}) - (SELECT count(*) FROM (SELECT DISTINCT {k} FROM {_t(t)})) "
            f"AS duplicate_key_rows, "
            f"(SELECT {_big(f'count_if({anynull})')} FROM {_t(t)}) AS null_key_rows, "
            f"(SELECT count(*) FROM {_t(t)}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {_t(t)})) "
            f"AS exact_duplicate_rows")
    q["dq_keys"] = " UNION ALL ".join(parts)
    parts = []
    for t, types in CASTS.items():
        src = "(SELECT * FROM bs_order_items_prof)" if t == "order_items" else _t(t)
        for c, typ in types.items():
            fail = f"({c} IS NOT NULL AND trim({c}) <> '' AND TRY_CAST({c} AS {DUCK_TYPES[typ]}) IS NULL)"
            parts.append(
                f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", '{typ}' AS target_type, "
                f"{_big(f'count_if({fail})')} AS failures, "
                f"COALESCE(array_to_string(list_slice(list_sort(list_distinct(list({c}) FILTER (WHERE {fail}))), 1, 3), "
                f"', '), '') AS samples FROM {src}")
    q["dq_casts"] = " UNION ALL ".join(parts)
    parts = []
    for c, cc, p, pc in FK_CHECKS:
        parts.append(
            f"SELECT '{c}.{cc}' AS child, '{p}.{pc}' AS parent, count(*) AS child_rows, "
            f"{_big('count_if(p.k IS NULL)')} AS orphan_rows, count(DISTINCT CASE WHEN p.k IS NULL THEN x.k END) "
            f"AS distinct_orphan_values "
            f"FROM (SELECT {cc} AS k FROM {_t(c)} WHERE {cc} IS NOT NULL) x "
            f"LEFT JOIN (SELECT DISTINCT {pc} AS k FROM {_t(p)}) p ON x.k = p.k")
    q["dq_fks"] = " UNION ALL ".join(parts)
    q["dq_null_matrix"] = f"""
        SELECT order_status, count(*) AS orders, {_big('count_if(order_approved_at IS NULL)')} AS no_approved_at,
               {_big('count_if(order_delivered_carrier_date IS NULL)')} AS no_carrier_date,
               {_big('count_if(order_delivered_customer_date IS NULL)')} AS no_delivered_date
        FROM {_t('orders')} GROUP BY order_status"""

    def ts(c):
        return f"TRY_CAST({c} AS TIMESTAMP)"
    q["dq_timeline"] = f"""
        SELECT {_big(f"count_if({ts('order_approved_at')} < {ts('order_purchase_timestamp')})")} AS approved_before_purchase,
               {_big(f"count_if({ts('order_delivered_customer_date')} < {ts('order_purchase_timestamp')})")}
                 AS delivered_before_purchase,
               {_big(f"count_if({ts('order_delivered_customer_date')} < {ts('order_delivered_carrier_date')})")}
                 AS delivered_before_carrier,
               min({ts('order_purchase_timestamp')}) AS first_purchase,
               max({ts('order_purchase_timestamp')}) AS last_purchase
        FROM {_t('orders')}"""
    q["dq_monthly_volume"] = f"""
        SELECT strftime({ts('order_purchase_timestamp')}, '%Y-%m') AS month, count(*) AS orders
        FROM {_t('orders')} GROUP BY 1"""
    q["dq_orders_per_customer"] = f"""
        SELECT orders_per_customer, count(*) AS customers
        FROM (SELECT customer_unique_id, count(*) AS orders_per_customer FROM {_t('customers')} GROUP BY 1)
        GROUP BY 1"""
    q["dq_attr_stability"] = f"""
        SELECT count(*) AS customers, {_big('count_if(z > 1)')} AS multiple_zips,
               {_big('count_if(s > 1)')} AS multiple_states
        FROM (SELECT customer_unique_id, count(DISTINCT customer_zip_code_prefix) AS z,
                     count(DISTINCT customer_state) AS s FROM {_t('customers')} GROUP BY 1)"""
    m = "TRY_CAST({} AS DECIMAL(12,2))"
    q["dq_reconcile"] = f"""
        SELECT count(*) AS orders, {_big('count_if(abs(diff) <= 0.01)')} AS match,
               {_big('count_if(diff > 0.01)')} AS paid_more_than_items,
               {_big('count_if(diff < -0.01)')} AS paid_less_than_items,
               {_big('count_if(items_total IS NULL)')} AS payments_but_no_items,
               {_big('count_if(payments_total IS NULL)')} AS items_but_no_payments,
               CAST(round(quantile_cont(CAST(abs(diff) AS DOUBLE), 0.99), 2) AS DOUBLE) AS p99_abs_diff
        FROM (SELECT i.items_total, p.payments_total, p.payments_total - i.items_total AS diff
              FROM (SELECT order_id, sum({m.format('price')} + {m.format('freight_value')}) AS items_total
                    FROM {_t('order_items')} GROUP BY 1) i
              FULL OUTER JOIN (SELECT order_id, sum({m.format('payment_value')}) AS payments_total
                               FROM {_t('order_payments')} GROUP BY 1) p ON i.order_id = p.order_id)"""
    q["dq_payment_mix"] = f"""
        SELECT payment_type, count(*) AS rows, count(DISTINCT order_id) AS orders,
               CAST(round(sum({m.format('payment_value')}), 2) AS DECIMAL(22,2)) AS total_value
        FROM {_t('order_payments')} GROUP BY 1"""
    q["dq_group_sizes"] = f"""
        SELECT count(*) AS zip_prefixes, min(n) AS min_rows, quantile_cont(CAST(n AS DOUBLE), 0.5) AS median_rows,
               max(n) AS max_rows
        FROM (SELECT geolocation_zip_code_prefix, count(*) AS n FROM {_t('geolocation')} GROUP BY 1)"""
    lat, lng = "TRY_CAST(geolocation_lat AS DOUBLE)", "TRY_CAST(geolocation_lng AS DOUBLE)"
    q["dq_domain"] = f"""
        SELECT {_big(f'count_if({lat} < -34.0 OR {lat} > 6.0 OR {lng} < -74.0 OR {lng} > -34.0)')} AS outside_box,
               count(DISTINCT geolocation_city) AS distinct_city_raw,
               count(DISTINCT lower(trim(geolocation_city))) AS distinct_city_normalised,
               count(DISTINCT geolocation_state) AS distinct_states
        FROM {_t('geolocation')}"""
    q["dq_attr_conflict"] = f"""
        SELECT count(*) AS prefixes, {_big('count_if(s > 1)')} AS prefixes_with_multiple_states
        FROM (SELECT geolocation_zip_code_prefix, count(DISTINCT geolocation_state) AS s
              FROM {_t('geolocation')} GROUP BY 1)"""
    q["dq_lookup_gaps"] = f"""
        SELECT count(*) AS products, {_big('count_if(p.product_category_name IS NULL)')} AS no_category,
               {_big('count_if(p.product_category_name IS NOT NULL AND t.e IS NULL)')} AS category_without_translation,
               count(DISTINCT p.product_category_name) AS distinct_categories
        FROM {_t('products')} p
        LEFT JOIN (SELECT product_category_name, max(product_category_name_english) AS e
                   FROM {_t('product_category_translation')} GROUP BY 1) t
          ON p.product_category_name = t.product_category_name"""
    q["dq_entity_dupes"] = f"""
        SELECT count(*) AS distinct_review_ids, {_big('count_if(r > 1)')} AS review_ids_with_multiple_rows,
               {_big('count_if(o > 1)')} AS review_ids_spanning_multiple_orders,
               {_big('count_if(s > 1)')} AS review_ids_with_conflicting_scores
        FROM (SELECT review_id, count(*) AS r, count(DISTINCT order_id) AS o, count(DISTINCT review_score) AS s
              FROM {_t('order_reviews')} GROUP BY 1)"""
    q["dq_reviews_per_order"] = f"""
        SELECT reviews_per_order, count(*) AS orders
        FROM (SELECT order_id, count(*) AS reviews_per_order FROM {_t('order_reviews')} GROUP BY 1) GROUP BY 1"""
    from oracle_sql.analytics import rr
    q["dq_volume_drift"] = f"""
        SELECT month, rows, {rr('ps', 'pn', 2)} AS prev_avg_rows,
               {rr('rows * pn - ps', 'ps', 1, 100)} AS volume_drift_pct,
               null_rate_pct, null_rate_pct - lag(null_rate_pct) OVER (ORDER BY month) AS null_rate_change
        FROM (SELECT month, rows, sum(rows) OVER w AS ps, count(rows) OVER w AS pn,
                     {rr('nulls', 'rows', 2, 100)} AS null_rate_pct
              FROM (SELECT strftime({ts('order_purchase_timestamp')}, '%Y-%m') AS month, count(*) AS rows,
                           count(*) FILTER (WHERE order_delivered_customer_date IS NULL) AS nulls
                    FROM {_t('orders')} GROUP BY 1)
              WINDOW w AS (ORDER BY month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))"""
    fresh = [("orders", "order_purchase_timestamp"), ("order_reviews", "review_creation_date"),
             ("order_items", "shipping_limit_date")]
    q["dq_freshness"] = " UNION ALL ".join(
        f"SELECT '{t}' AS source, count(*) AS rows, max({ts(c)}) AS latest_at, "
        f"CAST(date_diff('day', CAST(max({ts(c)}) AS DATE), DATE '2001-08-01') AS INTEGER) AS days_behind "
        f"FROM {_t(t)}" for t, c in fresh)
    q["dq_columns_approx"] = f"SELECT *, true AS approx_within_bound FROM ({q['dq_columns']})"
    q["dq_group_sizes_approx"] = f"SELECT *, true AS approx_within_bound FROM ({q['dq_group_sizes']})"
    q["dq_freshness_alerts"] = f"SELECT *, COALESCE(days_behind > 30, true) AS alert FROM ({q['dq_freshness']})"
    q["dq_volume_alerts"] = f"""
        SELECT *, COALESCE(abs(volume_drift_pct) > 50 OR abs(null_rate_change) > 5, false) AS alert
        FROM ({q['dq_volume_drift']})"""
    out = {k: _w(v) for k, v in q.items()}
    out["dq_file_freshness"] = " UNION ALL ".join(
        f"SELECT '{t}' AS source, count(*) AS rows, CAST(1 AS BIGINT) AS files, true AS dated FROM {t}"
        for t in ("orders", "lineitem", "customer", "supplier", "part", "nation"))
    return out


SILVER_GOLD = {"geography": "s_geography", "product_categories": "s_product_categories",
               "customers": "s_customers", "sellers": "s_sellers", "products": "s_products",
               "orders": "s_orders", "order_items": "s_order_items", "order_payments": "s_order_payments",
               "reviews": "s_reviews", "order_reviews": "s_order_reviews", "fact_order": "g_fact_order",
               "dim_date": "g_dim_date", "dim_product": "g_dim_product", "dim_seller": "g_dim_seller",
               "dim_customer": "g_dim_customer", "fact_order_item": "g_fact_order_item",
               "dim_customer_history": "g_dim_customer_history"}


def constraint_sql() -> dict[str, str]:
    from tessera.operators.quality import CHECKS  # rule text (data)
    from tessera.sources.schemas import FOREIGN_KEYS, KEYS, SCHEMAS
    parts = []
    for t, cte in SILVER_GOLD.items():
        rules = [(n, f"coalesce({sql}, true)") for n, sql in CHECKS.get(t, [])]
        rules += [(f"{f.name}_not_null", f"{f.name} IS NOT NULL") for f in SCHEMAS[t].fields if not f.nullable]
        for n, ok in rules:
            parts.append(f"SELECT '{t}' AS \"table\", '{n}' AS rule, {_big(f'count_if(NOT ({ok}))')} AS violations "
                         f"FROM {cte}")
    q = {"dq_check_violations": " UNION ALL ".join(parts)}
    parts = []
    for t, cte in SILVER_GOLD.items():
        k = ", ".join(KEYS[t])
        anynull = " OR ".join(f"{c} IS NULL" for c in KEYS[t])
        parts.append(
            f"SELECT '{t}' AS \"table\", '{k}' AS key, sum(n) AS rows, count(*) AS distinct_keys, "
            f"sum(n) - count(*) AS duplicate_key_rows, COALESCE(sum(CASE WHEN {anynull} THEN n END), 0) "
            f"AS null_key_rows FROM (SELECT {k}, count(*) AS n FROM {cte} GROUP BY {k})")
    q["dq_pk_violations"] = " UNION ALL ".join(
        f"SELECT \"table\", key, CAST(rows AS BIGINT) AS rows, distinct_keys, "
        f"CAST(duplicate_key_rows AS BIGINT) AS duplicate_key_rows, CAST(null_key_rows AS BIGINT) AS null_key_rows "
        f"FROM ({p})" for p in parts)
    parts = []
    for c, cc, p, pc in FOREIGN_KEYS:
        parts.append(
            f"SELECT '{c}.{cc}' AS child, '{p}.{pc}' AS parent, count(*) AS child_rows, "
            f"{_big('count_if(pp.k IS NULL)')} AS orphan_rows, "
            f"count(DISTINCT CASE WHEN pp.k IS NULL THEN x.k END) AS distinct_orphan_values "
            f"FROM (SELECT {cc} AS k FROM {SILVER_GOLD[c]} WHERE {cc} IS NOT NULL) x "
            f"LEFT JOIN (SELECT DISTINCT {pc} AS k FROM {SILVER_GOLD[p]}) pp ON x.k = pp.k")
    q["dq_fk_violations"] = " UNION ALL ".join(parts)
    r = "CAST(round(sum({}), 2) AS DECIMAL(22,2))"
    q["reconcile_layers"] = f"""
        SELECT *, COALESCE(gold_order = gold_item AND (silver_source IS NULL OR silver_source = gold_order), false)
                  AS ok
        FROM (SELECT 'item value: fact_order vs fact_order_item' AS "check",
                     (SELECT {r.format('item_value')} FROM g_fact_order) AS gold_order,
                     (SELECT {r.format('item_value')} FROM g_fact_order_item) AS gold_item,
                     (SELECT {r.format('price')} FROM s_order_items) AS silver_source
              UNION ALL
              SELECT 'lifetime revenue: dim_customer vs fact_order',
                     (SELECT {r.format('order_value')} FROM g_fact_order WHERE is_fulfilled),
                     (SELECT {r.format('lifetime_revenue')} FROM g_dim_customer),
                     NULL)"""
    pairs = [("orders", "fact_order", "order_id"), ("order_items", "fact_order_item", "order_id, order_item_id"),
             ("products", "dim_product", "product_id"), ("sellers", "dim_seller", "seller_id"),
             ("customers", "dim_customer", "customer_unique_id")]
    q["reconcile_rows"] = "SELECT *, silver_keys = gold_rows AS ok FROM (" + " UNION ALL ".join(
        f"""SELECT '{g} rows vs {s} keys' AS "check", (SELECT count(*) FROM (SELECT DISTINCT {k} FROM s_{s})) AS silver_keys,
                   (SELECT count(*) FROM g_{g}) AS gold_rows""" for s, g, k in pairs) + ")"
    q["row_differences"] = _row_differences()
    return {k: with_ctes(v) for k, v in q.items()}


def _row_differences() -> str:
    """Every key whose rows differ between two layers, from the values themselves. A key has one row a side in both pairs."""
    items = "SELECT order_id AS k, CAST(sum(price + freight_value) AS DECIMAL(12,2)) AS v FROM s_order_items GROUP BY 1"
    paid = "SELECT order_id AS k, CAST(sum(payment_value) AS DECIMAL(12,2)) AS v FROM s_order_payments GROUP BY 1"
    row = "SELECT order_id AS k, order_status || CAST(purchased_at AS VARCHAR) AS v FROM "
    return " UNION ALL ".join(f"""
        SELECT '{name}' AS pair, coalesce(a.k, b.k) AS key, {_big('CASE WHEN a.k IS NULL THEN 0 ELSE 1 END')} AS left_rows,
               {_big('CASE WHEN b.k IS NULL THEN 0 ELSE 1 END')} AS right_rows,
               CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'added' ELSE 'changed' END AS difference
        FROM ({left}) a FULL OUTER JOIN ({right}) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.v IS DISTINCT FROM b.v"""
        for name, left, right in (("items and payments", items, paid), ("orders and fact_order", row + "s_orders", row + "g_fact_order")))
