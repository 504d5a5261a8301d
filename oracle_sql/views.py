"""Silver and gold tables as DuckDB CTEs over the driver tables.

Written straight from the mapping in FIXTURES.md and the semantics in
directly: the Spark side lands strings and casts them back, which is the
identity for these values.
"""

LOADED_AT = "TIMESTAMP '2001-08-02 00:00:00'"


def _days(e: str) -> str:
    return f"to_days(CAST({e} AS INTEGER))"


def _hours(e: str) -> str:
    return f"to_hours(CAST({e} AS BIGINT))"


def _minutes(e: str) -> str:
    return f"to_minutes(CAST({e} AS BIGINT))"


def _txt(e: str) -> str:
    return f"CAST({e} AS VARCHAR)"


def _zip(e: str) -> str:
    return f"lpad(CAST({e} AS VARCHAR), 5, '0')"


def _text_clean(e: str) -> str:
    return f"NULLIF(trim({e}), '')"


K = "o_orderkey"
STATUS = (f"CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped' "
          f"WHEN {K} % 10 = 0 THEN 'canceled' WHEN {K} % 10 = 1 THEN 'unavailable' ELSE 'processing' END")
PURCHASED = f"(o_orderdate + {_minutes(f'({K} * 7919) % 1440')})"

CTES = {
    # ---------------- bronze-level helpers (typed) ----------------
    "b_customers": f"""
        SELECT 'oc' || {_txt(K)} AS customer_id,
               'u' || {_txt('o_custkey')} || '-' || {_txt(f'{K} % 7')} AS customer_unique_id,
               {_zip(f"c_nationkey + CASE WHEN {K} % 10 = 0 THEN 25 ELSE 0 END")} AS customer_zip_code_prefix,
               lower(c_mktsegment) AS customer_city,
               n_name AS customer_state,
               {LOADED_AT} AS _loaded_at
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "b_sellers": f"""
        SELECT 's' || {_txt('s_suppkey')} AS seller_id, {_zip('s_nationkey')} AS seller_zip_code_prefix,
               'hub' AS seller_city, n_name AS seller_state, {LOADED_AT} AS _loaded_at
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "b_geolocation": f"""
        SELECT {_zip('c_nationkey')} AS geolocation_zip_code_prefix,
               CAST(CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS DOUBLE) AS lat,
               CAST(CAST(-CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS DOUBLE) AS lng,
               c_mktsegment AS geolocation_city, n_name AS geolocation_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey, range(2) r(copy)
        WHERE c_nationkey % 7 <> 3 AND (copy = 0 OR c_custkey % 4 = 0)""",
    "b_order_reviews": f"""
        SELECT 'r' || {_txt('n')} AS review_id, 'o' || {_txt(K)} AS order_id,
               CAST(1 + (n * 31) % 5 AS INTEGER) AS review_score,
               CASE WHEN n % 4 = 1 THEN '   ' WHEN n % 4 = 2 THEN '  great ' || {_txt('n')} || ' '
                    WHEN n % 4 = 3 THEN 'ok' END AS review_comment_title,
               CASE WHEN n % 3 = 0 THEN 'line one' || chr(10) || 'line two ' || {_txt('n')} END
                    AS review_comment_message,
               o_orderdate + {_days('30')} AS created_at,
               o_orderdate + {_days('30')} + {_days('n % 5')} + {_hours('3')} AS answered_at,
               {LOADED_AT} AS _loaded_at
        FROM (SELECT *, CASE WHEN {K} % 20 = 1 THEN {K} - 1 ELSE {K} END AS n FROM orders) o
        WHERE {K} % 9 <> 4
        UNION ALL
        SELECT 'x' || {_txt(K)}, 'o' || {_txt(K)}, CAST(1 + {K} % 5 AS INTEGER), NULL, 'extra review',
               o_orderdate + {_days('30')}, NULL, {LOADED_AT}
        FROM orders WHERE {K} % 50 = 3""",
    # ---------------- silver ----------------
    "s_orders": f"""
        SELECT order_id, customer_id, order_status, purchased_at, approved_at, delivered_to_carrier_at,
               delivered_to_customer_at, estimated_delivery_at,
               'bronze.orders' AS _source, _loaded_at
        FROM (
          SELECT 'o' || {_txt(K)} AS order_id, 'oc' || {_txt(K)} AS customer_id,
                 {STATUS} AS order_status,
                 {PURCHASED} AS purchased_at,
                 CASE WHEN ({STATUS}) <> 'canceled' THEN {PURCHASED} + {_hours(f'{K} % 6 + 1')} END AS approved_at,
                 CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderdate + {_days('1')} + {_hours(f'{K} % 12')} END
                   AS delivered_to_carrier_at,
                 CASE WHEN o_orderstatus = 'F' THEN o_orderdate
                      + {_days(f'2 + ({K} * 31) % 41 + CASE WHEN {K} % 37 = 0 THEN {K} % 60 ELSE 0 END')}
                      + {_hours(f'{K} % 24')} END AS delivered_to_customer_at,
                 o_orderdate + {_days('25')} AS estimated_delivery_at,
                 {LOADED_AT} AS _loaded_at
          FROM orders)
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _loaded_at, approved_at,
                 customer_id, delivered_to_carrier_at, delivered_to_customer_at, estimated_delivery_at,
                 order_status, purchased_at) = 1""",
    "s_customers": """
        SELECT customer_id, customer_unique_id, customer_zip_code_prefix AS zip_code_prefix,
               'bronze.customers' AS _source, _loaded_at
        FROM b_customers
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY _loaded_at, customer_unique_id,
                 customer_zip_code_prefix) = 1""",
    "s_sellers": """
        SELECT seller_id, seller_zip_code_prefix AS zip_code_prefix, 'bronze.sellers' AS _source, _loaded_at
        FROM b_sellers
        QUALIFY row_number() OVER (PARTITION BY seller_id ORDER BY _loaded_at, seller_zip_code_prefix) = 1""",
    "s_products": f"""
        SELECT *, 'bronze.products' AS _source FROM (
          SELECT 'p' || {_txt('p_partkey')} AS product_id,
                 CASE WHEN p_partkey % 50 <> 0 THEN lower(p_type) END AS category_name,
                 CAST(length(p_name) AS INTEGER) AS name_length,
                 CAST(length(p_name) + length(p_type) AS INTEGER) AS description_length,
                 CAST(p_size % 6 AS INTEGER) AS photos_qty,
                 CAST(p_size * 100 AS INTEGER) AS weight_g,
                 CAST(p_size AS INTEGER) AS length_cm,
                 CAST(p_size % 10 + 1 AS INTEGER) AS height_cm,
                 CASE WHEN p_partkey % 20 <> 0 THEN 5 END::INTEGER AS width_cm,
                 {LOADED_AT} AS _loaded_at
          FROM part)
        QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY _loaded_at, category_name,
                 description_length, height_cm, length_cm, name_length, photos_qty, weight_g, width_cm) = 1""",
    "s_translation": """
        SELECT DISTINCT lower(p_type) AS category_name, 'en_' || lower(p_type) AS category_name_english
        FROM part WHERE lower(p_type) IN ('economy', 'promo', 'standard', 'large')""",
    "s_product_categories": """
        SELECT u.category_name, t.category_name_english,
               'bronze.products, bronze.product_category_translation' AS _source, u._loaded_at
        FROM (SELECT category_name, min(_loaded_at) AS _loaded_at FROM s_products
              WHERE category_name IS NOT NULL GROUP BY category_name) u
        LEFT JOIN (SELECT * FROM s_translation
                   QUALIFY row_number() OVER (PARTITION BY category_name ORDER BY category_name_english) = 1) t
          ON u.category_name = t.category_name""",
    "s_order_items": f"""
        SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value,
               'bronze.order_items' AS _source, _loaded_at
        FROM (
          SELECT 'o' || {_txt('l_orderkey')} AS order_id, CAST(l_linenumber AS INTEGER) AS order_item_id,
                 'p' || {_txt('l_partkey')} AS product_id, 's' || {_txt('l_suppkey')} AS seller_id,
                 l_shipdate AS shipping_limit_date,
                 CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
                 CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(10,2))
                   AS freight_value,
                 {LOADED_AT} AS _loaded_at
          FROM lineitem)
        QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY _loaded_at, freight_value,
                 price, product_id, seller_id, shipping_limit_date) = 1""",
    "s_order_payments": f"""
        SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value,
               'bronze.order_payments' AS _source, _loaded_at
        FROM (
          SELECT 'o' || {_txt(K)} AS order_id, CAST(seq AS INTEGER) AS payment_sequential,
                 CASE WHEN seq = 2 THEN 'voucher' WHEN {K} % 4 = 0 THEN 'boleto' WHEN {K} % 4 = 1 THEN 'voucher'
                      ELSE 'credit_card' END AS payment_type,
                 CAST(CASE WHEN seq = 2 THEN 1 ELSE {K} % 10 + 1 END AS INTEGER) AS payment_installments,
                 CAST(CAST(o_totalprice AS DECIMAL(12,2))
                      * CASE WHEN seq = 2 THEN 0.40 WHEN {K} % 3 = 0 THEN 0.60 ELSE 1.00 END::DECIMAL(3,2)
                      AS DECIMAL(10,2)) AS payment_value,
                 {LOADED_AT} AS _loaded_at
          FROM orders, range(1, 3) s(seq)
          WHERE {K} % 200 <> 7 AND (seq = 1 OR {K} % 3 = 0))
        QUALIFY row_number() OVER (PARTITION BY order_id, payment_sequential ORDER BY _loaded_at,
                 payment_installments, payment_type, payment_value) = 1""",
    "s_reviews": f"""
        SELECT review_id, review_score, review_comment_title, review_comment_message, created_at, answered_at,
               'bronze.order_reviews' AS _source, _loaded_at
        FROM (SELECT review_id, review_score, {_text_clean('review_comment_title')} AS review_comment_title,
                     {_text_clean('review_comment_message')} AS review_comment_message,
                     created_at, answered_at, _loaded_at FROM b_order_reviews)
        QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY _loaded_at NULLS LAST,
                 answered_at NULLS LAST, created_at NULLS LAST, review_comment_message NULLS LAST,
                 review_comment_title NULLS LAST, review_score NULLS LAST) = 1""",
    "s_order_reviews": """
        SELECT review_id, order_id, 'bronze.order_reviews' AS _source, _loaded_at
        FROM b_order_reviews
        QUALIFY row_number() OVER (PARTITION BY review_id, order_id ORDER BY _loaded_at) = 1""",
    "s_geography": """
        SELECT r.zip_code_prefix, r.city, r.state, c.latitude, c.longitude,
               'bronze.customers, bronze.sellers, bronze.geolocation' AS _source, r._loaded_at
        FROM (
          SELECT zip_code_prefix, city, state, max(_loaded_at) AS _loaded_at, count(*) AS n
          FROM (SELECT customer_zip_code_prefix AS zip_code_prefix, customer_city AS city,
                       customer_state AS state, _loaded_at FROM b_customers
                UNION ALL
                SELECT seller_zip_code_prefix, seller_city, seller_state, _loaded_at FROM b_sellers)
          GROUP BY zip_code_prefix, city, state
          QUALIFY row_number() OVER (PARTITION BY zip_code_prefix
                                     ORDER BY n DESC, city ASC NULLS LAST, state ASC NULLS LAST) = 1) r
        LEFT JOIN (SELECT geolocation_zip_code_prefix AS zip_code_prefix,
                          median(lat) AS latitude, median(lng) AS longitude
                   FROM b_geolocation GROUP BY 1) c
          ON r.zip_code_prefix = c.zip_code_prefix""",
    # ---------------- gold ----------------
    "g_fact_order": """
        SELECT o.order_id,
               sha256(concat_ws('||', c.customer_unique_id)) AS customer_key,
               CAST(strftime(o.purchased_at, '%Y%m%d') AS INTEGER) AS purchase_date_key,
               o.purchased_at, o.order_status,
               o.order_status NOT IN ('canceled', 'unavailable') AS is_fulfilled,
               CAST(COALESCE(i.item_value, 0) AS DECIMAL(12,2)) AS item_value,
               CAST(COALESCE(i.freight_value, 0) AS DECIMAL(12,2)) AS freight_value,
               CAST(COALESCE(i.item_value, 0) + COALESCE(i.freight_value, 0) AS DECIMAL(12,2)) AS order_value,
               CAST(p.amount_paid AS DECIMAL(12,2)) AS amount_paid,
               CAST(COALESCE(i.item_count, 0) AS INTEGER) AS item_count,
               CAST(COALESCE(i.distinct_product_count, 0) AS INTEGER) AS distinct_product_count,
               CAST(COALESCE(i.distinct_seller_count, 0) AS INTEGER) AS distinct_seller_count,
               p.primary_payment_type, p.max_installments, r.review_score,
               CAST(COALESCE(r.review_count, 0) AS INTEGER) AS review_count,
               CAST(date_diff('day', CAST(o.purchased_at AS DATE), CAST(o.delivered_to_customer_at AS DATE))
                    AS INTEGER) AS delivery_days,
               CAST(date_diff('day', CAST(o.delivered_to_customer_at AS DATE), CAST(o.estimated_delivery_at AS DATE))
                    AS INTEGER) AS days_early,
               CASE WHEN o.delivered_to_customer_at IS NOT NULL
                    THEN o.delivered_to_customer_at > o.estimated_delivery_at END AS is_late
        FROM s_orders o
        JOIN s_customers c ON o.customer_id = c.customer_id
        LEFT JOIN (SELECT order_id, CAST(sum(price) AS DECIMAL(12,2)) AS item_value,
                          CAST(sum(freight_value) AS DECIMAL(12,2)) AS freight_value,
                          count(*) AS item_count, count(DISTINCT product_id) AS distinct_product_count,
                          count(DISTINCT seller_id) AS distinct_seller_count
                   FROM s_order_items GROUP BY order_id) i ON o.order_id = i.order_id
        LEFT JOIN (SELECT order_id, CAST(sum(payment_value) AS DECIMAL(12,2)) AS amount_paid,
                          max(payment_installments) AS max_installments,
                          first(payment_type ORDER BY payment_value DESC NULLS LAST, payment_type DESC)
                            AS primary_payment_type
                   FROM s_order_payments GROUP BY order_id) p ON o.order_id = p.order_id
        LEFT JOIN (SELECT l.order_id, CAST(avg(v.review_score) AS DECIMAL(3,2)) AS review_score,
                          count(*) AS review_count
                   FROM s_order_reviews l JOIN s_reviews v ON l.review_id = v.review_id
                   GROUP BY l.order_id) r ON o.order_id = r.order_id""",
    "g_fact_order_item": """
        SELECT i.order_id, i.order_item_id,
               sha256(concat_ws('||', c.customer_unique_id)) AS customer_key,
               sha256(concat_ws('||', i.product_id)) AS product_key,
               sha256(concat_ws('||', i.seller_id)) AS seller_key,
               CAST(strftime(o.purchased_at, '%Y%m%d') AS INTEGER) AS purchase_date_key,
               o.purchased_at, o.order_status,
               o.order_status NOT IN ('canceled', 'unavailable') AS is_fulfilled,
               CAST(i.price AS DECIMAL(12,2)) AS item_value,
               CAST(i.freight_value AS DECIMAL(12,2)) AS freight_value,
               CAST(i.price + i.freight_value AS DECIMAL(12,2)) AS gross_item_value
        FROM s_order_items i
        JOIN s_orders o ON i.order_id = o.order_id
        JOIN s_customers c ON o.customer_id = c.customer_id""",
    "g_dim_date": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date,
               CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(month(d) AS INTEGER) AS month, strftime(d, '%Y-%m') AS year_month,
               CAST(weekofyear(d) AS INTEGER) AS week_of_year,
               CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
               dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(min(CAST(purchased_at AS DATE)), max(CAST(purchased_at AS DATE)),
                                                 INTERVAL 1 DAY)) AS DATE) AS d
              FROM s_orders)""",
    "g_dim_product": """
        SELECT sha256(concat_ws('||', p.product_id)) AS product_key, p.product_id,
               COALESCE(c.category_name_english, p.category_name, 'unknown') AS category,
               p.category_name AS category_portuguese, p.weight_g, p.photos_qty,
               CAST(p.length_cm AS BIGINT) * CAST(p.height_cm AS BIGINT) * CAST(p.width_cm AS BIGINT) AS volume_cm3
        FROM s_products p LEFT JOIN s_product_categories c ON p.category_name = c.category_name""",
    "g_dim_seller": """
        SELECT sha256(concat_ws('||', s.seller_id)) AS seller_key, s.seller_id,
               g.city AS seller_city, g.state AS seller_state, s.zip_code_prefix AS seller_zip_code_prefix
        FROM s_sellers s LEFT JOIN s_geography g ON s.zip_code_prefix = g.zip_code_prefix""",
    "g_dim_customer": """
        SELECT sha256(concat_ws('||', m.customer_unique_id)) AS customer_key, m.customer_unique_id,
               g.city AS customer_city, g.state AS customer_state, m.zip_code_prefix AS customer_zip_code_prefix,
               g.latitude AS customer_latitude, g.longitude AS customer_longitude,
               m.first_order_at, m.last_order_at, m.lifetime_orders, m.lifetime_fulfilled_orders,
               m.lifetime_revenue, m.lifetime_orders > 1 AS is_repeat_customer
        FROM (
          SELECT c.customer_unique_id,
                 CAST(count(*) AS BIGINT) AS lifetime_orders,
                 CAST(count(*) FILTER (WHERE f.is_fulfilled) AS BIGINT) AS lifetime_fulfilled_orders,
                 CAST(COALESCE(sum(CASE WHEN f.is_fulfilled THEN f.order_value END), 0) AS DECIMAL(12,2))
                   AS lifetime_revenue,
                 min(o.purchased_at) AS first_order_at, max(o.purchased_at) AS last_order_at,
                 first(c.zip_code_prefix ORDER BY o.purchased_at DESC NULLS LAST, o.order_id ASC) AS zip_code_prefix
          FROM s_orders o JOIN s_customers c ON o.customer_id = c.customer_id
          LEFT JOIN g_fact_order f ON o.order_id = f.order_id
          GROUP BY c.customer_unique_id) m
        LEFT JOIN s_geography g ON m.zip_code_prefix = g.zip_code_prefix""",
    "g_history_versions": """
        SELECT customer_unique_id, version, first(zip_code_prefix ORDER BY purchased_at, order_id) AS zip_code_prefix,
               min(purchased_at) AS valid_from, count(*) AS orders_in_version
        FROM (SELECT *, sum(CAST(chg AS INTEGER)) OVER (PARTITION BY customer_unique_id
                          ORDER BY purchased_at, order_id ROWS UNBOUNDED PRECEDING) AS version
              FROM (SELECT c.customer_unique_id, o.purchased_at, o.order_id, c.zip_code_prefix,
                           CASE WHEN lag(o.order_id) OVER w IS NULL THEN true
                                ELSE NOT (c.zip_code_prefix IS NOT DISTINCT FROM lag(c.zip_code_prefix) OVER w)
                           END AS chg
                    FROM s_orders o JOIN s_customers c ON o.customer_id = c.customer_id
                    WINDOW w AS (PARTITION BY c.customer_unique_id ORDER BY o.purchased_at, o.order_id)))
        GROUP BY 1, 2""",
    "g_dim_customer_history": """
        SELECT sha256(concat_ws('||', v.customer_unique_id)) AS customer_key, v.customer_unique_id,
               CAST(v.version AS INTEGER) AS version, v.zip_code_prefix, v.valid_from, n.valid_from AS valid_to,
               n.valid_from IS NULL AS is_current, v.orders_in_version
        FROM g_history_versions v
        LEFT JOIN g_history_versions n ON v.customer_unique_id = n.customer_unique_id AND n.version = v.version + 1""",
}


def count_if_as_filter(sql: str) -> str:
    """``count_if(c)`` -> ``count(*) FILTER (WHERE c)``: DuckDB's count_if is
    NULL when every input is NULL, where Spark's (the semantics to match) is 0."""
    out, i = [], 0
    while True:
        j = sql.find("count_if(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len("count_if")
        for k in range(j + len("count_if"), len(sql)):
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            if depth == 0:
                break
        inner = count_if_as_filter(sql[j + len("count_if("):k])
        out.append(sql[i:j] + f"count(*) FILTER (WHERE {inner})")
        i = k + 1


def with_ctes(select_sql: str, extra: str = "") -> str:
    """Prefix a final SELECT with every CTE (DuckDB ignores unreferenced
    ones), plus ``extra`` CTE definitions after them."""
    body = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in CTES.items())
    if extra:
        body += ",\n" + extra
    return count_if_as_filter(f"WITH {body}\n{select_sql}")
