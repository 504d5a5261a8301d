"""DuckDB SQL for the analytics pack (Q1a-Q8c) over the oracle's gold CTEs.

Rounded ratios use exact integer arithmetic (HALF_UP, away from zero on
ties); DuckDB's DECIMAL division would go through DOUBLE.
"""

from oracle_sql.views import with_ctes

# Same parameter values as tessera.plans.analytics.Params defaults.
MONTH_FROM, MONTH_TO, COHORT_TO = "1995-01", "2001-07", "2001-04"
AS_OF, REPEAT_DAYS, MIN_SUPPORT = "2001-08-01", 90, 100
YEAR_FROM, YEAR_TO, TOP_N, GAP_MAX, SPLIT_MIN = "2001-01", "2001-07", 10, 10, 5


def units(x: str) -> str:
    """Values with at most 2 decimals as integer hundredths."""
    return f"CAST(({x}) * 100 AS HUGEINT)"


def rr(num: str, den: str, scale: int, mult: int = 1) -> str:
    """ROUND(mult * num / den, scale) as DOUBLE, exact; NULL if den is 0/NULL."""
    n, d = units(num), units(den)
    return (f"(CASE WHEN ({den}) IS NULL OR ({den}) = 0 OR ({num}) IS NULL THEN NULL ELSE "
            f"CAST(sign({n}) * sign({d}) * ((abs({n}) * {mult * 10 ** scale * 2} + abs({d})) "
            f"// (2 * abs({d}))) AS DOUBLE) / {10 ** scale} END)")


def money_div(num: str, den: str) -> str:
    """ROUND(money / count, 2) as DECIMAL(18,2), exact."""
    c = units(num)
    return (f"(CASE WHEN ({den}) IS NULL OR ({den}) = 0 OR ({num}) IS NULL THEN NULL ELSE "
            f"CAST(CAST(sign({c}) * ((abs({c}) * 2 + ({den})) // (2 * ({den}))) AS DECIMAL(18,0)) * 0.01 "
            f"AS DECIMAL(18,2)) END)")


def avg_money(x: str) -> str:
    return money_div(f"sum({x})", f"count({x})")


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def msum(x: str) -> str:
    return f"CAST(sum({x}) AS DECIMAL(22,2))"


SEQ = """
  seq AS (
    SELECT *, date_diff('day', CAST(purchased_at AS DATE), CAST(next_at AS DATE)) AS gap_days
    FROM (SELECT *, row_number() OVER w AS order_seq, lead(purchased_at) OVER w AS next_at
          FROM g_fact_order WHERE is_fulfilled
          WINDOW w AS (PARTITION BY customer_key ORDER BY purchased_at, order_id)))"""


ITEM_MEASURES = f"""
    {msum('f.gross_item_value')} AS revenue, {msum('f.item_value')} AS revenue_excl_freight,
    count(*) AS units_sold, count(DISTINCT f.order_id) AS orders, count(DISTINCT f.customer_key) AS customers,
    {avg_money('f.item_value')} AS avg_unit_price"""

CUTOFF = f"(DATE '{AS_OF}' - INTERVAL {REPEAT_DAYS} DAY)"


def analytics_sql() -> dict[str, str]:
    q = {}
    q["q1a_top_products"] = f"""
      SELECT p.product_id, p.category, {ITEM_MEASURES}
      FROM g_fact_order_item f JOIN g_dim_product p ON f.product_key = p.product_key
      WHERE f.is_fulfilled
      GROUP BY p.product_id, p.category
      ORDER BY revenue DESC, p.product_id LIMIT {TOP_N}"""
    q["q1b_top_categories"] = f"""
      SELECT category, revenue, revenue_excl_freight,
             {rr('revenue', 'sum(revenue) OVER ()', 2, 100)} AS pct_of_revenue,
             {rr('sum(revenue) OVER (ORDER BY revenue DESC)', 'sum(revenue) OVER ()', 1, 100)} AS cumulative_pct,
             units_sold, orders, customers, avg_unit_price
      FROM (SELECT p.category, {ITEM_MEASURES}
            FROM g_fact_order_item f JOIN g_dim_product p ON f.product_key = p.product_key
            WHERE f.is_fulfilled GROUP BY p.category)
      ORDER BY revenue DESC, category LIMIT {TOP_N}"""
    q["q1c_top_customers_revenue"] = f"""
      SELECT customer_unique_id, customer_state, customer_city, lifetime_revenue, lifetime_fulfilled_orders,
             {money_div('lifetime_revenue', 'lifetime_fulfilled_orders')} AS avg_order_value,
             first_order_at, last_order_at
      FROM g_dim_customer ORDER BY lifetime_revenue DESC, customer_unique_id LIMIT {TOP_N}"""
    q["q1d_top_customers_orders"] = f"""
      SELECT customer_unique_id, customer_state, customer_city, lifetime_fulfilled_orders, lifetime_revenue,
             {money_div('lifetime_revenue', 'lifetime_fulfilled_orders')} AS avg_order_value,
             CAST(date_diff('day', CAST(first_order_at AS DATE), CAST(last_order_at AS DATE)) AS INTEGER)
               AS days_between_first_and_last
      FROM g_dim_customer
      ORDER BY lifetime_fulfilled_orders DESC, lifetime_revenue DESC, customer_unique_id LIMIT {TOP_N}"""
    q["q2_monthly_revenue"] = f"""
      SELECT month, revenue, revenue_excl_freight,
             {rr('revenue - prev_revenue', 'prev_revenue', 1, 100)} AS revenue_growth_pct,
             order_count,
             {rr('order_count - prev_count', 'prev_count', 1, 100)} AS order_growth_pct,
             avg_order_value
      FROM (SELECT *, lag(revenue) OVER (ORDER BY month) AS prev_revenue,
                      lag(order_count) OVER (ORDER BY month) AS prev_count
            FROM (SELECT d.year_month AS month, {msum('f.order_value')} AS revenue,
                         {msum('f.item_value')} AS revenue_excl_freight, count(*) AS order_count,
                         {avg_money('f.order_value')} AS avg_order_value
                  FROM g_fact_order f JOIN g_dim_date d ON f.purchase_date_key = d.date_key
                  WHERE f.is_fulfilled AND d.year_month BETWEEN '{MONTH_FROM}' AND '{MONTH_TO}'
                  GROUP BY d.year_month))
      ORDER BY month"""
    q["q3_delivery_extremes"] = f"""
      SELECT customer_state, delivered_orders, round(median_days) AS median_days, extreme_orders,
             {rr('extreme_orders', 'delivered_orders', 2, 100)} AS pct_extreme,
             worst_delivery_days,
             {rr('past', 'delivered_orders', 1, 100)} AS pct_past_promised_date,
             {rr('s_all', 'n_all', 2)} AS avg_review_score,
             {rr('s_ext', 'n_ext', 2)} AS avg_review_score_of_extremes,
             {rr('s_all * n_ext - s_ext * n_all', 'n_all * n_ext', 2)} AS review_score_penalty
      FROM (
        SELECT c.customer_state, count(*) AS delivered_orders,
               quantile_cont(CAST(o.delivery_days AS DOUBLE), 0.5) AS median_days,
               {big('count_if(o.delivery_days > t.p99)')} AS extreme_orders,
               max(o.delivery_days) AS worst_delivery_days,
               sum(o.review_score) AS s_all, count(o.review_score) AS n_all,
               sum(CASE WHEN o.delivery_days > t.p99 THEN o.review_score END) AS s_ext,
               count(CASE WHEN o.delivery_days > t.p99 THEN o.review_score END) AS n_ext,
               {big('count_if(o.days_early < 0)')} AS past
        FROM g_fact_order o JOIN g_dim_customer c ON o.customer_key = c.customer_key,
             (SELECT quantile_cont(CAST(o2.delivery_days AS DOUBLE), 0.99) AS p99
              FROM g_fact_order o2 JOIN g_dim_customer c2 ON o2.customer_key = c2.customer_key
              WHERE o2.is_fulfilled AND o2.delivery_days IS NOT NULL) t
        WHERE o.is_fulfilled AND o.delivery_days IS NOT NULL
        GROUP BY c.customer_state
        HAVING count(*) >= {MIN_SUPPORT})
      ORDER BY pct_extreme DESC, customer_state"""
    q["q4_state_performance"] = f"""
      SELECT customer_state, customers, orders, revenue, revenue_excl_freight,
             {rr('revenue', 'sum(revenue) OVER ()', 2, 100)} AS pct_of_revenue,
             {rr('sum(revenue) OVER (ORDER BY revenue DESC)', 'sum(revenue) OVER ()', 1, 100)} AS cumulative_pct,
             {money_div('revenue', 'customers')} AS revenue_per_customer,
             avg_order_value,
             {rr('freight', 'revenue', 1, 100)} AS freight_pct_of_revenue,
             round(median_delivery_days) AS median_delivery_days,
             avg_review_score
      FROM (SELECT c.customer_state, count(DISTINCT o.customer_key) AS customers, count(*) AS orders,
                   {msum('o.order_value')} AS revenue, {msum('o.item_value')} AS revenue_excl_freight,
                   {msum('o.freight_value')} AS freight, {avg_money('o.order_value')} AS avg_order_value,
                   quantile_cont(CAST(o.delivery_days AS DOUBLE), 0.5) AS median_delivery_days,
                   {rr('sum(o.review_score)', 'count(o.review_score)', 2)} AS avg_review_score
            FROM g_fact_order o JOIN g_dim_customer c ON o.customer_key = c.customer_key
            WHERE o.is_fulfilled GROUP BY c.customer_state)
      ORDER BY revenue DESC, customer_state"""
    cohorts = f"""
      SELECT d.year_month AS acquisition_month, s.order_value AS first_order_value, s.gap_days,
             s.gap_days BETWEEN 1 AND {REPEAT_DAYS} AS returned_in_90d
      FROM seq s JOIN g_dim_date d ON s.purchase_date_key = d.date_key
      WHERE s.order_seq = 1 AND d.year_month BETWEEN '{MONTH_FROM}' AND '{COHORT_TO}'"""
    q["q5_cohort_retention"] = f""",{SEQ},
      cohorts AS ({cohorts}),
      returners AS (SELECT acquisition_month, quantile_cont(CAST(gap_days AS DOUBLE), 0.5) AS median_days
                    FROM cohorts WHERE returned_in_90d GROUP BY acquisition_month)
      SELECT c.acquisition_month, count(*) AS new_customers, {msum('c.first_order_value')} AS first_order_revenue,
             {avg_money('c.first_order_value')} AS avg_first_order_value,
             {big('count_if(c.returned_in_90d)')} AS returned_within_90d,
             {rr('count_if(c.returned_in_90d)', 'count(*)', 2, 100)} AS repeat_rate_90d_pct,
             round(max(r.median_days)) AS median_days_to_return
      FROM cohorts c LEFT JOIN returners r ON c.acquisition_month = r.acquisition_month
      GROUP BY c.acquisition_month ORDER BY c.acquisition_month"""
    secs = "(epoch(next_at)::BIGINT - epoch(purchased_at)::BIGINT)"
    q["q6a_gap_histogram"] = f""",{SEQ}
      SELECT gap_days, count(*) AS customers,
             {big(f'count_if(gap_days = 0 AND (2 * {secs} * 10 + 60) // 120 <= {SPLIT_MIN * 10})')} AS within_5_minutes
      FROM seq WHERE order_seq = 1 AND next_at IS NOT NULL AND gap_days <= {GAP_MAX}
      GROUP BY gap_days ORDER BY gap_days"""
    in_cohort = f"purchased_at < {CUTOFF}"
    q["q6b_repeat_variants"] = f""",{SEQ}
      SELECT count(*) AS customers, {big('count_if(gap_days IS NOT NULL)')} AS ever_returned_naive,
             {big('count_if(gap_days = 0)')} AS same_day_split_checkouts,
             {big('count_if(gap_days >= 1)')} AS ever_returned_genuine,
             {rr('count_if(gap_days >= 1)', 'count(*)', 2, 100)} AS lifetime_repeat_pct,
             {big(f'count_if(gap_days > {REPEAT_DAYS})')} AS genuine_returns_after_90_days,
             {rr(f'count_if({in_cohort} AND gap_days BETWEEN 1 AND {REPEAT_DAYS})', f'count_if({in_cohort})', 2, 100)}
               AS repeat_rate_90d_pct
      FROM seq WHERE order_seq = 1"""
    q["q6c_repeat_by_review"] = f""",{SEQ}
      SELECT CAST(trunc(review_score) AS INTEGER) AS first_order_review_score, count(*) AS customers,
             {rr(f'count_if(gap_days BETWEEN 1 AND {REPEAT_DAYS})', 'count(*)', 2, 100)} AS repeat_rate_90d_pct
      FROM seq WHERE order_seq = 1 AND review_score IS NOT NULL AND {in_cohort}
      GROUP BY 1 ORDER BY 1"""
    per_item = "sign(o.{c}) * ((abs(CAST(o.{c} * 100 AS HUGEINT)) * 200000000000 + o.item_count) // (2 * o.item_count))"
    avg13 = ("CAST(sign(sum({q})) * ((2 * abs(sum({q})) + count(*) * 100000000000) "
             "// (2 * count(*) * 100000000000)) AS DOUBLE) / 100")
    q["q7_basket_by_state"] = f"""
      SELECT c.customer_state, count(*) AS orders, {avg_money('o.order_value')} AS avg_order_value,
             {rr('sum(o.item_count)', 'count(o.item_count)', 2)} AS avg_items_per_order,
             {avg13.format(q=per_item.format(c='item_value'))} AS avg_price_per_item,
             {avg13.format(q=per_item.format(c='freight_value'))} AS avg_freight_per_item,
             {rr('sum(o.freight_value)', 'sum(o.order_value)', 1, 100)} AS freight_pct_of_revenue
      FROM g_fact_order o JOIN g_dim_customer c ON o.customer_key = c.customer_key
      WHERE o.is_fulfilled AND o.item_count > 0
      GROUP BY c.customer_state ORDER BY avg_price_per_item DESC, c.customer_state"""
    q["q8a_one_time_buyers"] = f""",
      one_timers AS (SELECT lifetime_revenue,
                            date_diff('day', CAST(last_order_at AS DATE), DATE '{AS_OF}') AS days_since_order
                     FROM g_dim_customer WHERE lifetime_fulfilled_orders = 1),
      median_value AS (SELECT quantile_cont(CAST(lifetime_revenue AS DOUBLE), 0.5) AS median_rev FROM one_timers)
      SELECT CASE WHEN o.days_since_order <= 90 THEN 'a. 0-90 days'
                  WHEN o.days_since_order <= 180 THEN 'b. 91-180 days'
                  WHEN o.days_since_order <= 365 THEN 'c. 181-365 days'
                  ELSE 'd. 365+ days' END AS recency,
             CASE WHEN o.lifetime_revenue >= (SELECT median_rev FROM median_value) THEN 'above median spend'
                  ELSE 'below median spend' END AS value_tier,
             count(*) AS customers, {avg_money('o.lifetime_revenue')} AS avg_first_order_value
      FROM one_timers o GROUP BY 1, 2 ORDER BY 1, 2"""
    q["q8b_value_by_sequence"] = f""",{SEQ}
      SELECT order_seq, count(*) AS orders, {avg_money('order_value')} AS avg_order_value
      FROM seq WHERE order_seq <= 3 GROUP BY order_seq ORDER BY order_seq"""
    q["q8c_new_customers"] = f""",{SEQ}
      SELECT count(*) AS months,
             {rr('sum(new_customers)', 'count(*)', 0)} AS avg_new_customers_per_month,
             {rr('sum(new_customers)', 'count(*)', 0, 12)} AS annualised_new_customers
      FROM (SELECT d.year_month, count(*) AS new_customers
            FROM seq s JOIN g_dim_date d ON s.purchase_date_key = d.date_key
            WHERE s.order_seq = 1 AND d.year_month BETWEEN '{YEAR_FROM}' AND '{YEAR_TO}'
            GROUP BY d.year_month)"""
    q["x8_campaign_targets"] = f""",
      one AS (SELECT * FROM g_dim_customer WHERE lifetime_fulfilled_orders = 1),
      med AS (SELECT quantile_cont(CAST(lifetime_revenue AS DOUBLE), 0.5) AS m FROM one),
      dlv AS (SELECT customer_key,
                     CAST(CAST(purchased_at AS DATE) + CAST(delivery_days AS INTEGER) AS DATE) AS delivered_on
              FROM g_fact_order WHERE is_fulfilled AND delivery_days IS NOT NULL)
      SELECT o.customer_unique_id, o.customer_state, d.delivered_on,
             CAST(date_diff('day', d.delivered_on, DATE '{AS_OF}') AS INTEGER) AS days_since_delivery,
             o.lifetime_revenue AS first_order_value,
             CASE WHEN ('0x' || right(o.customer_key, 1))::INTEGER % 2 = 0 THEN 'holdout' ELSE 'treatment' END
               AS campaign_group
      FROM one o JOIN dlv d ON o.customer_key = d.customer_key
      WHERE o.lifetime_revenue >= (SELECT m FROM med)
        AND date_diff('day', d.delivered_on, DATE '{AS_OF}') BETWEEN 21 AND 30
      ORDER BY d.delivered_on, o.customer_unique_id"""
    out = {}
    for name, sql in q.items():
        if sql.startswith(","):
            # extra CTEs: splice them after the shared ones
            extra, _, final = sql[1:].rpartition("\n      SELECT")
            out[name] = with_ctes("SELECT" + final, extra=extra.strip().rstrip(","))
        else:
            out[name] = with_ctes(sql)
    return out
