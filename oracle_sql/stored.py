"""Queries over written tables: what the tables themselves give, from the raw data."""

from oracle_sql.analytics import analytics_sql
from oracle_sql.quality import BRONZE_COLUMNS, _big, _t, _w, constraint_sql
from oracle_sql.views import with_ctes

DATED = {"orders": "order_purchase_timestamp", "order_items": "shipping_limit_date", "order_reviews": "review_creation_date"}


def _pct(num: str, den: str, digits: int) -> str:
    """num * 100 / den, rounded half up in whole numbers: both sides have two decimals."""
    n, d = (f"CAST({x} * 100 AS HUGEINT)" for x in (num, den))
    return f"CAST((2 * {n} * {100 * 10 ** digits} + {d}) // (2 * {d}) AS DOUBLE) / {10 ** digits}"


def stored_sql() -> dict[str, str]:
    checks, plain = constraint_sql(), analytics_sql()
    profile = " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", "
        f"count(DISTINCT coalesce(strftime(TRY_CAST({ts} AS TIMESTAMP), '%Y-%m'), '')) AS parts, count(*) AS rows, "
        f"{_big(f'count_if({c} IS NULL)')} AS nulls, {_big(f'count_if(trim({c}) = {chr(39)}{chr(39)})')} AS blanks, "
        f"CAST(min(length({c})) AS INTEGER) AS min_len, CAST(max(length({c})) AS INTEGER) AS max_len, "
        f"count_if({c} IS NULL OR trim({c}) = '') = 0 AND count(DISTINCT {c}) >= 0.9 * count(*) AS candidate_key FROM {_t(t)}"
        for t, ts in DATED.items() for c in BRONZE_COLUMNS[t])
    return {
        "dq_pk_stored": checks["dq_pk_violations"],
        "dq_fk_stored": checks["dq_fk_violations"],
        "q2_monthly_stored": plain["q2_monthly_revenue"],
        "q2_fourth_quarters": with_ctes("""
            SELECT strftime(purchased_at, '%Y-%m') AS month, count(*) AS orders, CAST(sum(order_value) AS DECIMAL(22,2)) AS revenue
            FROM g_fact_order WHERE is_fulfilled AND month(purchased_at) >= 10 GROUP BY 1"""),
        "w6_customer_concentration": with_ctes(f"""
            SELECT customer_unique_id, lifetime_revenue, CAST(running AS DECIMAL(22,2)) AS running_revenue,
                   {_pct('lifetime_revenue', 'total', 4)} AS pct_of_revenue, {_pct('running', 'total', 2)} AS cumulative_pct
            FROM (SELECT customer_unique_id, lifetime_revenue, sum(lifetime_revenue) OVER () AS total,
                         sum(lifetime_revenue) OVER (ORDER BY lifetime_revenue DESC) AS running
                  FROM g_dim_customer)"""),
        "w6_daily_running_revenue": with_ctes("""
            SELECT purchase_date_key, orders, CAST(revenue AS DECIMAL(22,2)) AS revenue,
                   CAST(sum(revenue) OVER (ORDER BY purchase_date_key) AS DECIMAL(22,2)) AS running_revenue
            FROM (SELECT purchase_date_key, count(*) AS orders, sum(order_value) AS revenue
                  FROM g_fact_order WHERE is_fulfilled GROUP BY 1)"""),
        "dq_columns_stored": _w(profile),
    }
