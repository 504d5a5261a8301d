"""The analytics pack over the gold star schema.

Conventions: fulfilled orders only; revenue = item value + freight. Every
cut-off is a field of ``Params``. Top-k and window orderings carry a key
tie-break so results are deterministic. Windows without PARTITION BY only
run on already-aggregated rows (months, states, categories).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import (
    ROUNDED_MONEY,
    SUM_MONEY,
    avg_money,
    exact_avg,
    exact_ratio,
    money_ratio,
)
from tessera.operators.percentile import exact_percentile
from tessera.operators.sequence import order_sequence
from tessera.session import checkpoint_dir


@dataclass(frozen=True)
class Params:
    month_from: str = "1995-01"  # time-series window (inclusive, yyyy-MM)
    month_to: str = "2001-07"
    cohort_to: str = "2001-04"  # last acquisition month with a full repeat window
    as_of: str = "2001-08-01"  # "today" for recency and cohort cut-offs
    repeat_days: int = 90
    min_support: int = 100  # minimum delivered orders per state (Q3)
    year_from: str = "2001-01"  # months averaged for new-customer sizing (Q8c)
    year_to: str = "2001-07"
    contact_from_days: int = 21  # campaign contact window after delivery (X8)
    contact_to_days: int = 30
    top_n: int = 10
    gap_max_days: int = 10  # Q6a histogram range
    split_minutes: int = 5  # Q6a split checkout threshold


DEFAULT = Params()
ROUNDED = "double"

# Report labels of the one-time-buyer breakdown (Q8a), in order.
RECENCY_BUCKETS = ((90, "a. 0-90 days"), (180, "b. 91-180 days"), (365, "c. 181-365 days"))
RECENCY_OLDEST = "d. 365+ days"
ABOVE_MEDIAN, BELOW_MEDIAN = "above median spend", "below median spend"


def _fulfilled(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_fulfilled"))


def _dates(dim_date: DataFrame) -> DataFrame:
    return dim_date.select(F.col("date_key").alias("purchase_date_key"), "year_month")


def _in_months(fact: DataFrame, first: str, last: str) -> DataFrame:
    """Rows bought from month ``first`` to ``last`` (yyyy-MM): a range of date keys, which reaches the scan."""
    lo, hi = (int(m.replace("-", "")) * 100 for m in (first, last))
    return fact.filter(F.col("purchase_date_key").between(lo + 1, hi + 31))


def _packed(key: str) -> Column:
    """A surrogate key as 32 bytes in place of 64 characters; another text as a longer binary. Different keys stay different."""
    text = F.col(key)
    return F.when(text.rlike("^[0-9a-f]{64}$"), F.unhex(text)).otherwise(F.concat(F.encode(text, "UTF-8"), F.lit(bytes(33))))


def _item_measures(items: DataFrame, by: str) -> DataFrame:
    """Sales figures per ``by``. An order has one customer, so lines are first brought to one row per
    (``by``, order), which is partly done before the shuffle; orders are then a plain count, and
    customers, the one distinct count left, are counted from (``by``, customer) rows."""
    items = items.withColumn("customer_key", _packed("customer_key"))
    per_order = items.groupBy(by, "order_id").agg(
        F.sum("gross_item_value").alias("gross"), F.sum("item_value").alias("goods"),
        F.count(F.lit(1)).alias("lines"), F.count("item_value").alias("priced"), F.min("customer_key").alias("customer"))
    per_customer = per_order.groupBy(by, "customer").agg(
        F.sum("gross").alias("gross"), F.sum("goods").alias("goods"), F.sum("lines").alias("lines"),
        F.sum("priced").alias("priced"), F.count("order_id").alias("orders"))
    price = F.sum("goods").cast(SUM_MONEY) / F.nullif(F.sum("priced"), F.lit(0)).cast("decimal(20,0)")
    return per_customer.groupBy(by).agg(
        F.sum("gross").cast(SUM_MONEY).alias("revenue"),
        F.sum("goods").cast(SUM_MONEY).alias("revenue_excl_freight"),
        F.sum("lines").alias("units_sold"),
        F.sum("orders").alias("orders"),
        F.count("customer").alias("customers"),
        F.round(price, 2).cast(ROUNDED_MONEY).alias("avg_unit_price"))


def top_products(fact_order_item: DataFrame, dim_product: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Top products by revenue. Aggregated per product key first, then
    joined to the dimension (one row per product), then top-k."""
    items = _fulfilled(fact_order_item).withColumn("product_key", _packed("product_key"))
    per_product = _item_measures(items, "product_key")
    return (per_product.join(dim_product.select(_packed("product_key").alias("product_key"), "product_id", "category"), "product_key")
            .select("product_id", "category", "revenue", "revenue_excl_freight", "units_sold",
                    "orders", "customers", "avg_unit_price")
            .orderBy(F.col("revenue").desc(), F.col("product_id"))
            .limit(p.top_n))


def _share_columns(total_col: str = "revenue", order_key: str = "category") -> list:
    whole = Window.partitionBy()
    running = Window.orderBy(F.col(total_col).desc())  # RANGE frame: ties share the running value
    return [
        exact_ratio(F.col(total_col), F.sum(total_col).over(whole), 2, 100).alias("pct_of_revenue"),
        exact_ratio(F.sum(total_col).over(running), F.sum(total_col).over(whole), 1, 100)
        .alias("cumulative_pct"),
    ]


def top_categories(fact_order_item: DataFrame, dim_product: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Top categories with share and cumulative share of all categories."""
    by_cat = _item_measures(_fulfilled(fact_order_item).join(
        dim_product.select("product_key", "category"), "product_key"), "category")
    return (by_cat.select("category", "revenue", "revenue_excl_freight", *_share_columns(),
                          "units_sold", "orders", "customers", "avg_unit_price")
            .orderBy(F.col("revenue").desc(), F.col("category"))
            .limit(p.top_n))


def top_customers_by_revenue(dim_customer: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q1c"""
    return (dim_customer.select(
                "customer_unique_id", "customer_state", "customer_city", "lifetime_revenue",
                "lifetime_fulfilled_orders",
                money_ratio("lifetime_revenue", "lifetime_fulfilled_orders").alias("avg_order_value"),
                "first_order_at", "last_order_at")
            .orderBy(F.col("lifetime_revenue").desc(), F.col("customer_unique_id"))
            .limit(p.top_n))


def top_customers_by_orders(dim_customer: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q1d"""
    return (dim_customer.select(
                "customer_unique_id", "customer_state", "customer_city", "lifetime_fulfilled_orders",
                "lifetime_revenue",
                money_ratio("lifetime_revenue", "lifetime_fulfilled_orders").alias("avg_order_value"),
                F.datediff("last_order_at", "first_order_at").alias("days_between_first_and_last"))
            .orderBy(F.col("lifetime_fulfilled_orders").desc(), F.col("lifetime_revenue").desc(),
                     F.col("customer_unique_id"))
            .limit(p.top_n))


def monthly_revenue(fact_order: DataFrame, dim_date: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q2: monthly revenue and orders with month-on-month growth."""
    monthly = (_in_months(_fulfilled(fact_order), p.month_from, p.month_to).join(_dates(dim_date), "purchase_date_key")
               .groupBy(F.col("year_month").alias("month"))
               .agg(F.sum("order_value").cast(SUM_MONEY).alias("revenue"),
                    F.sum("item_value").cast(SUM_MONEY).alias("revenue_excl_freight"),
                    F.count(F.lit(1)).alias("order_count"),
                    avg_money("order_value").alias("avg_order_value")))
    w = Window.orderBy("month")  # months only
    prev_rev, prev_n = F.lag("revenue").over(w), F.lag("order_count").over(w)
    return (monthly.select(
                "month", "revenue", "revenue_excl_freight",
                exact_ratio(F.col("revenue") - prev_rev, prev_rev, 1, 100).alias("revenue_growth_pct"),
                "order_count",
                exact_ratio(F.col("order_count") - prev_n, prev_n, 1, 100).alias("order_growth_pct"),
                "avg_order_value")
            .orderBy("month"))


def _with_state(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    return fact.join(dim_customer.select("customer_key", "customer_state"), "customer_key")


def delivery_extremes(fact_order: DataFrame, dim_customer: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q3: extreme delivery delays (above the global p99) by state.

    The p99 is a scalar subquery (computed once, planned as a literal), not
    a cross join. Percentiles aggregate partially (state = value counts).
    """
    delivered = _with_state(_fulfilled(fact_order).filter(F.col("delivery_days").isNotNull()), dim_customer)
    days = F.col("delivery_days")
    p99 = delivered.agg(F.percentile(days.cast("double"), 0.99)).scalar()
    # the threshold test is projected before the aggregate (a scalar subquery
    # over a plan with file names / partition ids counts as non-deterministic)
    flagged = delivered.withColumn("_extreme", days > p99)
    extreme = F.col("_extreme")
    by_state = (flagged.groupBy("customer_state").agg(
        F.count(F.lit(1)).alias("delivered_orders"),
        F.percentile(days.cast("double"), 0.5).alias("median_days"),
        F.count_if(extreme).alias("extreme_orders"),
        F.max(days).alias("worst_delivery_days"),
        F.sum("review_score").alias("_s_all"), F.count("review_score").alias("_n_all"),
        F.sum(F.when(extreme, F.col("review_score"))).alias("_s_ext"),
        F.count(F.when(extreme, F.col("review_score"))).alias("_n_ext"),
        F.count_if(F.col("days_early") < 0).alias("orders_past_promised_date"),
    ).filter(F.col("delivered_orders") >= p.min_support))
    avg_all = F.col("_s_all").cast(SUM_MONEY) / F.nullif(F.col("_n_all"), F.lit(0)).cast("decimal(20,0)")
    avg_ext = F.col("_s_ext").cast(SUM_MONEY) / F.nullif(F.col("_n_ext"), F.lit(0)).cast("decimal(20,0)")
    return (by_state.select(
                "customer_state", "delivered_orders",
                F.round("median_days").alias("median_days"),
                "extreme_orders",
                exact_ratio("extreme_orders", "delivered_orders", 2, 100).alias("pct_extreme"),
                "worst_delivery_days",
                exact_ratio("orders_past_promised_date", "delivered_orders", 1, 100).alias("pct_past_promised_date"),
                F.round(avg_all, 2).cast(ROUNDED).alias("avg_review_score"),
                F.round(avg_ext, 2).cast(ROUNDED).alias("avg_review_score_of_extremes"),
                F.round(avg_all - avg_ext, 2).cast(ROUNDED).alias("review_score_penalty"))
            .orderBy(F.col("pct_extreme").desc(), F.col("customer_state")))


def state_performance(fact_order: DataFrame, dim_customer: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q4: commercial performance by customer state."""
    by_state = _with_state(_fulfilled(fact_order), dim_customer).groupBy("customer_state").agg(
        F.count_distinct("customer_key").alias("customers"),
        F.count(F.lit(1)).alias("orders"),
        F.sum("order_value").cast(SUM_MONEY).alias("revenue"),
        F.sum("item_value").cast(SUM_MONEY).alias("revenue_excl_freight"),
        F.sum("freight_value").cast(SUM_MONEY).alias("freight"),
        avg_money("order_value").alias("avg_order_value"),
        F.percentile(F.col("delivery_days").cast("double"), 0.5).alias("median_delivery_days"),
        exact_avg("review_score", 2).alias("avg_review_score"),
    )
    return (by_state.select(
                "customer_state", "customers", "orders", "revenue", "revenue_excl_freight",
                *_share_columns(),
                money_ratio("revenue", "customers").alias("revenue_per_customer"),
                "avg_order_value",
                exact_ratio("freight", "revenue", 1, 100).alias("freight_pct_of_revenue"),
                F.round("median_delivery_days").alias("median_delivery_days"),
                "avg_review_score")
            .orderBy(F.col("revenue").desc(), F.col("customer_state")))


def _returned(gap: str, p: Params):
    return F.col(gap).between(1, p.repeat_days)


def cohort_retention(fact_order: DataFrame, dim_date: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q5: monthly acquisition cohorts, repeat rate within the window and
    median days to return. Cohort months are applied after sequencing.
    One pass: the returners' median is a percentile over the gaps of those
    who returned, in the same aggregation (NULL when nobody did)."""
    firsts = order_sequence(fact_order, depth=2).filter(F.col("order_seq") == 1)
    cohorts = (firsts.join(_dates(dim_date), "purchase_date_key")
               .filter(F.col("year_month").between(p.month_from, p.cohort_to))
               .select(F.col("year_month").alias("acquisition_month"),
                       F.col("order_value").alias("first_order_value"), "gap_days",
                       _returned("gap_days", p).alias("returned_in_90d")))
    returned = F.col("returned_in_90d")
    agg = cohorts.groupBy("acquisition_month").agg(
        F.count(F.lit(1)).alias("new_customers"),
        F.sum("first_order_value").cast(SUM_MONEY).alias("first_order_revenue"),
        avg_money("first_order_value").alias("avg_first_order_value"),
        F.count_if(returned).alias("returned_within_90d"),
        F.percentile(F.when(returned, F.col("gap_days")).cast("double"), 0.5).alias("_median"))
    return (agg.select(
                "acquisition_month", "new_customers", "first_order_revenue", "avg_first_order_value",
                "returned_within_90d",
                exact_ratio("returned_within_90d", "new_customers", 2, 100).alias("repeat_rate_90d_pct"),
                F.round("_median").alias("median_days_to_return"))
            .orderBy("acquisition_month"))


def gap_histogram(fact_order: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Days between a customer's first and second order (0..gap_max),
    with how many same-day gaps are split checkouts (<= split_minutes)."""
    firsts = order_sequence(fact_order, depth=2).filter(
        (F.col("order_seq") == 1) & F.col("next_at").isNotNull())
    seconds = F.unix_timestamp("next_at") - F.unix_timestamp("purchased_at")
    minutes = F.round(seconds.cast("decimal(20,0)") / F.lit(60).cast("decimal(20,0)"), 1)
    return (firsts.filter(F.col("gap_days") <= p.gap_max_days)
            .groupBy("gap_days")
            .agg(F.count(F.lit(1)).alias("customers"),
                 F.count_if((F.col("gap_days") == 0) & (minutes <= p.split_minutes)).alias("within_5_minutes"))
            .orderBy("gap_days"))


def _cutoff(p: Params):
    return F.date_sub(F.lit(p.as_of).cast("date"), p.repeat_days).cast("timestamp")


def repeat_rate_variants(fact_order: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Naive vs. genuine repeat rates in one row."""
    firsts = order_sequence(fact_order, depth=2).filter(F.col("order_seq") == 1)
    gap = F.col("gap_days")
    in_cohort = F.col("purchased_at") < _cutoff(p)
    return firsts.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(gap.isNotNull()).alias("ever_returned_naive"),
        F.count_if(gap == 0).alias("same_day_split_checkouts"),
        F.count_if(gap >= 1).alias("ever_returned_genuine"),
        exact_ratio(F.count_if(gap >= 1), F.count(F.lit(1)), 2, 100).alias("lifetime_repeat_pct"),
        F.count_if(gap > p.repeat_days).alias("genuine_returns_after_90_days"),
        exact_ratio(F.count_if(in_cohort & _returned("gap_days", p)), F.count_if(in_cohort), 2, 100)
        .alias("repeat_rate_90d_pct"),
    )


def repeat_by_first_review(fact_order: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """90-day repeat rate by the first order's review score (truncated)."""
    firsts = order_sequence(fact_order, depth=2).filter(
        (F.col("order_seq") == 1) & F.col("review_score").isNotNull() & (F.col("purchased_at") < _cutoff(p)))
    return (firsts.groupBy(F.col("review_score").cast("int").alias("first_order_review_score"))
            .agg(F.count(F.lit(1)).alias("customers"),
                 exact_ratio(F.count_if(_returned("gap_days", p)), F.count(F.lit(1)), 2, 100)
                 .alias("repeat_rate_90d_pct"))
            .orderBy("first_order_review_score"))


def basket_by_state(fact_order: DataFrame, dim_customer: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Q7: basket size vs. item price by state (orders with items only)."""
    f = _with_state(_fulfilled(fact_order).filter(F.col("item_count") > 0), dim_customer)
    per_item = (F.col("item_value") / F.col("item_count")).cast("decimal(23,13)")
    freight_per_item = (F.col("freight_value") / F.col("item_count")).cast("decimal(23,13)")
    return (f.groupBy("customer_state").agg(
                F.count(F.lit(1)).alias("orders"),
                avg_money("order_value").alias("avg_order_value"),
                exact_avg("item_count", 2).alias("avg_items_per_order"),
                F.round(F.sum(per_item) / F.count(per_item).cast("decimal(20,0)"), 2).cast(ROUNDED)
                .alias("avg_price_per_item"),
                F.round(F.sum(freight_per_item) / F.count(freight_per_item).cast("decimal(20,0)"), 2)
                .cast(ROUNDED).alias("avg_freight_per_item"),
                exact_ratio(F.sum("freight_value"), F.sum("order_value"), 1, 100).alias("freight_pct_of_revenue"))
            .orderBy(F.col("avg_price_per_item").desc(), F.col("customer_state")))


def one_time_buyers(dim_customer: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """One-time buyers by recency bucket and above/below median spend.
    The median is a scalar subquery over the distributed exact percentile."""
    one = dim_customer.filter(F.col("lifetime_fulfilled_orders") == 1).select(
        "lifetime_revenue", F.datediff(F.lit(p.as_of).cast("date"), "last_order_at").alias("days_since_order"))
    checkpoint_dir(one.sparkSession)
    one = one.checkpoint()  # read by the median and by the report: worked out once
    # revenue has unbounded distinct values: distributed exact median
    median = exact_percentile(one, "lifetime_revenue", 0.5, alias="m").scalar()
    d = F.col("days_since_order")
    recency = F
    for limit, label in RECENCY_BUCKETS:
        recency = recency.when(d <= limit, label)
    recency = recency.otherwise(RECENCY_OLDEST)
    tier = F.when(F.col("lifetime_revenue") >= median, ABOVE_MEDIAN).otherwise(BELOW_MEDIAN)
    return (one.select("lifetime_revenue", recency.alias("recency"), tier.alias("value_tier"))
            .groupBy("recency", "value_tier")
            .agg(F.count(F.lit(1)).alias("customers"),
                 avg_money("lifetime_revenue").alias("avg_first_order_value"))
            .orderBy("recency", "value_tier"))


def value_by_sequence(fact_order: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Order value of a customer's 1st, 2nd and 3rd order."""
    return (order_sequence(fact_order, depth=3).groupBy("order_seq")
            .agg(F.count(F.lit(1)).alias("orders"), avg_money("order_value").alias("avg_order_value"))
            .orderBy("order_seq"))


def new_customers_per_month(fact_order: DataFrame, dim_date: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """New customers per month in the sizing window, averaged and x12."""
    monthly = (order_sequence(fact_order, depth=1)
               .join(_dates(dim_date), "purchase_date_key")
               .filter(F.col("year_month").between(p.year_from, p.year_to))
               .groupBy("year_month").agg(F.count(F.lit(1)).alias("new_customers")))
    return monthly.agg(
        F.count(F.lit(1)).alias("months"),
        exact_ratio(F.sum("new_customers"), F.count(F.lit(1)), 0).alias("avg_new_customers_per_month"),
        exact_ratio(F.sum("new_customers"), F.count(F.lit(1)), 0, 12).alias("annualised_new_customers"),
    )


def campaign_targets(fact_order: DataFrame, dim_customer: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Retention-campaign target list as of ``as_of``.

    One-time buyers at or above the one-timer median spend whose order
    arrived ``contact_from_days``..``contact_to_days`` days ago, split 50/50
    into treatment and holdout by the parity of the last hex digit of their
    (SHA-256) customer key: stable across runs and engines.
    """
    one = dim_customer.filter(F.col("lifetime_fulfilled_orders") == 1)
    median = exact_percentile(one, "lifetime_revenue", 0.5, alias="m").scalar()
    delivered = (_fulfilled(fact_order).filter(F.col("delivery_days").isNotNull())
                 .select("customer_key",
                         F.date_add(F.to_date("purchased_at"), F.col("delivery_days")).alias("delivered_on")))
    since = F.datediff(F.lit(p.as_of).cast("date"), F.col("delivered_on"))
    last_digit = F.conv(F.substring("customer_key", -1, 1), 16, 10).cast("int")
    return (one.select("customer_key", "customer_unique_id", "customer_state", "lifetime_revenue")
            .withColumn("_above", F.col("lifetime_revenue") >= median)
            .filter(F.col("_above"))
            .join(delivered, "customer_key")
            .withColumn("days_since_delivery", since)
            .filter(F.col("days_since_delivery").between(p.contact_from_days, p.contact_to_days))
            .select("customer_unique_id", "customer_state", "delivered_on", "days_since_delivery",
                    F.col("lifetime_revenue").alias("first_order_value"),
                    F.when(last_digit % 2 == 0, "holdout").otherwise("treatment").alias("campaign_group"))
            .orderBy("delivered_on", "customer_unique_id"))


# query name -> (function, gold tables it reads, in argument order)
QUERIES = {
    "q1a_top_products": (top_products, ("fact_order_item", "dim_product")),
    "q1b_top_categories": (top_categories, ("fact_order_item", "dim_product")),
    "q1c_top_customers_revenue": (top_customers_by_revenue, ("dim_customer",)),
    "q1d_top_customers_orders": (top_customers_by_orders, ("dim_customer",)),
    "q2_monthly_revenue": (monthly_revenue, ("fact_order", "dim_date")),
    "q3_delivery_extremes": (delivery_extremes, ("fact_order", "dim_customer")),
    "q4_state_performance": (state_performance, ("fact_order", "dim_customer")),
    "q5_cohort_retention": (cohort_retention, ("fact_order", "dim_date")),
    "q6a_gap_histogram": (gap_histogram, ("fact_order",)),
    "q6b_repeat_variants": (repeat_rate_variants, ("fact_order",)),
    "q6c_repeat_by_review": (repeat_by_first_review, ("fact_order",)),
    "q7_basket_by_state": (basket_by_state, ("fact_order", "dim_customer")),
    "q8a_one_time_buyers": (one_time_buyers, ("dim_customer",)),
    "q8b_value_by_sequence": (value_by_sequence, ("fact_order",)),
    "q8c_new_customers": (new_customers_per_month, ("fact_order", "dim_date")),
    "x8_campaign_targets": (campaign_targets, ("fact_order", "dim_customer")),
}


def run(name: str, gold, p: Params = DEFAULT) -> DataFrame:
    """One analytics query; ``gold`` maps a gold table name to a DataFrame
    (a dict, or anything with ``__getitem__``)."""
    fn, inputs = QUERIES[name]
    return fn(*[gold[t] for t in inputs], p)


def run_all(gold: dict[str, DataFrame], p: Params = DEFAULT) -> dict[str, DataFrame]:
    """Every analytics query over a dict of gold tables."""
    return {name: run(name, gold, p) for name in QUERIES}
