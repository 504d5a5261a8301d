"""Driver tables -> bronze-shaped retail tables.

The driver's parquet tables are TPC-H-like. This module maps them onto the
nine all-STRING bronze tables of the retail model (customers, geolocation,
order_items, order_payments, order_reviews, orders, products, sellers,
product_category_translation) with deterministic integer arithmetic on the
keys, so that an independent SQL engine can reproduce every value.

Each bronze table carries ``_source_file`` (the parquet file it came from)
and ``_loaded_at`` like a CSV landing would. Every view is a lazy plan over
the driver tables: its work grows with them.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the mapping (see FIXTURES.md, part B).
LOADED_AT = "2001-08-02 00:00:00"  # landing time stamped on every bronze row
TRANSLATED_CATEGORIES = ("economy", "promo", "standard", "large")  # have an English name
PAYMENT_TYPES = ("boleto", "voucher", "credit_card")  # by order key mod 4: 0, 1, else
REVIEW_TITLE_OK = "ok"
REVIEW_EXTRA_MESSAGE = "extra review"

BRONZE_TABLES = (
    "customers",
    "geolocation",
    "order_items",
    "order_payments",
    "order_reviews",
    "orders",
    "products",
    "sellers",
    "product_category_translation",
)


def read_table(spark: SparkSession, sf_dir: str, name: str, with_file: bool = False) -> DataFrame:
    """One driver table (a parquet scan: filters and projections push down).

    ``with_file`` adds ``_source_file``, taken at the scan, before any
    shuffle. How many splits a table has is the matter of the job that
    lands it (file and row-group size), not of its readers.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if with_file:
        # input_file_name() rather than _metadata.file_path: when a later
        # projection drops the column (silver does), the hidden _metadata
        # struct is not pruned cleanly and the scan reads every metadata
        # field, including per-row indexes.
        df = df.withColumn("_source_file", F.input_file_name())
    return df


def _s(c: Column) -> Column:
    return c.cast("string")


def _zip(c: Column) -> Column:
    """A 5-digit prefix with leading zeros; a longer key is an error, never cut."""
    text = c.cast("string")
    return F.when(F.length(text) > 5, F.raise_error(F.concat(F.lit("zip prefix of over 5 digits: "), text))).otherwise(
        F.lpad(text, 5, "0"))


def _lineage(loaded_at: str) -> list[Column]:
    """Lineage of a view: its primary table's file and the landing time."""
    return [F.col("_source_file"), F.lit(loaded_at).cast("timestamp").alias("_loaded_at")]


def _plus(ts: Column, days: Column | int = 0, hours: Column | int = 0,
          minutes: Column | int = 0) -> Column:
    def as_int(v):
        return (F.lit(v) if isinstance(v, int) else v).cast("int")
    return ts + F.make_dt_interval(as_int(days), as_int(hours), as_int(minutes))


def bronze_orders(spark: SparkSession, sf_dir: str, loaded_at: str = LOADED_AT) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", with_file=True)
    k = F.col("o_orderkey")
    base = F.col("o_orderdate")
    status = (F.when(F.col("o_orderstatus") == "F", "delivered")
               .when(F.col("o_orderstatus") == "O", "shipped")
               .when(k % 10 == 0, "canceled")
               .when(k % 10 == 1, "unavailable")
               .otherwise("processing"))
    purchased = _plus(base, minutes=(k * 7919) % 1440)
    delivery_days = 2 + (k * 31) % 41 + F.when(k % 37 == 0, k % 60).otherwise(0)
    return o.select(
        _s(F.concat(F.lit("o"), _s(k))).alias("order_id"),
        F.concat(F.lit("oc"), _s(k)).alias("customer_id"),
        status.alias("order_status"),
        _s(purchased).alias("order_purchase_timestamp"),
        _s(F.when(status != "canceled", _plus(purchased, hours=k % 6 + 1))).alias("order_approved_at"),
        _s(F.when(F.col("o_orderstatus").isin("F", "O"), _plus(base, days=1, hours=k % 12))
           ).alias("order_delivered_carrier_date"),
        _s(F.when(F.col("o_orderstatus") == "F", _plus(base, days=delivery_days, hours=k % 24))
           ).alias("order_delivered_customer_date"),
        _s(_plus(base, days=25)).alias("order_estimated_delivery_date"),
        *_lineage(loaded_at),
    )


def bronze_customers(spark: SparkSession, sf_dir: str, loaded_at: str = LOADED_AT) -> DataFrame:
    """One customer record per order (the order-customer), as in the source system."""
    o = read_table(spark, sf_dir, "orders", with_file=True).select(
        "o_orderkey", "o_custkey", *_lineage(loaded_at))
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # nation is a fixed 25-row dimension
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("o_orderkey")
    return (o.join(c, o.o_custkey == c.c_custkey)
             .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
             .select(
                 F.concat(F.lit("oc"), _s(k)).alias("customer_id"),
                 F.concat(F.lit("u"), _s(F.col("o_custkey")), F.lit("-"), _s(k % 7)
                          ).alias("customer_unique_id"),
                 _zip(F.col("c_nationkey") + F.when(k % 10 == 0, 25).otherwise(0)
                      ).alias("customer_zip_code_prefix"),
                 F.lower(F.col("c_mktsegment")).alias("customer_city"),
                 F.col("n_name").alias("customer_state"),
                 "_source_file", "_loaded_at"))


def bronze_sellers(spark: SparkSession, sf_dir: str, loaded_at: str = LOADED_AT) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", with_file=True).select(
        "s_suppkey", "s_nationkey", *_lineage(loaded_at))
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
             .select(F.concat(F.lit("s"), _s(F.col("s_suppkey"))).alias("seller_id"),
                     _zip(F.col("s_nationkey")).alias("seller_zip_code_prefix"),
                     F.lit("hub").alias("seller_city"),
                     F.col("n_name").alias("seller_state"),
                     "_source_file", "_loaded_at"))


def bronze_geolocation(spark: SparkSession, sf_dir: str, loaded_at: str = LOADED_AT) -> DataFrame:
    """Coordinates per customer, for nations with key mod 7 != 3; customers with
    key mod 4 = 0 appear twice (exact duplicates)."""
    c = read_table(spark, sf_dir, "customer", with_file=True).select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment", *_lineage(loaded_at))
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    copies = F.when(F.col("c_custkey") % 4 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    bal = F.col("c_acctbal").cast("decimal(12,2)")
    return (c.filter(F.col("c_nationkey") % 7 != 3)
             .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
             .select(F.explode(copies).alias("_copy"), "*")
             .select(_zip(F.col("c_nationkey")).alias("geolocation_zip_code_prefix"),
                     _s(bal).alias("geolocation_lat"),
                     _s(-bal).alias("geolocation_lng"),
                     F.col("c_mktsegment").alias("geolocation_city"),
                     F.col("n_name").alias("geolocation_state"),
                     "_source_file", "_loaded_at"))


def bronze_products(spark: SparkSession, sf_dir: str, loaded_at: str = LOADED_AT) -> DataFrame:
    p = read_table(spark, sf_dir, "part", with_file=True)
    key = F.col("p_partkey")
    size = F.col("p_size")
    return p.select(
        F.concat(F.lit("p"), _s(key)).alias("product_id"),
        F.when(key % 50 != 0, F.lower(F.col("p_type"))).alias("product_category_name"),
        _s(F.length("p_name")).alias("product_name_lenght"),
        _s(F.length("p_name") + F.length("p_type")).alias("product_description_lenght"),
        _s(size % 6).alias("product_photos_qty"),
        _s(size * 100).alias("product_weight_g"),
        _s(size).alias("product_length_cm"),
        _s(size % 10 + 1).alias("product_height_cm"),
        F.when(key % 20 != 0, F.lit("5")).alias("product_width_cm"),
        *_lineage(loaded_at),
    )


def bronze_category_translation(spark: SparkSession, sf_dir: str,
                                loaded_at: str = LOADED_AT) -> DataFrame:
    """English names for the translated product types (derived from ``part``)."""
    cat = F.lower(F.col("p_type"))
    return (read_table(spark, sf_dir, "part")
            .select(cat.alias("product_category_name"))
            .filter(F.col("product_category_name").isin(*TRANSLATED_CATEGORIES))
            .distinct()
            .select("product_category_name",
                    F.concat(F.lit("en_"), F.col("product_category_name")
                             ).alias("product_category_name_english"),
                    F.lit(f"{sf_dir}/part.parquet").alias("_source_file"),
                    F.lit(loaded_at).cast("timestamp").alias("_loaded_at")))


def bronze_order_items(spark: SparkSession, sf_dir: str, loaded_at: str = LOADED_AT,
                       profiling: bool = False) -> DataFrame:
    """lineitem with its natural duplicate (order, line) keys.

    ``profiling=True`` gives the copy used by the cast check, where the price
    of every order with key mod 97 = 0 is the unparseable text 'n/a'.
    """
    li = read_table(spark, sf_dir, "lineitem", with_file=True)
    price = F.col("l_extendedprice").cast("decimal(10,2)")
    freight = (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(10,2)")
    price_text = _s(price)
    if profiling:
        price_text = F.when(F.col("l_orderkey") % 97 == 0, F.lit("n/a")).otherwise(price_text)
    return li.select(
        F.concat(F.lit("o"), _s(F.col("l_orderkey"))).alias("order_id"),
        _s(F.col("l_linenumber")).alias("order_item_id"),
        F.concat(F.lit("p"), _s(F.col("l_partkey"))).alias("product_id"),
        F.concat(F.lit("s"), _s(F.col("l_suppkey"))).alias("seller_id"),
        _s(F.col("l_shipdate")).alias("shipping_limit_date"),
        price_text.alias("price"),
        _s(freight).alias("freight_value"),
        *_lineage(loaded_at),
    )


def bronze_order_payments(spark: SparkSession, sf_dir: str, loaded_at: str = LOADED_AT) -> DataFrame:
    """Sequence 1 for every order but key mod 200 = 7; a second (voucher)
    instrument splits 60/40 when key mod 3 = 0."""
    o = read_table(spark, sf_dir, "orders", with_file=True)
    k = F.col("o_orderkey")
    split = k % 3 == 0
    total = F.col("o_totalprice").cast("decimal(12,2)")
    seqs = F.when(split, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    seq = F.col("_seq")
    first_type = (F.when(k % 4 == 0, PAYMENT_TYPES[0])
                   .when(k % 4 == 1, PAYMENT_TYPES[1])
                   .otherwise(PAYMENT_TYPES[2]))
    share = (F.when(seq == 2, F.lit(Decimal("0.40")))
              .when(split, F.lit(Decimal("0.60")))
              .otherwise(F.lit(Decimal("1.00"))))
    return (o.filter(k % 200 != 7)
             .select("*", F.explode(seqs).alias("_seq"))
             .select(F.concat(F.lit("o"), _s(k)).alias("order_id"),
                     _s(seq).alias("payment_sequential"),
                     F.when(seq == 2, F.lit(PAYMENT_TYPES[1])).otherwise(first_type).alias("payment_type"),
                     _s(F.when(seq == 2, F.lit(1)).otherwise(k % 10 + 1)).alias("payment_installments"),
                     _s((total * share).cast("decimal(12,2)")).alias("payment_value"),
                     *_lineage(loaded_at)))


def bronze_order_reviews(spark: SparkSession, sf_dir: str, loaded_at: str = LOADED_AT) -> DataFrame:
    """Review n (n = k-1 when k mod 20 = 1, else k) on order k for k mod 9 != 4,
    so some reviews cover two orders; orders with k mod 50 = 3 get a second
    review 'x<k>'. Creation dates follow the order, so a shared review has two
    differing rows that dedupe must resolve."""
    o = read_table(spark, sf_dir, "orders", with_file=True)
    k = F.col("o_orderkey")
    n = F.when(k % 20 == 1, k - 1).otherwise(k)
    created = _plus(F.col("o_orderdate"), days=30)
    main = F.when(k % 9 != 4, F.struct(
        F.concat(F.lit("r"), _s(n)).alias("review_id"),
        _s(1 + (n * 31) % 5).alias("review_score"),
        F.when(n % 4 == 1, F.lit("   "))
         .when(n % 4 == 2, F.concat(F.lit("  great "), _s(n), F.lit(" ")))
         .when(n % 4 == 3, F.lit(REVIEW_TITLE_OK)).alias("review_comment_title"),
        F.when(n % 3 == 0, F.concat(F.lit("line one\nline two "), _s(n))).alias("review_comment_message"),
        _s(created).alias("review_creation_date"),
        _s(_plus(created, days=n % 5, hours=3)).alias("review_answer_timestamp"),
    ))
    extra = F.when(k % 50 == 3, F.struct(
        F.concat(F.lit("x"), _s(k)).alias("review_id"),
        _s(1 + k % 5).alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.lit(REVIEW_EXTRA_MESSAGE).alias("review_comment_message"),
        _s(created).alias("review_creation_date"),
        F.lit(None).cast("string").alias("review_answer_timestamp"),
    ))
    rows = F.filter(F.array(main, extra), lambda r: r.isNotNull())
    return (o.select(F.concat(F.lit("o"), _s(k)).alias("order_id"),
                     F.explode(rows).alias("r"), *_lineage(loaded_at))
             .select("r.review_id", "order_id", "r.review_score", "r.review_comment_title",
                     "r.review_comment_message", "r.review_creation_date",
                     "r.review_answer_timestamp", "_source_file", "_loaded_at"))


BUILDERS = {
    "customers": bronze_customers,
    "geolocation": bronze_geolocation,
    "order_items": bronze_order_items,
    "order_payments": bronze_order_payments,
    "order_reviews": bronze_order_reviews,
    "orders": bronze_orders,
    "products": bronze_products,
    "sellers": bronze_sellers,
    "product_category_translation": bronze_category_translation,
}


def bronze_views(spark: SparkSession, sf_dir: str, loaded_at: str = LOADED_AT) -> dict[str, DataFrame]:
    """All nine bronze tables as lazy DataFrames."""
    return {name: BUILDERS[name](spark, sf_dir, loaded_at) for name in BRONZE_TABLES}
