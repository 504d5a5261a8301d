"""Core operators applied straight to driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import date_key, surrogate_key, text
from tessera.operators.conform import dedupe
from tessera.sources.retail_views import read_table


def dedupe_line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lineitem row per (order, line); ties broken on every other
    column in name order, ascending, NULLs last."""
    return dedupe(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 over every document: whole text trimmed of spaces at both ends,
    empty -> NULL, inner line breaks kept."""
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", "lang", text("text").alias("text"),
                    F.length(text("text")).alias("clean_chars"))


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4/T5: hash keys of single and composite natural keys, and date keys."""
    c = read_table(spark, sf_dir, "customer")
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return c.join(o, c.c_custkey == o.o_custkey).select(
        "o_orderkey", "c_custkey",
        surrogate_key(F.col("c_custkey").cast("string")).alias("customer_key"),
        surrogate_key("c_mktsegment", F.col("c_nationkey").cast("string")).alias("segment_key"),
        date_key("o_orderdate").alias("order_date_key"))
