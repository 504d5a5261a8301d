"""URL filters by host-suffix and path-prefix expressions.

Each URL is expanded into its host suffixes x path prefixes (only of the label
counts and path lengths that some rule has, so nothing that could match is left
out). Expression and rule meet in an equi-join on a short prefix of the SHA-256 of
``host + path``; the full digests confirm a match, and the longest rule wins.

Plan: the rules are a bounded list (``MAX_RULES``, checked), so their side is
broadcast and the expanded expressions stream past it without a shuffle; what is
left is one partially aggregated exchange per URL row. Built-in functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_RULES = 200_000
PREFIX_HEX = 8  # hex digits of the digest that are joined on
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    verdict: str  # allow or block
    host: str
    path: str


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def filter_urls(pages: DataFrame, rules: list[UrlRule], id_col: str = "page_id", url_col: str = "url",
                default: str = "allow") -> DataFrame:
    """(id, url, host, path, rule, verdict) for every row. ``rule`` is host + path of the rule that
    decides, null if none fits; then the verdict is ``default``. A rule fits its host and all
    its subdomains if the path starts with the rule's. Between rules the longest wins (host
    and path together; then the longer host; of a repeated rule, block). Null urls have
    empty host and path. Repeated rows come out as often as they came in."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the broadcast side is bounded by {MAX_RULES}")
    spark: SparkSession = pages.sparkSession
    table = spark.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, rhost string, rpath string")
    digest = F.sha2(F.concat("rhost", "rpath"), 256)
    table = table.select(F.substring(digest, 1, PREFIX_HEX).alias("prefix"), digest.alias("digest"), "rhost",
                         F.struct((F.length("rhost") + F.length("rpath")).alias("size"), F.length("rhost").alias("hosts"),
                                  F.col("verdict").alias("verdict"), F.concat("rhost", "rpath").alias("rule")).alias("hit"))
    labels = sorted({r.host.count(".") + 1 for r in rules if r.host})
    lengths = sorted({len(r.path) for r in rules})
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    rows = rows.withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    parts = F.split("host", r"\.")
    # equal rows are counted, so that the aggregate below can give each of them back
    rows = rows.groupBy("id", "url", "host", "path").agg(F.count(F.lit(1)).alias("copies"))
    hosts = F.filter(F.array(*[F.when((F.size(parts) >= n) & (F.col("host") != ""), F.substring_index("host", ".", -n))
                               for n in labels]) if labels else F.array().cast("array<string>"), lambda h: h.isNotNull())
    paths = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths])
                     if lengths else F.array().cast("array<string>"), lambda p: p.isNotNull())
    expressions = F.array_distinct(F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.struct(
        h.alias("host"), F.concat(h, p).alias("expression"))))))
    wide = rows.withColumn("e", F.explode_outer(expressions)).withColumn("digest", F.sha2(F.col("e.expression"), 256))
    wide = wide.withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))
    t = F.broadcast(table.select("prefix", F.col("digest").alias("rdigest"), "rhost", "hit"))
    same = (wide["prefix"] == t["prefix"]) & (wide["digest"] == t["rdigest"]) & (F.col("e.host") == t["rhost"])
    best = wide.join(t, same, "left").groupBy("id", "url", "host", "path").agg(
        F.max("hit").alias("hit"), F.first("copies").alias("copies"))
    return (best.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select(F.col("id").alias(id_col), F.col("url").alias(url_col), "host", "path",
                    F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit(default)).alias("verdict")))
