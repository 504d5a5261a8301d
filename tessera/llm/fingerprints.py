"""Document fingerprints by consistent weighted sampling.

A document is a weighted set: each run of ``words`` words with the number of times it occurs. For
sample k every term draws, from its own hash alone, r and c from Gamma(2, 1) and b from [0, 1);
with weight w it is quantised to t = floor(ln w / r + b) and gets the value
c / (exp(r (t - b)) * exp(r)). The term of the least value, with its t, is the sample. Two
documents agree in a sample with the probability of their generalised Jaccard similarity
(sum of least weights / sum of greatest), so the share of equal samples estimates it.

Built-in functions only. Values are compared as logarithms in fixed point; the high bits of a
long hold the value and the low bits the sample's hash, so a plain min() keeps both.

``edited_fingerprints`` also needs the next document in descending id order for every
document. The order is cut at id quantiles (a bounded list), a document's bucket is a function of
its id alone, and the first document of a bucket is dealt to the one before it as well, so
each bucket is ordered by itself: one shuffle of the texts in all, and no global sort.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLES = 16
WORDS = 2
_ID_BITS = 29
_SCALE = float(1 << 24)


def term_hashes(text: Column, words: int) -> Column:
    """Hashes of all runs of ``words`` words in order; a text with fewer is one run; white space cuts words."""
    parts = F.filter(F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " "), lambda w: w != "")
    return F.transform(parts, lambda w: F.xxhash64(w))


def _runs(hashes: str, words: int) -> Column:
    h = F.col(hashes)

    def run(i):
        return F.xxhash64(*[F.get(h, i + j) for j in range(words)])
    n = F.size(h)
    return F.when(n >= words, F.transform(F.sequence(F.lit(0), n - words), run)).when(
        n > 0, F.array(F.xxhash64(h, F.lit(words)))).otherwise(F.array().cast("array<bigint>"))


def weighted_terms(df: DataFrame, columns: dict[str, str], words: int) -> DataFrame:
    """Adds, for each text column -> name, an array of (term, ln of its weight)."""
    df = df.withColumns({f"_h_{n}": term_hashes(F.col(c), words) for c, n in columns.items()})
    df = df.withColumns({f"_s_{n}": F.sort_array(_runs(f"_h_{n}", words)) for n in columns.values()})
    def starts(n):
        s = F.col(f"_s_{n}")
        return F.filter(F.transform(s, lambda x, i: F.when((i == 0) | (F.get(s, i - 1) != x), i)), lambda i: i.isNotNull())

    df = df.withColumns({f"_b_{n}": starts(n) for n in columns.values()})

    def weighted(n):
        s, b = F.col(f"_s_{n}"), F.col(f"_b_{n}")
        return F.transform(b, lambda at, i: F.struct(
            F.get(s, at).alias("term"), F.log((F.coalesce(F.get(b, i + 1), F.size(s)) - at).cast("double")).alias("lw")))

    df = df.withColumns({n: weighted(n) for n in columns.values()})
    return df.drop(*[f"{p}{n}" for p in ("_h_", "_s_", "_b_") for n in columns.values()])


def _uniform(bits: Column, shift: int, n: int) -> Column:
    """n bits of a long as a number inside (0, 1)."""
    x = F.shiftrightunsigned(bits, shift) if shift else bits
    return (x.bitwiseAND(F.lit((1 << n) - 1)).cast("double") + F.lit(0.5)) * F.lit(math.ldexp(1.0, -n))


def sample_value(term: str, log_weight: str, k: int) -> Column:
    """The term's value in sample k: fixed-point ln of c / (y exp(r)), then a hash of (term, t)."""
    x, y = F.xxhash64(term, F.lit(2 * k)), F.xxhash64(term, F.lit(2 * k + 1))
    r = -F.log(_uniform(x, 0, 21) * _uniform(x, 21, 21))
    b = _uniform(x, 42, 22)
    t = F.floor(F.col(log_weight) / r + b)
    value = F.log(-F.log(_uniform(y, 0, 31) * _uniform(y, 33, 31))) - r * (t - b) - r
    fixed = F.floor((F.greatest(F.lit(-255.0), value) + 256.0) * _SCALE)
    name = F.xxhash64(term, t).bitwiseAND(F.lit((1 << _ID_BITS) - 1))
    return F.shiftleft(fixed, _ID_BITS).bitwiseOR(name)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples of two fingerprint arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x.eqNullSafe(y), 1.0).otherwise(0.0)), F.lit(0.0),
                       lambda s, x: s + x) / F.greatest(F.size(a), F.lit(1)).cast("double")


def fingerprint_text(samples: Column) -> Column:
    """Samples as fixed-width hexadecimal text; ``-`` for a text without words."""
    return F.when(F.get(samples, 0).isNull(), F.lit("-")).otherwise(
        F.concat_ws("", F.transform(samples, lambda x: F.lower(F.lpad(F.hex(x), 8, "0")))))


def fingerprints(df: DataFrame, key_cols: list[str], texts: dict[str, str], samples: int = SAMPLES, words: int = WORDS) -> DataFrame:
    """``key_cols`` and, for each text column -> name, an array of ``samples`` sample hashes (nulls for a
    text without words). ``key_cols`` must tell the rows apart; if the rows are already dealt by
    some of them no further shuffle is needed. Other columns are lost."""
    names = list(texts.values())
    wide = weighted_terms(df.select(*key_cols, *dict.fromkeys(texts)), texts, words)

    def tagged(i, n):
        return F.transform(F.col(n), lambda x: F.struct(F.lit(i).alias("which"), x["term"].alias("term"), x["lw"].alias("lw")))

    every = F.flatten(F.array(*[tagged(i, n) for i, n in enumerate(names)]))
    long = wide.select(*key_cols, F.explode_outer(every).alias("e")).select(
        *key_cols, F.col("e.which").alias("which"), F.col("e.term").alias("term"), F.col("e.lw").alias("lw"))
    least = long.groupBy(*key_cols, "which").agg(*[F.min(sample_value("term", "lw", k)).alias(f"m{k}") for k in range(samples)])
    mask = F.lit((1 << _ID_BITS) - 1)
    one = least.select(*key_cols, "which", F.array(*[F.col(f"m{k}").bitwiseAND(mask) for k in range(samples)]).alias("f"))
    empty = F.array_repeat(F.lit(None).cast("bigint"), samples)
    return one.groupBy(*key_cols).agg(*[F.coalesce(F.max(F.when(F.col("which") == i, F.col("f"))), empty).alias(n)
                                        for i, n in enumerate(names)])


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES,
                        words: int = WORDS, buckets: int | None = None) -> DataFrame:
    """For every row: (id, n_chars, edited text's sha256, fingerprint, edited fingerprint, near_edited,
    near_next). The edited text has the last floor(n_chars / 2) code points replaced by the first as
    many (or all) of the next document's in descending id order; after the last comes the first.
    Null texts are empty; two texts without words have equal fingerprints. Equal ids are ordered by
    their text; null ids come last. Repeated rows come out as often as they came in."""
    spark = docs.sparkSession
    buckets = buckets or min(4096, 8 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    marks = rows.agg(F.max("id"), F.percentile_approx("id", [i / buckets for i in range(1, buckets)], 20 * buckets)).first()
    bounds = sorted({marks[0], *(marks[1] or [])} - {None}, reverse=True)  # ids that occur, the greatest first
    last = max(0, len(bounds) - 1)
    if bounds:
        ids = F.array(*[F.lit(b) for b in bounds])
        at = F.when(F.col("id").isNull(), last).otherwise(F.size(F.filter(ids, lambda b: b >= F.col("id"))) - 1)
        rows = rows.withColumn("bucket", at.cast("int"))
        # a bucket's greatest id is a bound: the rows with it also end the bucket before, the first bucket's the last
        is_first = F.col("id") == F.get(ids, F.col("bucket"))
        before = F.when(F.col("bucket") == 0, last).otherwise(F.col("bucket") - 1)
        place = F.array_compact(F.array(F.struct(F.col("bucket"), F.lit(0).alias("ghost")), F.when(is_first, F.struct(
            before.cast("int").alias("bucket"), F.lit(1).alias("ghost")))))
        rows = rows.select("id", "text", F.explode(place).alias("p")).select("id", "text", "p.bucket", "p.ghost")
    else:  # no ids at all: one order by text
        rows = rows.withColumns({"bucket": F.lit(0), "ghost": F.lit(0)})
    order = Window.partitionBy("bucket").orderBy("ghost", F.desc_nulls_last("id"), "text")
    rows = rows.withColumns({"next": F.lead("text").over(order), "rank": F.row_number().over(order)})
    if not bounds:
        rows = rows.withColumn("next", F.coalesce("next", F.first("text").over(order)))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring(F.coalesce("next", F.lit("")), F.lit(1), half))
    rows = rows.withColumns({"edited": F.when(F.col("ghost") == 0, edited), "n_chars": F.length("text").cast("long")})
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    key = ["bucket", "rank", "ghost", "id", "n_chars", "edited_sha256"]
    prints = fingerprints(rows, key, {"text": "own", "edited": "new"}, samples, words)
    # rows of a bucket are still together and in rank order: the next one's fingerprint is a lead away
    follow = Window.partitionBy("bucket").orderBy("rank")
    prints = prints.withColumn("after", F.lead("own").over(follow))
    if not bounds:
        prints = prints.withColumn("after", F.coalesce("after", F.first("own").over(follow)))
    return prints.filter("ghost = 0").select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", fingerprint_text(F.col("own")).alias("fingerprint"),
        fingerprint_text(F.col("new")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("new")).alias("near_edited"),
        likeness(F.col("own"), F.col("after")).alias("near_next"))
