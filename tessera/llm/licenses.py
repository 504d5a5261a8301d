"""License scans: MinHash bands over overlapping text windows, then exact containment.

Texts and templates are cut into ``SHINGLE``-word shingles of lower-case letters and digits. A
text is covered by windows of W shingles, each overlapping the next by half, for the few
window sizes that the templates use; a template is covered by windows at every offset, so a
text window inside an unchanged copy equals a template window. A window has ``bands`` MinHash
values of one row each: windows that share half of their shingles collide in some band with
probability 1 - 0.5 ** 8 = 0.996, equal windows always. Colliding (document, template) pairs are then
verified: the share of the template's distinct shingles that the whole text contains,
compared as text, must reach ``least``.

Built-in functions only. The templates are a bounded list (``MAX_WORDS``, checked), so their
shingles and their band index are broadcast. A first pass streams the texts' shingles past those of
the templates: a text that has none of them cannot collide, and its windows are not hashed. Only the
few documents with such a shingle are shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
SIZES = (1, 4, 16)  # window sizes in shingles
MAX_WORDS = 200_000
#: A window pair that shares this part of its shingles collides with probability COLLISION.
ALIKE, COLLISION = 0.5, 0.995


@dataclass(frozen=True)
class License:
    name: str
    text: str


# Wordings of public licenses and of the notices by which works name them.
NOTICES = (
    License("MIT", "Released under the MIT License."),
    License("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    License("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    License("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    License("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    License("Apache-2.0-header", "Unless required by applicable law or agreed to in writing, software distributed under the License "
            "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
            "License for the specific language governing permissions and limitations under the License."),
    License("GPL-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
            "option) any later version."),
    License("BSD-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met:"),
)


def bands_for(alike: float = ALIKE, collision: float = COLLISION) -> int:
    """Bands of one row that let windows with similarity ``alike`` collide with probability ``collision``."""
    return math.ceil(math.log(1 - collision) / math.log(1 - alike))


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    return F.filter(F.split(plain, " "), lambda w: w != "")


def _with_shingles(df: DataFrame, hashed: bool) -> DataFrame:
    """Adds ``s``: the shingles of the array ``w`` in order, as hashes or as text; a shorter text is one shingle."""
    w = F.col("w")

    def one(i):
        parts = [F.get(w, i + j) for j in range(SHINGLE)]
        return F.xxhash64(*parts) if hashed else F.concat_ws(" ", *parts)

    kind = "array<bigint>" if hashed else "array<string>"
    return df.withColumn("s", F.when(F.size(w) == 0, F.array().cast(kind)).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - SHINGLE, F.lit(0))), one)))


def _with_permutations(df: DataFrame, bands: int) -> DataFrame:
    """Adds ``h0``, ``h1`` ...: every shingle's hash in each band, worked out once for all windows."""
    def permuted(band):
        return F.transform("s", lambda h: F.xxhash64(h, F.lit(band)))

    return df.withColumns({f"h{band}": permuted(band) for band in range(bands)})


def _window_keys(size: int, stride: int, bands: int) -> Column:
    """Band keys of all windows of ``size`` shingles of the array ``s`` (see ``_with_permutations``), ``stride``
    apart and one at the end."""
    s = F.col("s")
    if size == 1:
        return F.transform(s, lambda h: F.xxhash64(h, F.lit(1)))
    end = F.greatest(F.size(s) - size, F.lit(0))
    starts = F.array_union(F.sequence(F.lit(0), end, F.lit(stride)), F.array(end))

    def keys(at):
        # past the end of a short text there are nulls, which least() skips
        low = [F.least(*[F.get(F.col(f"h{band}"), at + i) for i in range(size)]) for band in range(bands)]
        return F.array(*[F.xxhash64(x, F.lit(size), F.lit(band)) for band, x in enumerate(low)])

    return F.when(F.size(s) > 0, F.flatten(F.transform(starts, keys))).otherwise(F.array().cast("array<bigint>"))


def size_for(shingles: int) -> int:
    """The largest window of which one lies wholly inside a copy of a template of so many shingles."""
    return max(w for w in SIZES if w == 1 or shingles >= w + w // 2 - 1)


def with_known_shingles(docs: DataFrame, known: DataFrame) -> DataFrame:
    """The distinct rows (id, text) with one of the shingles ``known`` at least. Windows collide in a band when their least
    hashes are equal, so when they share the shingle that has it: other texts collide with no template."""
    held = _with_shingles(docs.withColumn("w", words_of(F.col("text"))), hashed=True).select("id", "text", F.explode_outer("s").alias("shingle"))
    return held.join(F.broadcast(known.distinct()), "shingle").select("id", "text").distinct()


def scan_licenses(df: DataFrame, templates: tuple[License, ...] = NOTICES, id_col: str = "doc_id", text_col: str = "text",
                  least: float = 0.8) -> DataFrame:
    """(id, license, containment double, found long, of long): one row for each document and template
    of which it holds at least ``least`` of the distinct shingles. Null, empty and other texts
    without such shingles give no row; a template without words is refused. Rows equal in id
    and text count once."""
    if sum(len(t.text.split()) for t in templates) > MAX_WORDS:
        raise ValueError(f"templates of over {MAX_WORDS} words; their index is broadcast")
    bands = bands_for()
    spark = df.sparkSession
    known = spark.createDataFrame([(t.name, t.text) for t in templates], "license string, text string")
    known = known.withColumn("w", words_of(F.col("text")))
    told = _with_shingles(known, hashed=False).select("license", F.array_distinct("s").alias("shingles"))
    sizes = {r.license: r.n for r in told.select("license", F.size("shingles").alias("n")).collect()}
    if not all(sizes.values()):
        raise ValueError("a template without words")
    hashed = _with_permutations(_with_shingles(known, hashed=True), bands)
    used = sorted({size_for(n) for n in sizes.values()})
    index = None
    for size in used:
        names = [k for k, n in sizes.items() if size_for(n) == size]
        part = hashed.filter(F.col("license").isin(names)).select(
            "license", F.explode_outer(F.array_distinct(_window_keys(size, 1, bands))).alias("key"))
        index = part if index is None else index.unionByName(part)
    index = index.distinct()

    docs = with_known_shingles(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), hashed.select(F.explode("s").alias("shingle")))
    docs = _with_shingles(docs.withColumn("w", words_of(F.col("text"))), hashed=True)
    docs = _with_permutations(docs.select("id", "text", "s"), bands)
    keys = F.array_distinct(F.flatten(F.array(*[_window_keys(size, max(1, size // 2), bands) for size in used])))
    docs = docs.select("id", "text", keys.alias("keys"))
    # explode_outer: for explode() Spark infers a filter on the array's size and works it out a second time
    hits = (docs.select("id", "text", F.explode_outer("keys").alias("key")).join(F.broadcast(index), "key")
            .groupBy("id", "text", "license").agg(F.count(F.lit(1)).alias("collisions")))
    whole = _with_shingles(hits.withColumn("w", words_of(F.col("text"))), hashed=False).select("id", "license", "s")
    both = whole.join(F.broadcast(told), "license").select(
        "id", "license", F.size(F.array_intersect("shingles", "s")).cast("long").alias("found"), F.size("shingles").cast("long").alias("of"))
    return both.filter(F.col("found") >= F.col("of") * least).select(
        F.col("id").alias(id_col), "license", (F.col("found") / F.col("of")).alias("containment"), "found", "of")
