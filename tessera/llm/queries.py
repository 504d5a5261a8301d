"""The registered queries of the llm operators, each over its whole table, and the DuckDB
SQL of those that SQL can express."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import held_out, read
from tessera.llm.fingerprints import edited_fingerprints
from tessera.llm.html_text import extract_main_text
from tessera.llm.infill import fill_in_middle, restored
from tessera.llm.langid import LanguageFilter, fit_language_filter, identify_language
from tessera.llm.licenses import NOTICES, scan_licenses
from tessera.llm.ngram_join import jaccard_components
from tessera.llm.packing import pack_pieces, tokenize_pieces
from tessera.llm.periods import find_runs, run_list, with_repeats
from tessera.llm.pieces import encode_pieces
from tessera.llm.quality import QualityModel, fit_quality, score_quality
from tessera.llm.topk import scaled, top_k
from tessera.llm.toxicity import ToxicityModel, fit_toxicity, score_toxicity
from tessera.llm.urls import UrlRule, filter_urls

Query = Callable[[SparkSession, str], DataFrame]

ROOT = str(Path(__file__).resolve().parents[2])

#: The rules of op6.
URL_RULES = [UrlRule("allow", "com", "/"), UrlRule("block", "example.com", "/en/"), UrlRule("allow", "www.example.com", "/en/"),
             UrlRule("block", "net", "/es/"), UrlRule("block", "net", "/fr/")]


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def language_model(documents: DataFrame) -> LanguageFilter:
    return fit_language_filter(documents.filter(~held_out()))


def toxicity_model(documents: DataFrame, labels: DataFrame) -> ToxicityModel:
    known = labels.filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    prior = min(0.5, max(0.001, toxic / n)) if n else 0.001
    return fit_toxicity(documents.filter(~held_out()), known.filter("toxic = 1").select("doc_id"), prior)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = identify_language(docs, language_model(docs), ["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "n_grams")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(read(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_pieces(read(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), decoded=True)
    spans = F.concat_ws(";", *[F.concat_ws(",", F.col(c).cast("array<string>")) for c in ("begins", "ends")])
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"), F.sha2(spans, 256).alias("spans_sha256"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", scaled("embedding").alias("v"))
    return top_k(rows, F.col("vec_id") % 100 == 0)


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity_model(docs, read(spark, sf_dir, "labels"))
    return score_toxicity(docs, model, ["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = tokenize_pieces(read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return pack_pieces(pieces)


def quality_held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32(doc_id as text) mod 5 is 0 (a null id is never held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def quality_model(documents: DataFrame, labels: DataFrame) -> QualityModel:
    good = labels.filter(~quality_held_out() & (F.col("quality") == 1)).select("doc_id")
    return fit_quality(documents.filter(~quality_held_out()), good)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(), 256).alias("restored_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    draw = F.crc32(F.col("doc_id").cast("string").cast("binary"))  # null without an id: the text stays
    out = find_runs(docs.select("doc_id", with_repeats(F.col("text"), draw).alias("text")))
    best = F.col("best")
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
                      best["period"].alias("period"), F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
                      F.sha2(run_list(), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = score_quality(docs, quality_model(docs, read(spark, sf_dir, "labels")))
    return out.select("doc_id", quality_held_out().alias("held_out"), "score", "predicted")


def with_package(query: Query) -> Query:
    """The query, with this package's folder on the path of Python workers that Spark starts where the
    driver runs (on a cluster the package is shipped with the job, e.g. by --py-files)."""
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        env = spark.sparkContext.environment
        if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
            env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH")]))
        return query(spark, sf_dir)
    return run


def queries() -> dict[str, Query]:
    every = (op1_license_scan, op2_language_id, op3_fingerprints, op4_sentencepiece, op5_exact_topk, op6_url_filters, op7_ngram_join, op8_html_extraction, op9_toxicity, op10_best_fit_packing,
             op11_fill_in_middle, op12_periodic_runs, op13_quality)
    return {f.__name__: with_package(f) for f in every}


OP6_SQL = """
WITH rules(verdict, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
       ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
u AS (SELECT row_number() OVER () AS r, page_id,
        translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
      FROM pages),
hits AS (SELECT u.*, rules.*, row_number() OVER (PARTITION BY r ORDER BY length(rhost) + length(rpath) DESC NULLS LAST,
                                               length(rhost) DESC, verdict DESC) AS k
         FROM u LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rhost || rpath AS rule, coalesce(verdict, 'allow') AS verdict FROM hits WHERE k = 1
"""


OP5_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


OP1_SQL = f"""
WITH t(license, body) AS (VALUES {", ".join(f"({_quoted(t.name)}, {_quoted(t.text)})" for t in NOTICES)}),
tw AS (SELECT license, list_filter(string_split(regexp_replace(lower(body), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> '') AS w FROM t),
ts AS (SELECT DISTINCT license, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT license, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM tw)),
tn AS (SELECT license, count(*) AS n FROM ts GROUP BY license),
dw AS (SELECT DISTINCT doc_id, list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> '') AS w
       FROM documents),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM dw WHERE len(w) > 0)),
m AS (SELECT doc_id, license, count(*) AS found FROM ds JOIN ts USING (s) GROUP BY doc_id, license)
SELECT doc_id, license, CAST(found AS DOUBLE) / n AS containment, found, n AS "of" FROM m JOIN tn USING (license) WHERE found >= n * 0.8
"""


OP11_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d,
                  regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w FROM documents),
h AS (SELECT *, len(w) AS n, CAST('0x' || d[1:8] AS BIGINT) AS h1, CAST('0x' || d[9:16] AS BIGINT) AS h2,
             CAST('0x' || d[17:24] AS BIGINT) AS h3, CAST('0x' || d[25:32] AS BIGINT) AS h4 FROM t),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS z,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(w[1:a], '') AS pre, array_to_string(w[a + 1:z], '') AS mid, array_to_string(w[z + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": OP1_SQL, "op5_exact_topk": OP5_SQL, "op6_url_filters": OP6_SQL, "op11_fill_in_middle": OP11_SQL}
