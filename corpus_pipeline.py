"""A corpus pipeline over ``documents``: language ID, toxicity, near duplicates, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and reread as the next one's docs. All but the last
return the columns of ``documents``. ``run`` applies them in order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import read
from tessera.llm.langid import UNDETERMINED, identify_language
from tessera.llm.ngram_join import jaccard_representatives, text_mark
from tessera.llm.packing import pack_pieces, tokenize_pieces
from tessera.llm.queries import language_model, tokenizer_file, toxicity_model, with_package
from tessera.llm.toxicity import score_toxicity
from tessera.session import scratch_path

#: A text none of whose languages reaches this score is rejected as not in a known language.
LEAST_LANGUAGE_SCORE = 0.05


#: Bytes of text that a stage between two others works on at a time: its workers share an executor with its Parquet writers.
SLICE_BYTES = 1 << 20


def _hidden(docs: DataFrame) -> tuple[DataFrame, list[str], str]:
    """``docs`` with columns ``_doc0`` on, names that no operator adds; these names; the one of the text."""
    names = [f"_doc{i}" for i in range(len(docs.columns))]
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)]), names, names[docs.columns.index("text")]


def _shown(judged: DataFrame, docs: DataFrame) -> DataFrame:
    return judged.select(*[F.col(f"_doc{i}").alias(c) for i, c in enumerate(docs.columns)])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents in a learned language; null, empty and letterless texts go. Learned
    from the rows of ``docs`` with a language that are not held out; predicted for all. Repeated rows are judged one by one; columns of
    any other name come through."""
    rows, names, text = _hidden(docs)
    judged = identify_language(rows, language_model(docs), names, text)
    return _shown(judged.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)), docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents predicted not toxic. Learned from this stage's docs and the labels that are not held out.
    Null and empty texts are no likelier toxic than texts are; repeated rows are judged one by one; a null id has no label. Columns of any
    other name come through."""
    model = toxicity_model(docs, read(spark, sf_dir, "labels"))
    rows, names, text = _hidden(docs)
    judged = score_toxicity(rows, model, names, text, slice_bytes=SLICE_BYTES)
    return _shown(judged.filter("predicted = 0"), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked documents: the one with the smallest doc_id (null last),
    and of its texts in the group the one with the smallest digest. Documents without words are in no
    group and stay; of repeated rows one stays. Near means 0.8 of the shingles of five words, not the
    op7 query's 85 % of those of four."""
    kept = jaccard_representatives(docs, size=5, percent=80).select(F.col("doc_id").alias("kept_id"), "mark")
    same = docs["doc_id"].eqNullSafe(kept["kept_id"]) & text_mark().eqNullSafe(kept["mark"])
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"]).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of at most 2048 tokens: a row per piece. A null or empty text is one piece, its end id; every
    repeated row has its own pieces; a null id is kept."""
    return pack_pieces(tokenize_pieces(docs, tokenizer_file("word_bpe_49k.json")))


STAGES = [("language_id", language_stage), ("toxicity", toxicity_stage), ("ngram_join", near_duplicate_stage),
          ("packing", packing_stage)]

#: SQL cannot express the learned stages; tests compare them with brute force.
ORACLE_SQL = None


@with_package
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what each stage keeps is written below the shared checkpoint folder."""
    docs = read(spark, sf_dir, "documents")
    base = scratch_path(spark, f"corpus-{uuid.uuid4().hex[:12]}")
    for name, stage in STAGES:
        path = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
