"""The corpus pipeline: low quality out, one document of each near-copy class, leaks out, personal
data replaced, texts encoded.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, folder). All but the last
return the columns of documents. A document is a row's (doc_id, text): rows that repeat both are one
document for the join stage, and are kept or dropped together by the others.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from subscope.llm import bpe, common, decontam, jaccard, pii, quality

#: No SQL engine trains these models; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None
#: Documents to leave out (a doc_id and a hash each) that are sent to every task at most.
SENT = 1_000_000


def _text_key():
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _free(docs: DataFrame, name: str) -> str:
    """``name``, longer if the documents have such a column."""
    while name in docs.columns:
        name += "_"
    return name


def _without(docs: DataFrame, gone: DataFrame, purpose: str) -> DataFrame:
    """``docs`` without the documents (doc_id, text_key) in ``gone``.

    Up to ``SENT`` documents are sent to every task, so that no text moves; more are joined.
    """
    gone = common.saved(gone.select(F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key")).distinct(), purpose)
    if gone.count() <= SENT:
        gone = F.broadcast(gone)
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_gone_id"]) & (_text_key() == gone["_gone_key"]), "left_anti")


def quality_classifier(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose quality score is at least one half."""
    model = quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return _without(docs, quality.scores(docs, model).where("score < 0.5"), "rejected")


def jaccard_join(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each class of near copies (five-word shingles, similarity 0.8 or more): that
    of the least doc_id. Documents without words have no copies and stay."""
    found = common.saved(jaccard.classes(docs, n=5, threshold=0.8), "copies")
    # one kept key per class; a document without words is a class of its own
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    kept = found.where("n_shingles > 0").groupBy("component_id").agg(F.min(order).alias("kept"))
    full = found.where("n_shingles > 0").withColumn("key", order).join(kept, found["component_id"].eqNullSafe(kept["component_id"]))
    out = _without(docs, full.where(~F.col("key").eqNullSafe(F.col("kept"))), "removed")
    # rows that repeat a key, if there are any, become one
    repeated = found.groupBy("doc_id", "text_key").count().where("count > 1").select("doc_id", "text_key")
    repeated = common.saved(repeated, "repeated")
    if repeated.isEmpty():
        return out
    again = repeated.withColumnsRenamed({"doc_id": "_again_id", "text_key": "_again_key"})
    rows = out.join(again, out["doc_id"].eqNullSafe(again["_again_id"]) & (_text_key() == again["_again_key"]), "left_semi")
    key, copy = _free(docs, "_key"), _free(docs, "_copy")
    once = rows.withColumn(key, _text_key()).withColumn(copy, F.row_number().over(Window.partitionBy("doc_id", key).orderBy(F.lit(0))))
    return _without(out, repeated, "repeated").unionByName(once.where(F.col(copy) == 1).select(*docs.columns))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return _without(docs, decontam.leaks(docs, spark.read.parquet(f"{folder}/benchmark.parquet")), "leaks")


def personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind; ``n_chars`` follows."""
    accepted = pii.accepted(pii.found(docs))
    text = F.col("text").cast("string")
    clean = F.when(text.isNotNull(), pii.redacted(text, pii.kept(pii.candidates(text), accepted)))
    out = docs.withColumn("text", clean)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(dict(docs.dtypes)["n_chars"]), F.col("n_chars")))


def bpe_encoding(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit) of every document, and the digest of
    the text that the ids decode to."""
    found = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"), decoded=True)
    return found.select("doc_id", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", personal_data),
    ("BPE encoding and decoding", bpe_encoding),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, folder)
        if k + 1 < len(STAGES):
            docs = common.saved(docs, "stage")
    return docs
