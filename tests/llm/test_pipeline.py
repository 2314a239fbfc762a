import hashlib

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline as cp
from subscope.llm import bpe, decontam, quality
from tests.llm import cases
from tests.llm.test_jaccard import brute as classes
from tests.llm.test_pii import brute as spans


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{cases.TABLES}/documents.parquet").where("doc_id < 300")
    texts = dict(cases.texts_of(docs))
    stage = dict(cp.STAGES)

    kept = stage["quality classifier"](spark, docs, cases.TABLES)
    assert kept.columns == docs.columns
    model = quality.train(docs, spark.read.parquet(f"{cases.TABLES}/labels.parquet"))
    good = {r["doc_id"] for r in quality.scores(docs, model).collect() if r["score"] >= 0.5}
    assert {r["doc_id"] for r in kept.collect()} == good

    once = stage["n-gram Jaccard join"](spark, kept, cases.TABLES)
    own = sorted((i, texts[i]) for i in good)
    expected = {int(k) for k, _, c in classes(own, 5, 800) if k == c}
    assert once.columns == docs.columns and sorted(r["doc_id"] for r in once.collect()) == sorted(expected)

    clean = stage["benchmark decontamination"](spark, once, cases.TABLES)
    leaks = {r["doc_id"] for r in decontam.leaks(once, spark.read.parquet(f"{cases.TABLES}/benchmark.parquet")).collect()}
    assert leaks and {r["doc_id"] for r in clean.collect()} == expected - leaks

    private = stage["PII"](spark, clean, cases.TABLES)
    rows = {r["doc_id"]: r for r in private.collect()}
    assert private.columns == docs.columns and rows.keys() == expected - leaks
    for i, r in rows.items():
        assert not spans(r["text"]) and r["n_chars"] == len(r["text"])
        assert bool(spans(texts[i])) == (r["text"] != texts[i]) or "[" in r["text"]

    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = stage["BPE encoding and decoding"](spark, private, cases.TABLES)
    assert {r["doc_id"]: r["decoded"] for r in bpe.decode(ids, path).collect()} == {i: r["text"] for i, r in rows.items()}
    assert {r["doc_id"]: r["decoded_sha256"] for r in ids.collect()} == {i: hashlib.sha256(r["text"].encode()).hexdigest() for i, r in rows.items()}


def test_odd_rows_through_all_stages(spark, tmp_path):
    docs = cases.odd(spark)
    folder = str(tmp_path)
    cases.labels(spark, docs).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "nothing of this is in any of them")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs.write.parquet(f"{folder}/documents.parquet")
    read = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, read, folder)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert stage(spark, cases.none(spark), folder).count() == 0, name
    # a document without words has no copies
    joined = cp.jaccard_join(spark, read, folder)
    assert joined.where("doc_id = 101").count() == joined.where("doc_id = 102").count() == 1
    assert joined.where("doc_id = 0").count() == 1 and joined.where("doc_id = 100").count() == 0
    assert cp.run(spark, folder).columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]


def test_text_that_is_null_stays_null(spark):
    docs = spark.createDataFrame([(1, None), (2, "joe@x.org")], "doc_id long, text string")
    rows = {r["doc_id"]: r["text"] for r in cp.personal_data(spark, docs.withColumn("n_chars", F.lit(0)), "").collect()}
    assert rows == {1: None, 2: "[EMAIL]"}
