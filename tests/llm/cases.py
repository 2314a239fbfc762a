"""Rows that every operator must take: NULLs, empty and long texts, ties, repeats, clashing columns."""

import random

TABLES = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
LARGE = "/root/testdata/sf0.1"
# names that operators use inside
CLASHING = ["row", "key", "bucket", "extra", "node", "n", "gram", "score", "text_key", "h", "label", "rank", "_key", "_copy", "component_id", "spans", "word", "times", "size", "_spans", "_gone_id", "_kept_id", "_found_key"]


def odd_rows() -> list[tuple]:
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "the", "of", "and", "Ünïcode", "42", "x@y.org", "10.0.0.1"]
    prose = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 80))) + "." for _ in range(40)]
    rows = [(i, text, "en" if i % 2 else "de", "s") for i, text in enumerate(prose)]
    rows += rows[:5]  # repeated rows
    rows += [(100, prose[0], "en", "s"), (100, prose[1], "de", "s")]  # one key, two texts
    rows += [(101, None, None, None), (102, "", "en", None), (None, prose[2], "en", "s"), (None, None, None, None)]
    rows += [(103, " \t\n ", "de", "s"), (104, "a" * 30_000, "en", "s"), (105, "word " * 20_000, "de", "s"), (106, "\n" * 3_000, "en", "s"), (107, "1 " * 5_000, None, "s"), (108, "中文" * 3_000, "en", "s")]
    return rows


def odd(spark):
    base = spark.createDataFrame(odd_rows(), "doc_id long, text string, lang string, source string")
    from pyspark.sql import functions as F

    return base.select("*", F.char_length("text").cast("long").alias("n_chars"), *(F.lit(None).cast("string").alias(c) for c in CLASHING))


def none(spark):
    return odd(spark).where("false")


def labels(spark, docs):
    from pyspark.sql import functions as F

    own = docs.where("doc_id is not null").select("doc_id", (F.col("doc_id") % 3 > 0).cast("int").alias("quality"), (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    other = spark.createDataFrame([(None, 1, 0), (1, None, None), (999_999, 1, 1)], "doc_id long, quality int, toxic int")
    return own.union(own).union(other)


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
