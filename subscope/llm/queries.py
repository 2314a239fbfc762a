"""The registered queries: each applies its operator to the whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.llm import bpe, collocation, common, decontam, fingerprint, jaccard, language, lm, pii, quality, sharding, tokencount, toxicity, vectorcode

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str):
    def register(f):
        QUERIES[name] = f
        return f

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_bpe")
def bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    found = bpe.encode(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), decoded=True)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op2_fingerprints")
def document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, folder, "documents"))


@query("op3_decontamination")
def benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("text_key")


@query("op4_quality")
def document_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = quality.scores(docs, quality.train(docs, table(spark, folder, "labels")))
    held = common.fold(F.col("doc_id"), 3) == 1
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op5_language")
def document_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = common.fold(F.col("doc_id"), 4) == 2
    return language.predictions(docs, language.train(docs)).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query("op6_lm_scores")
def language_model(spark: SparkSession, folder: str) -> DataFrame:
    return lm.scores(table(spark, folder, "documents"))


@query("op7_token_counts")
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokencount.counts(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op8_toxicity")
def document_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = toxicity.scores(docs, toxicity.train(docs, table(spark, folder, "labels")))
    held = common.fold(F.col("doc_id"), 5) == 0
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op9_pii")
def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.spans(table(spark, folder, "documents"))
    base = F.filter("spans", lambda x: x["base"])
    number = lambda k: F.size(F.filter(base, lambda x: x["kind"] == k)).cast("long").alias(f"n_{pii.KINDS[k]}")
    return found.select("doc_id", *(number(k) for k in range(4)), F.sha2(pii.written(base).cast("binary"), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"))


@query("op10_jaccard_join")
def jaccard_classes(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.classes(table(spark, folder, "documents"), n=4, threshold=0.85).select("doc_id", "n_shingles", "component_id")


@query("op11_sharding")
def shards_of_equal_bytes(spark: SparkSession, folder: str) -> DataFrame:
    # the documents lay in 32 shards by key
    old = common.fold(F.col("doc_id"), 32)
    rows = sharding.reshard(table(spark, folder, "documents"), old, 40).rows
    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    size = (F.octet_length(data) + sharding.ROW_BYTES).cast("long").alias("size")
    return rows.select("doc_id", size, F.crc32(data).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op12_collocations")
def phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocation.phrases(table(spark, folder, "documents"))


# The phrases of op12, from all runs of one to four words; HUGEINT where products pass 64 bits.
ORACLE["op12_collocations"] = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces
), total AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
), runs AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM words, range(1, 5) r(m) WHERE len(w) >= m
), f AS (
  SELECT lang, m, phrase, count(*) AS a FROM runs GROUP BY lang, m, phrase HAVING count(*) >= 30
), cuts AS (
  SELECT lang, m, phrase, a, k, string_split(phrase, ' ') AS w FROM f, range(1, 4) c(k) WHERE m > k
), scored AS (
  SELECT c.lang, c.m, c.phrase, c.a, c.k, h.a AS l, t.a AS r,
      CAST((2000000::HUGEINT * c.a) // (h.a::HUGEINT + t.a::HUGEINT) AS BIGINT) AS score
  FROM cuts c
  JOIN f h ON h.lang = c.lang AND h.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN f t ON t.lang = c.lang AND t.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_runs AS (
  SELECT lang, a, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT DISTINCT lang, m, a, w FROM cuts WHERE m > 2), range(2, 4) s(n), range(1, 4) t(i) WHERE n < m AND i + n - 1 <= m
), around AS (
  SELECT lang, phrase, max(a) AS longer FROM inner_runs GROUP BY lang, phrase
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.phrase = b.phrase
  WHERE o.longer IS NULL OR 100::HUGEINT * o.longer < 80::HUGEINT * b.a
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score FROM ranked r JOIN total t ON t.lang = r.lang WHERE r.rank <= 2000
"""

@query("op13_vector_codes")
def vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vectorcode.codes(table(spark, folder, "embeddings"), parts=16, entries=64, rounds=2, scale=256)


def _lloyd(before: str, after: str) -> str:
    """One round of op13 in SQL: ``before`` holds (p, e, v) entries, ``after`` the next ones."""
    return f"""
{after}_given AS (
  SELECT x.vec, x.p, arg_min(b.e, (list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), b.e)) AS e
  FROM parts x JOIN {before} b ON b.p = x.p GROUP BY x.vec, x.p
), {after}_means AS (
  SELECT p, e, j, CAST((s - ((s % c) + c) % c) // c AS BIGINT) AS m
  FROM (SELECT g.p, g.e, u.j, sum(x.v[u.j])::HUGEINT AS s, count(*)::HUGEINT AS c
        FROM {after}_given g JOIN parts x ON x.vec = g.vec AND x.p = g.p, (SELECT unnest(range(1, 5)) AS j) u GROUP BY g.p, g.e, u.j)
), {after} AS (
  SELECT b.p, b.e, coalesce(list(m.m ORDER BY m.j) FILTER (WHERE m.m IS NOT NULL), any_value(b.v)) AS v
  FROM {before} b LEFT JOIN {after}_means m ON m.p = b.p AND m.e = b.e GROUP BY b.p, b.e
)"""


# The codes of op13 by plain Lloyd rounds over all pairs of a part and an entry.
ORACLE["op13_vector_codes"] = f"""
WITH kept AS (
  SELECT row_number() OVER () AS vec, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS w
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT vec, vec_id, p, w[p * 4 + 1:p * 4 + 4] AS v FROM kept, range(0, 16) r(p)
), firsts AS (
  SELECT vec, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY row_number() OVER (ORDER BY vec_id) <= 64
), book0 AS (
  SELECT x.p, l.e, x.v FROM parts x JOIN firsts l ON l.vec = x.vec
), {_lloyd("book0", "book1")}, {_lloyd("book1", "book2")}, {_lloyd("book2", "book3").split("), book3_means")[0]}), digest AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2
), coded AS (
  SELECT g.vec, string_agg(printf('%02x', CAST(g.e AS INTEGER)), '' ORDER BY g.p) AS code,
      CAST(sum(list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS BIGINT) AS error
  FROM book3_given g JOIN parts x ON x.vec = g.vec AND x.p = g.p JOIN book2 b ON b.p = g.p AND b.e = g.e GROUP BY g.vec
)
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, d.codebooks_sha256
FROM kept k JOIN coded c ON c.vec = k.vec, digest d
"""

# The classes of op10, from all sets of shingles that share one and a transitive closure.
ORACLE["op10_jaccard_join"] = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingles AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM words
), sized AS (
  SELECT doc_id, CAST(len(s) AS BIGINT) AS n, s FROM shingles
), sets AS (
  SELECT min(doc_id) AS node, n, k, any_value(s) AS s
  FROM (SELECT doc_id, n, s, md5(array_to_string(list_sort(s), chr(10))) AS k FROM sized WHERE n > 0) GROUP BY n, k
), owned AS (
  SELECT node, n, unnest(s) AS g FROM sets
), pairs AS (
  SELECT a.node AS a, b.node AS b
  FROM owned a JOIN owned b ON a.g = b.g AND a.node < b.node AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), edges AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach(node, seen) AS (
  SELECT node, node FROM sets WHERE node IN (SELECT a FROM edges)
  UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.seen
), named AS (
  SELECT s.node, s.n, s.k, coalesce(min(r.seen), s.node) AS component_id FROM sets s LEFT JOIN reach r ON r.node = s.node GROUP BY s.node, s.n, s.k
)
SELECT d.doc_id, d.n AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id
FROM (SELECT doc_id, n, md5(array_to_string(list_sort(s), chr(10))) AS k FROM sized) d
LEFT JOIN named m ON m.n = d.n AND m.k = d.k AND d.n > 0
"""
