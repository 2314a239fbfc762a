"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; all other text is unlabelled, not clean. With the class
prior p, the risk of calling toxic text clean is measured on the positives, and the risk of calling
clean text toxic is that of the unlabelled text less p times that of the positives. Where this
difference falls below zero the classifier has begun to learn the unlabelled toxic texts by heart,
and the step goes the other way. The classifier is linear over the words, and beginnings and ends of
words, that a document holds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm import common

#: Documents that training sees at most, confirmed and unlabelled, and their longest text.
POSITIVE, UNLABELLED, SAMPLE_CHARS = 2000, 4000, 50_000
#: A word or part is a feature if so many confirmed documents, and such a share, hold it.
LEAST_DOCS, LEAST_SHARE = 3, 0.01
#: Bytes of the beginnings and ends of longer words.
PARTS = (3, 4, 5)
#: Share of the largest possible excess in the confirmed documents that a feature must reach.
EXCESS = 0.5
STEPS, RATE, DECAY = 400, 0.1, 0.2


def features(texts: pa.Array):
    """(text numbers, hashes) of the words, then of their beginnings and ends, size by size."""
    data, starts, ends, doc = common.plain_spans(texts)
    yield doc, common.word_hashes(data, starts, ends)
    for size in PARTS:
        long = ends - starts > size
        for salt, first in ((1, starts[long]), (2, ends[long] - size)):
            value = np.full(len(first), (size << 8) + salt, np.uint64)
            for k in range(size):
                value = value * np.uint64(0x100000001B3) + data[first + k]
            yield doc[long], common.mix(value)


def holdings(texts: pa.Array, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, feature) pairs, by text; only places in ``known`` if that is given."""
    docs, values = [], []
    for doc, value in features(texts):
        if known is not None:
            doc, value = _places(known, doc, value)
        docs.append(doc)
        values.append(value)
    doc, value = np.concatenate(docs), np.concatenate(values)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], value[new]


def _places(known: np.ndarray, doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features that are known, as places in the sorted hashes."""
    if not len(known):
        return doc[:0], np.zeros(0, np.int64)
    marked = np.zeros(1 << 16, bool)
    marked[(known & np.uint64(0xFFFF)).astype(np.int64)] = True
    near = np.flatnonzero(marked[(value & np.uint64(0xFFFF)).astype(np.int64)])
    slot = np.minimum(np.searchsorted(known, value[near]), len(known) - 1)
    hit = known[slot] == value[near]
    return doc[near[hit]], slot[hit]


def _parts(texts: pa.Array, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``holdings`` of many texts, a few at a time."""
    docs, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a in range(0, len(texts), 200):
        doc, place = holdings(texts.slice(a, 200), known)
        docs.append(doc + a)
        places.append(place)
    return np.concatenate(docs), np.concatenate(places)


class Classifier:
    """Weights of words, sorted by hash, and a bias."""

    def __init__(self, positive: pa.Array, unlabelled: pa.Array, prior: float):
        held = np.concatenate([holdings(positive.slice(a, 200))[1] for a in range(0, len(positive), 200)])
        known, docs = np.unique(held, return_counts=True)
        frequent = docs >= max(LEAST_DOCS, len(positive) * LEAST_SHARE)
        self.words, docs = known[frequent], docs[frequent]
        sides = [(*_parts(texts, self.words), len(texts)) for texts in (positive, unlabelled)]
        # what only toxic text holds is 1 / prior times as frequent in the positives as in all text
        among = np.bincount(sides[1][1], minlength=len(self.words))
        kept = docs * len(unlabelled) * prior >= EXCESS * (among + 1) * len(positive)
        place = np.cumsum(kept) - 1
        self.words = self.words[kept]
        sides = [(doc[kept[at]], place[at[kept[at]]], n) for doc, at, n in sides]
        self._fit(sides, prior)

    def _fit(self, sides: list, prior: float) -> None:
        n = len(self.words)
        self.weights, self.bias = np.zeros(n), float(np.log(prior / (1 - prior)))
        (p_doc, p_col, n_p), (u_doc, u_col, n_u) = sides
        m, v = np.zeros(n + 1), np.zeros(n + 1)
        for step in range(1, STEPS + 1):
            z_p, z_u = (np.bincount(d, weights=self.weights[c], minlength=k) + self.bias for d, c, k in sides)
            s_p, s_u = _sigmoid(z_p), _sigmoid(z_u)
            # logistic losses: of calling a positive clean, and of calling text toxic
            excess = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
            toxic_p, clean_p, clean_u = prior * (s_p - 1) / n_p, -prior * s_p / n_p, s_u / n_u
            g_p, g_u = (toxic_p + clean_p, clean_u) if excess >= 0 else (-clean_p, -clean_u)
            words = np.bincount(p_col, weights=g_p[p_doc], minlength=n) + np.bincount(u_col, weights=g_u[u_doc], minlength=n)
            grad = np.append(words + DECAY / n_p * self.weights, g_p.sum() + g_u.sum())
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
            move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            self.weights -= move[:-1]
            self.bias -= float(move[-1])

    def score(self, texts: pa.Array) -> np.ndarray:
        doc, place = holdings(texts, self.words)
        return _sigmoid(np.bincount(doc, weights=self.weights[place], minlength=len(texts)) + self.bias)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0, positive: int = POSITIVE, unlabelled: int = UNLABELLED) -> Classifier | float:
    """The classifier, from confirmed documents and unlabelled ones outside the held-out fold.

    Both samples are those least in hash order. The class prior is the toxic share of the labelled
    rows of the same folds (0.1 if all are toxic). Without a confirmed document the score is 0.
    """
    own = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (common.fold(F.col("doc_id"), parts) != held))
    own = common.saved(own.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).withColumn("h", F.xxhash64("doc_id")), "labels")
    share = own.agg(F.avg("toxic")).head()[0]
    if not share:
        return 0.0
    prior = min(max(float(share), 0.005), 0.5) if share < 1 else 0.1
    confirmed = own.where("toxic = 1").orderBy("h", "doc_id").limit(positive).select("doc_id", F.lit(1).alias("confirmed"))
    known = common.body(docs).where(F.col("doc_id").isNotNull() & (common.fold(F.col("doc_id"), parts) != held))
    rest = known.select("doc_id", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(unlabelled).select("doc_id", F.lit(0).alias("confirmed"))
    picked = common.saved(confirmed.union(rest), "sample")  # a bounded number of rows
    rows = known.where(F.char_length("text") <= SAMPLE_CHARS).join(F.broadcast(picked), "doc_id").select("text", "confirmed").collect()
    texts = [sorted({r["text"] for r in rows if r["confirmed"] == side}) for side in (1, 0)]
    if not texts[0] or not texts[1]:
        return 0.0
    return Classifier(pa.array(texts[0], pa.string()), pa.array(texts[1], pa.string()), prior)


def scores(docs: DataFrame, model: Classifier | float) -> DataFrame:
    """doc_id, text_key and score (0 to 1) of every row's whole text.

    NULL and empty texts hold no word and score by the bias alone; repeated rows score alike; a NULL
    doc_id stays; other columns are ignored.
    """
    texts = common.body(docs).withColumn("text_key", F.xxhash64("text"))
    shared = common.shared(docs.sparkSession, model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        score = np.full(batch.num_rows, model) if isinstance(model, float) else model.score(batch.column("text"))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(score, pa.float64())], names=["doc_id", "text_key", "score"])

    return common.mapped(texts, work, f"doc_id {dict(texts.dtypes)['doc_id']}, text_key long, score double")
