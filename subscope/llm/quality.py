"""Document quality from a linear-chain conditional random field over lines.

Every line of a document is good or bad. Its potential comes from counts of characters and words in
the line and in its two neighbours, each cut into bins; a second potential ties neighbouring labels.
The field is trained in numpy on labelled documents whose lines take the document's label.
Forward-backward marginals, weighted by the lines' lengths, make the score of a document.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm import common

#: Labelled documents of each label that training sees at most, and their longest text.
SAMPLE, SAMPLE_CHARS = 2000, 50_000
BINS = 10
STEPS = 150

_CLASS = np.full(256, 8, np.uint8)
for _kind, _bytes in enumerate(([*range(65, 91)], [*range(97, 123)], [*range(48, 58)], [32, 9], b"|", b"!", b"#$%&*@^~_<>{}[]=+\\", b".,;:?'\"()-/", [*range(128, 256)])):
    _CLASS[list(_bytes)] = _kind
_KINDS = 9


def lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, sizes in bytes, number of lines per text); every text has one line at least."""
    data, offsets = common.buffer(texts)
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    ends = np.append(starts[1:], len(data)) - 1
    doc = np.searchsorted(offsets, starts, "right") - 1
    per_doc = np.bincount(doc, minlength=len(texts))
    n, size = len(starts), ends - starts
    line_of = np.repeat(np.arange(n), np.append(starts[1:], len(data)) - starts)
    kinds = np.bincount(line_of * _KINDS + _CLASS[data], minlength=n * _KINDS).reshape(n, _KINDS).astype(float)

    begin, end = common.words(data)
    word, at = common.word_hashes(data, begin, end), line_of[begin] if len(begin) else np.zeros(0, np.int64)
    many = np.bincount(at, minlength=n)
    some = np.maximum(many, 1)
    order = np.lexsort((word, doc[at]))
    w, l = word[order], at[order]
    again = np.zeros(len(w), bool)
    again[1:] = (w[1:] == w[:-1]) & (doc[l[1:]] == doc[l[:-1]])
    here = again.copy()
    here[1:] &= l[1:] == l[:-1]
    beside = np.zeros(len(word), bool)
    beside[1:] = (word[1:] == word[:-1]) & (at[1:] == at[:-1])
    length = end - begin
    # equal lines of a document
    place = np.arange(len(word)) - np.repeat(np.cumsum(many) - many, many)
    mark = np.zeros(n, np.uint64)
    np.add.at(mark, at, common.mix(word + place.astype(np.uint64)))
    _, inverse, times = np.unique(np.stack([doc.astype(np.uint64), mark], 1), axis=0, return_inverse=True, return_counts=True)

    letters = np.maximum(kinds[:, 0] + kinds[:, 1] + kinds[:, 8], 1)
    all_ = np.maximum(size, 1)
    share = lambda flags, where: np.bincount(where[flags], minlength=n) / some
    features = np.stack(
        [
            np.log1p(size),
            kinds[:, 0] / letters,
            *(kinds[:, k] / all_ for k in (2, 3, 4, 5, 6, 7, 8)),
            np.log1p(many),
            np.bincount(at, weights=length, minlength=n) / some,
            share(length <= 3, at),
            share(beside, at),
            share(here, l),
            share(again, l),
            np.log1p(times[inverse.ravel()] - 1),
            np.log1p(per_doc[doc]),
            np.where(size > 0, _CLASS[data[np.maximum(ends - 1, 0)]], 9) if len(data) else np.full(n, 9),
        ],
        1,
    ).astype(np.float32)
    return features, size, per_doc


class Field:
    """Binned potentials of a line and its neighbours, label transitions, calibration."""

    def __init__(self, features: np.ndarray, size: np.ndarray, per_doc: np.ndarray, label: np.ndarray, times: np.ndarray | None = None):
        """``times``: the labelled documents that each one stands for (one each)."""
        grid = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(features[:, f], grid)) for f in range(features.shape[1])]
        self.weights = np.zeros((3, features.shape[1], BINS), np.float64)
        self.tie = np.zeros((2, 2))
        self.bias = 0.0
        bins = self._bins(features)
        first = np.cumsum(per_doc) - per_doc
        target = np.repeat(label, per_doc).astype(float)
        same = np.ones(len(target), bool)
        same[first] = False
        moment = [np.zeros_like(x) for x in (self.weights, self.tie, np.zeros(1)) for _ in range(2)]
        docs = len(per_doc)
        times = np.ones(docs) if times is None else times / times.mean()
        weight = np.repeat(times, per_doc)
        for step in range(1, STEPS + 1):
            unary = self._unary(bins, first)
            p, pairs = marginals(unary, per_doc, self.tie, times)
            gap = weight * (p - target) / docs
            grad = np.zeros_like(self.weights)
            for k, shift in enumerate((0, -1, 1)):
                rows, ok = _neighbour(len(gap), first, shift)
                for f in range(bins.shape[1]):
                    grad[k, f] = np.bincount(bins[rows[ok], f], weights=gap[ok], minlength=BINS)
            grad += 2e-4 * self.weights
            seen = np.zeros((2, 2))
            y = target.astype(int)
            np.add.at(seen, (y[:-1][same[1:]], y[1:][same[1:]]), weight[1:][same[1:]])
            tie = (pairs - seen) / docs + 2e-2 * self.tie
            for x, g, (m, v) in ((self.weights, grad, moment[:2]), (self.tie, tie, moment[2:4])):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                x -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            g = np.array([gap.sum()])
            m, v = moment[4:]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            self.bias -= float((0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8))[0])
        self.slope, self.shift = 1.0, 0.0
        raw = self._raw(features, size, per_doc)
        a, b = 1.0, 0.0
        for _ in range(200):  # logistic calibration of two numbers by Newton steps
            p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
            d, h = times * (p - label), times * np.maximum(p * (1 - p), 1e-6)
            g = np.array([(d * raw).mean() + 1e-3 * (a - 1), d.mean()])
            hess = np.array([[(h * raw * raw).mean() + 1e-3, (h * raw).mean()], [(h * raw).mean(), h.mean() + 1e-6]])
            move = np.linalg.solve(hess, g)
            a, b = a - move[0], b - move[1]
            if np.abs(move).max() < 1e-9:
                break
        self.slope, self.shift = float(max(a, 1e-3)), float(b)

    def _bins(self, features: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, features[:, f], "left") for f, e in enumerate(self.edges)], 1)

    def _unary(self, bins: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log-odds of a good line from itself, the line before and the line after."""
        out = np.full(len(bins), self.bias)
        for k, shift in enumerate((0, -1, 1)):
            rows, ok = _neighbour(len(bins), first, shift)
            for f in range(bins.shape[1]):
                out[ok] += self.weights[k, f][bins[rows[ok], f]]
        return out

    def _raw(self, features: np.ndarray, size: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
        first = np.cumsum(per_doc) - per_doc
        p, _ = marginals(self._unary(self._bins(features), first), per_doc, self.tie)
        weight = size + 1.0
        share = np.add.reduceat(p * weight, first) / np.add.reduceat(weight, first)
        share = np.clip(share, 1e-4, 1 - 1e-4)
        return np.log(share / (1 - share))

    def score(self, features: np.ndarray, size: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
        z = np.clip(self.slope * self._raw(features, size, per_doc) + self.shift, -30, 30)
        return 1 / (1 + np.exp(-z))


def _neighbour(n: int, first: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the neighbours, and whether a row has one in its document."""
    rows, ok = np.arange(n) + shift, np.ones(n, bool)
    if shift == -1:
        ok[first] = False
    elif shift == 1:
        ok[first[1:] - 1] = False
        ok[-1:] = False
    return np.clip(rows, 0, max(0, n - 1)), ok


def marginals(unary: np.ndarray, per_doc: np.ndarray, tie: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of every line, and expected label pairs (each document's ``times`` over, if given), by
    forward-backward over all documents at once.

    States are kept as log-odds: one number per line carries what two scaled messages would.
    """
    first = np.cumsum(per_doc) - per_doc
    order = np.argsort(-per_doc, kind="stable")
    start, count = first[order], per_doc[order]
    active = np.searchsorted(-count, -np.arange(1, (count.max() if len(count) else 0) + 1), "right")
    a, b, c, d = tie[0, 0], tie[0, 1], tie[1, 0], tie[1, 1]

    def passed(odds, zero, one, other_zero, other_one):
        # log-odds after a step: log(sum e^{..to 1}) - log(sum e^{..to 0})
        return np.logaddexp(one, odds + other_one) - np.logaddexp(zero, odds + other_zero)

    forward, backward = unary.copy(), np.zeros(len(unary))
    for t in range(1, len(active)):
        rows = start[: active[t]] + t
        forward[rows] += passed(forward[rows - 1], a, b, c, d)
    for t in range(len(active) - 2, -1, -1):
        rows = start[: active[t + 1]] + t
        backward[rows] = passed(backward[rows + 1] + unary[rows + 1], a, c, b, d)
    p = 1 / (1 + np.exp(-np.clip(forward + backward, -500, 500)))
    inner = np.ones(len(unary), bool)
    inner[first] = False
    right = np.flatnonzero(inner)
    f, g = forward[right - 1], backward[right] + unary[right]
    cells = np.stack([np.full(len(f), a), b + g, c + f, d + f + g], 1)
    cells = np.exp(cells - cells.max(1, keepdims=True)) if len(cells) else cells
    if len(cells):
        cells /= cells.sum(1, keepdims=True)
        if times is not None:
            cells *= np.repeat(times, per_doc)[right, None]
    pairs = cells.sum(0).reshape(2, 2) if len(cells) else np.zeros((2, 2))
    return p, pairs


def sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, held: int, most: int, chars: int) -> list[tuple[str, int, float]]:
    """At most ``most`` texts of each label outside the held-out fold, those least in hash order, and
    the labelled documents that each stands for, so that the labels keep their shares at any size.

    Conflicting labels of a document count as the larger one; unlabelled rows are left out.
    """
    own = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (common.fold(F.col("doc_id"), parts) != held))
    own = own.groupBy("doc_id").agg(F.max(label).cast("int").alias("label")).withColumn("h", F.xxhash64("doc_id"))
    stands = {r["label"]: r["count"] / min(most, r["count"]) for r in own.groupBy("label").count().collect()}
    picked = own.where("label = 0").orderBy("h", "doc_id").limit(most).union(own.where("label = 1").orderBy("h", "doc_id").limit(most))
    picked = common.saved(picked.select("doc_id", "label"), "sample")  # 2 * most rows
    texts = common.body(docs).where(F.char_length("text") <= chars)
    rows = Counter((r["text"], r["label"]) for r in texts.join(F.broadcast(picked), "doc_id").select("text", "label").collect())
    return [(text, kind, n * stands[kind]) for (text, kind), n in sorted(rows.items())]


def train(docs: DataFrame, labels: DataFrame, parts: int = 3, held: int = 1, most: int = SAMPLE) -> Field | float:
    """The field, or a constant score where the sample holds fewer than two labels."""
    rows = sample(docs, labels, "quality", parts, held, most, SAMPLE_CHARS)
    y = np.array([r[1] for r in rows], int)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 1.0
    return Field(*lines(pa.array([r[0] for r in rows], pa.string())), y, np.array([r[2] for r in rows]))


def scores(docs: DataFrame, model: Field | float) -> DataFrame:
    """doc_id, text_key and score (0 to 1) of every row's whole text.

    A NULL or empty text is one empty line. Repeated rows are scored alike; a NULL doc_id stays;
    other columns are ignored. Without two labels to learn from, every score is the one label seen
    (1 if none).
    """
    texts = common.body(docs).withColumn("text_key", F.xxhash64("text"))
    shared = common.shared(docs.sparkSession, model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        field = shared.value
        score = np.full(batch.num_rows, field) if isinstance(field, float) else field.score(*lines(batch.column("text")))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(score, pa.float64())], names=["doc_id", "text_key", "score"])

    return common.mapped(texts, work, f"doc_id {dict(texts.dtypes)['doc_id']}, text_key long, score double")
