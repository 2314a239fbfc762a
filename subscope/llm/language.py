"""Language of a text by a bidirectional gated recurrent network over its bytes.

The bytes are cut into windows. Two recurrent cells read each window, one forwards, one backwards;
both states label every position, and the positions' probabilities are pooled over the document.
Training is backpropagation through time in numpy, on windows of a bounded sample of documents.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from subscope.llm import common

#: Documents of each language that training sees at most, their longest text, windows of a document.
SAMPLE, SAMPLE_CHARS, SAMPLE_WINDOWS = 300, 50_000, 6
#: Bytes of a window, state of each cell, windows that are read side by side.
WINDOW, STATE, SIDE = 48, 8, 2048
EPOCHS, BATCH, RATE = 5, 256, 0.02

_LETTER = re.compile(r"[^\W\d_]")


class Cell:
    """One direction. ``table`` holds the input's share of the three gates, ``turn`` the state's.

    The update and reset gates are piecewise linear (0 to 1) and the candidate is x / (1 + |x|):
    both have the usual shape and cost a few plain operations.
    """

    def __init__(self, rng: np.random.Generator):
        self.table = rng.normal(0, 0.3, (3 * STATE, 256)).astype(np.float32)
        self.table[: 2 * STATE] += 0.5
        self.turn = (rng.normal(0, 0.5, (3 * STATE, STATE)) / np.sqrt(STATE)).astype(np.float32)

    def read(self, windows: np.ndarray, out: np.ndarray) -> None:
        """States at every place of (place, window) bytes, into ``out`` (place, state, window)."""
        n = windows.shape[1]
        h = np.zeros((STATE, n), np.float32)
        x, u, t = np.empty((3 * STATE, n), np.float32), np.empty((3 * STATE, n), np.float32), np.empty((STATE, n), np.float32)
        gates, z, r, c = x[: 2 * STATE], x[:STATE], x[STATE : 2 * STATE], x[2 * STATE :]
        for k in range(len(windows)):
            np.take(self.table, windows[k], axis=1, out=x, mode="clip")
            np.matmul(self.turn, h, out=u)
            gates += u[: 2 * STATE]
            np.maximum(gates, 0, out=gates)
            np.minimum(gates, 1, out=gates)
            np.multiply(r, u[2 * STATE :], out=t)
            c += t
            np.abs(c, out=t)
            t += 1
            c /= t
            np.subtract(h, c, out=t)
            t *= z
            h = out[k]
            np.add(c, t, out=h)

    def trace(self, windows: np.ndarray):
        """States, and what the way back needs."""
        steps, states, h = [], [], np.zeros((STATE, windows.shape[1]), np.float32)
        for row in windows:
            x, u = self.table[:, row], self.turn @ h
            gates = x[: 2 * STATE] + u[: 2 * STATE]
            z, r = np.clip(gates[:STATE], 0, 1), np.clip(gates[STATE:], 0, 1)
            c = x[2 * STATE :] + r * u[2 * STATE :]
            c /= 1 + np.abs(c)
            # a shut gate still learns a little, or it would stay shut
            slope = np.where((gates > 0) & (gates < 1), np.float32(1), np.float32(0.05))
            steps.append((h, z, r, c, u[2 * STATE :], slope))
            h = c + z * (h - c)
            states.append(h)
        return np.stack(states), steps

    def back(self, windows: np.ndarray, steps, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of table and turn, from those of the states."""
        table, turn = np.zeros((256, 3 * STATE), np.float32), np.zeros_like(self.turn)
        carry = np.zeros_like(grad[0])
        for k in range(len(windows) - 1, -1, -1):
            h, z, r, c, u, slope = steps[k]
            d = grad[k] + carry
            dc = d * (1 - z) * (1 - np.abs(c)) ** 2
            gates = np.concatenate([d * (h - c), dc * u]) * slope
            inner = np.concatenate([gates, dc * r])
            carry = d * z + self.turn.T @ inner
            turn += inner @ h.T
            np.add.at(table, windows[k], np.concatenate([gates, dc]).T)
        return table.T, turn


class Network:
    """Two cells and a linear layer over both states."""

    def __init__(self, names: list[str], windows: np.ndarray, mask: np.ndarray, label: np.ndarray):
        rng = np.random.default_rng(11)
        self.names = names
        self.cells = Cell(rng), Cell(rng)
        self.out = np.zeros((2 * STATE, len(names)), np.float32)
        self.shift = np.zeros(len(names), np.float32)
        parts = [self.cells[0].table, self.cells[0].turn, self.cells[1].table, self.cells[1].turn, self.out, self.shift]
        moments = [(np.zeros_like(x), np.zeros_like(x)) for x in parts]
        step = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(windows))
            for a in range(0, len(order), BATCH):
                rows = order[a : a + BATCH]
                step += 1
                grads = self._gradients(np.ascontiguousarray(windows[rows].T), mask[rows].T, label[rows])
                rate = RATE * 0.5 ** max(0, epoch - EPOCHS // 2)
                for x, g, (m, v) in zip(parts, grads, moments, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)

    def _gradients(self, windows, mask, label):
        forward, f_steps = self.cells[0].trace(windows)
        backward, b_steps = self.cells[1].trace(windows[::-1])
        states = np.concatenate([forward, backward[::-1]], 1)  # (place, state, window)
        p = np.einsum("ksn,sc->kcn", states, self.out) + self.shift[:, None]
        p = np.exp(p - p.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[:, label, np.arange(len(label))] -= 1
        p *= (mask / max(1, mask.sum()))[:, None, :]
        d = np.einsum("kcn,sc->ksn", p, self.out)
        f = self.cells[0].back(windows, f_steps, d[:, :STATE])
        b = self.cells[1].back(windows[::-1], b_steps, d[::-1, STATE:])
        return *f, *b, np.einsum("ksn,kcn->sc", states, p), p.sum((0, 2))

    def pooled(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(text, language) probabilities: the mean over the positions of each text."""
        sizes = np.diff(offsets)
        windows, count = cut(data, offsets)
        total = np.zeros((len(sizes), len(self.names)))
        doc = np.repeat(np.arange(len(sizes)), count)
        left = np.minimum(WINDOW, np.repeat(sizes, count) - WINDOW * (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)))
        shape = WINDOW, STATE, SIDE
        forward, backward = np.empty(shape, np.float32), np.empty(shape, np.float32)
        for a in range(0, len(windows), SIDE):
            part = np.ascontiguousarray(windows[a : a + SIDE].T)
            n = part.shape[1]
            f, b = (forward, backward) if n == SIDE else (np.empty((WINDOW, STATE, n), np.float32) for _ in range(2))
            self.cells[0].read(part, f)
            self.cells[1].read(part[::-1], b)
            each = np.zeros((len(self.names), n), np.float32)
            for k in range(WINDOW):
                p = self.out[:STATE].T @ f[k]
                p += self.out[STATE:].T @ b[WINDOW - 1 - k]
                p += self.shift[:, None]
                np.exp(p, out=p)
                p *= (k < left[a : a + n]) / p.sum(0)
                each += p
            for c in range(len(self.names)):
                total[:, c] += np.bincount(doc[a : a + n], weights=each[c], minlength=len(sizes))
        return total / np.maximum(sizes, 1)[:, None]


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of every text as (window, place), the last window of a text filled up, and counts."""
    sizes = np.diff(offsets)
    count = -(-sizes // WINDOW)
    first = np.repeat(np.cumsum(count) - count, count)
    start = np.repeat(offsets[:-1], count) + WINDOW * (np.arange(int(count.sum())) - first)
    padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    return padded[start[:, None] + np.arange(WINDOW)], count


def train(docs: DataFrame, parts: int = 4, held: int = 2, most: int = SAMPLE) -> Network | None:
    """The network, from windows of at most ``most`` documents of each language outside the held-out
    fold, those least in hash order; None where no document has a language and a letter."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (common.fold(F.col("doc_id"), parts) != held))
    # only what can be learned from is ranked, so that a language is not lost to texts that cannot
    text = F.col("text").cast("string")
    known = known.where(F.char_length(text).between(1, SAMPLE_CHARS) & text.rlike(r"\p{L}"))
    hashed = known.select("doc_id", F.col("lang").cast("string").alias("lang"), F.xxhash64("doc_id").alias("h"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    picked = common.saved(hashed.withColumn("rank", rank).where(F.col("rank") <= most).select("doc_id", F.col("lang").alias("label")), "sample")
    texts = common.body(known).where(F.char_length("text").between(1, SAMPLE_CHARS))
    rows = sorted({(r["label"], r["text"]) for r in texts.join(F.broadcast(picked), "doc_id").select("label", "text").collect() if _LETTER.search(r["text"])})
    if not rows:
        return None
    names = sorted({r[0] for r in rows})
    data, offsets = common.buffer(pa.array([r[1] for r in rows], pa.string()))
    windows, count = cut(data, offsets)
    rng = np.random.default_rng(3)
    first = np.cumsum(count) - count
    take = np.concatenate([f + rng.choice(n, min(n, SAMPLE_WINDOWS), replace=False) for f, n in zip(first, count, strict=True)])
    doc = np.repeat(np.arange(len(rows)), count)[take]
    sizes = np.diff(offsets)[doc] - WINDOW * (take - first[doc])
    label = np.searchsorted(names, [r[0] for r in rows])[doc]
    return Network(names, windows[take], np.arange(WINDOW) < sizes[:, None], label)


def predictions(docs: DataFrame, model: Network | None) -> DataFrame:
    """doc_id, lang_pred and score of every row's whole text.

    A text without a letter (NULL, empty) is ``und`` with score 0, and so is every text if there was
    nothing to learn from; of equal probabilities the first language by name wins. Repeated rows are
    predicted alike; a NULL doc_id stays; other columns are ignored.
    """
    texts = common.body(docs)
    shared = common.shared(docs.sparkSession, model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        model: Network | None = shared.value
        letters = np.array([_LETTER.search(t) is not None for t in batch.column("text").to_pylist()], bool)
        names, score = np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows)
        if model is not None:
            p = model.pooled(*common.buffer(batch.column("text")))
            best = p.argmax(1)
            names[letters] = np.array(model.names, object)[best[letters]]
            score[letters] = np.clip(p[np.arange(len(p)), best], 0, 1)[letters]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return common.mapped(texts, work, f"doc_id {dict(texts.dtypes)['doc_id']}, lang_pred string, score double")
