"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit verification.

Texts and items are sequences of words (letters and digits, in lower case). A CGK random walk copies
the word under its pointer to the output and moves the pointer on by a random bit of (step, word);
sequences at a small edit distance then agree at many places of the output, that is, are close in
Hamming distance. Tables that sample a few places each, for several independent walks, look up the
items that a window may contain. Each such pair is verified by its exact edit distance.

An item of n words leaks when a passage lies within ``floor(edits * n)`` word edits of it. An item
cut into that many and one more segments has one segment unharmed in such a passage, so windows are
only embedded where a segment of some item occurs. This loses nothing and spares clean text. A walk
starts beside the segment and goes to the farther end of the item: text and item are in step there,
wherever the edits before it have moved the item's beginning.

How many tables an item is looked up in follows from the target recall: items of its length are
edited as much as is allowed, by each kind of edit, until so many tables bring as many of them back.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm import common

#: Independent walks, sampling tables for each at most, and places that one table samples.
WALKS, TABLES, PLACES = 8, 16, 2
#: Items of one index; a larger benchmark is searched in blocks of about this size.
ITEMS = 20_000
#: Words beside a segment: a walk of a class stands for about as many, and for no more than the last.
CLASSES = [1, 2, 3, 5, 8, 12, 18, 27, 40, 60]
#: Item lengths from which on a number of tables holds, and edited items that are tried to find it.
LENGTHS, TRIALS = [5, 10, 15, 20, 30, 40, 60, 90, 135, 200, 300], 300
#: Share of the items within the allowed edits that the tables are to bring back.
RECALL = 0.99
_P = np.uint64(0x100000001B3)
_BLANK = np.uint64(0x7F4A7C15F39CC060)


def sequences(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes of all texts in a row, n+1 offsets)."""
    word, doc = common.plain_words(texts)
    return word, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))])


def _allowed(words: int, edits: float) -> int:
    return int(edits * words + 1e-9)


class Index:
    """The segments and the sampling tables of a block of items.

    An entry is a segment of an item: ``item``, ``offset`` (its first word), ``step`` (1: the walk
    goes on after it, -1: back before it), ``kind`` (class of the words on that side, -1: none, the
    segment is the item) and ``reach`` (tables that it is looked up in).
    """

    def __init__(self, items: list[tuple[object, str]], edits: float, min_words: int, recall: float = RECALL):
        word, at = sequences(pa.array([t or "" for _, t in items], pa.string()))
        self.vocabulary = np.unique(word)
        ids = self.ids(word)
        self._enter([(key, ids[a:b]) for (key, _), a, b in zip(items, at[:-1], at[1:], strict=True) if b - a >= min_words], edits, recall)

    def _enter(self, items: list[tuple[object, np.ndarray]], edits: float, recall: float | None) -> None:
        self.items = items
        self.allowed = np.array([_allowed(len(x), edits) for _, x in items], np.int64)
        self.words = np.array([len(x) for _, x in items], np.int64)
        own, offset, width = [], [], []
        for at, (_, x) in enumerate(items):
            many = int(self.allowed[at]) + 1
            size = len(x) // many
            own += [at] * many
            offset += [j * size for j in range(many)]
            width += [size] * many
        self.item, self.offset, self.width = (np.array(x, np.int64) for x in (own, offset, width))
        after = self.words[self.item] - self.offset - self.width
        self.step = np.where(after >= self.offset, 1, -1)
        beside = np.maximum(after, self.offset)
        self.kind = np.where(beside > 0, np.searchsorted(CLASSES, beside, "right") - 1, -1)
        # a third argument of None takes all tables: this is how their number is found
        needed = [WALKS * TABLES if recall is None or size < LENGTHS[0] else tables_for(LENGTHS[int(np.searchsorted(LENGTHS, size, "right")) - 1], edits, recall) for size in self.words.tolist()]
        self.reach = np.array(needed, np.int64)[self.item]
        first = np.cumsum(self.words) - self.words
        flat = np.concatenate([x for _, x in items]) if items else np.zeros(0, np.int64)
        begin = first[self.item] + self.offset
        self.segment = np.zeros(len(begin), np.uint64)
        self.segments = {}
        for size in np.unique(self.width):
            mine = np.flatnonzero(self.width == size)
            key = self._keys(flat, int(size), begin[mine])
            self.segment[mine] = key
            order = np.argsort(key, kind="stable")
            unique, start = np.unique(key[order], return_index=True)
            self.segments[int(size)] = unique, np.append(start, len(mine)), mine[order]
        rng = np.random.default_rng(5)
        self.bits = rng.integers(1, 1 << 62, (WALKS, 2 * CLASSES[-1] + 8), dtype=np.uint64)
        self.places = [np.sort(rng.choice(self._steps(c), (WALKS * TABLES, PLACES))) for c in range(len(CLASSES))]
        self.tables = {}
        for c in np.unique(self.kind[self.kind >= 0]):
            for step in (1, -1):
                mine = np.flatnonzero((self.kind == c) & (self.step == step))
                if not len(mine):
                    continue
                deep = int(self.reach[mine].max())
                lead = begin[mine] + (self.width[mine] if step > 0 else -1)
                keys = self._sampled(flat, lead, first[self.item[mine]], (first + self.words)[self.item[mine]], self.segment[mine], int(c), step, deep)
                tables = []
                for t in range(deep):
                    there = np.flatnonzero(self.reach[mine] > t)
                    order = there[np.argsort(keys[there, t], kind="stable")]
                    tables.append((keys[order, t], mine[order]))
                self.tables[int(c), step] = tables

    def ids(self, word: np.ndarray) -> np.ndarray:
        """Places in the items' vocabulary; -1: in no item."""
        if not len(self.vocabulary):
            return np.full(len(word), -1)
        slot = np.minimum(np.searchsorted(self.vocabulary, word), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[slot] == word, slot, -1)

    @staticmethod
    def _steps(c: int) -> int:
        return max(3, int(1.6 * CLASSES[c]))

    @staticmethod
    def _keys(ids: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
        """A key of the ``width`` words from each place."""
        out = np.full(len(at), width, np.uint64)
        for k in range(width):
            out = out * _P + (ids[at + k] + 2).astype(np.uint64)
        return common.mix(out)

    def _sampled(self, ids, starts, firsts, ends, segments, c: int, step: int, deep: int) -> np.ndarray:
        """(window, table) keys of the first ``deep`` tables: the segment, and what the walks from
        ``start`` over ``ids[first:end]`` put at the sampled places; blanks stand before and after."""
        out = np.empty((len(starts), deep), np.uint64)
        word = common.mix((ids + 2).astype(np.uint64)) if len(ids) else np.zeros(1, np.uint64)
        # the walks take turns, so that a few tables have several walks
        for walk in range(min(WALKS, deep)):
            at, seen = starts.copy(), np.empty((self._steps(c), len(starts)), np.uint64)
            for j in range(len(seen)):
                inside = (at >= firsts) & (at < ends)
                seen[j] = np.where(inside, word[np.clip(at, 0, len(word) - 1)], _BLANK)
                at += step * (common.mix(seen[j] ^ self.bits[walk, j]) & np.uint64(1)).astype(np.int64)
            for t in range(walk, deep, WALKS):
                key = segments + np.uint64(t + 1)
                for place in self.places[c][t]:
                    key = common.mix(key * _P + seen[place])
                out[:, t] = key
        return out

    def candidates(self, ids: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int]]:
        """(text, start, item) that some table brings together; ``first``: starts of the texts.

        The start is the item's if nothing before the segment was added or left out; it may lie
        before the text.
        """
        found, _ = self._met(ids, first)
        return sorted(found)

    def _met(self, ids: np.ndarray, first: np.ndarray) -> tuple[set, dict]:
        """The candidates, and the first table that brings each text and item together."""
        end = np.append(first[1:], len(ids))
        windows: dict[tuple[int, int], list] = defaultdict(list)
        found: set[tuple[int, int, int]] = set()
        table: dict[tuple[int, int], int] = {}
        for width, (unique, bounds, entries) in self.segments.items():
            at = np.flatnonzero(ids >= 0)
            for k in range(1, width):
                at = at[ids[np.minimum(at + k, len(ids) - 1)] >= 0]
            at = at[at + width <= len(ids)]
            if not len(at):
                continue
            key = self._keys(ids, width, at)
            slot = np.minimum(np.searchsorted(unique, key), len(unique) - 1)
            hit = unique[slot] == key
            at, slot = at[hit], slot[hit]
            text = np.searchsorted(first, at, "right") - 1
            before, after = at - first[text], end[text] - at - width
            many = bounds[slot + 1] - bounds[slot]
            of = np.repeat(np.arange(len(at)), many)
            entry = entries[np.repeat(bounds[slot] - np.cumsum(many) + many, many) + np.arange(many.sum())]
            # every word that the text is too short for, on either side, is an edit
            item = self.item[entry]
            lacking = np.maximum(self.offset[entry] - before[of], 0) + np.maximum(self.words[item] - self.offset[entry] - width - after[of], 0)
            near = lacking <= self.allowed[item]
            of, entry = of[near], entry[near]
            alone = self.kind[entry] < 0
            for w, e in zip(of[alone], entry[alone], strict=True):
                found.add((int(text[w]), int(at[w]), int(self.item[e])))
                table[int(text[w]), int(self.item[e])] = 0
            code = self.kind[entry] * 2 + (self.step[entry] > 0)
            for c in np.unique(code[~alone]):
                own = np.unique(of[code == c])
                windows[int(c) // 2, 1 if c % 2 else -1].append((at[own], text[own], unique[slot[own]], np.full(len(own), width)))
        for (c, step), parts in windows.items():
            at, text, segment, width = (np.concatenate(x) for x in zip(*parts, strict=True))
            tables = self.tables[c, step]
            keys = self._sampled(ids, at + width if step > 0 else at - 1, first[text], end[text], segment, c, step, len(tables))
            for t, (sorted_keys, own) in enumerate(tables):
                low, high = np.searchsorted(sorted_keys, keys[:, t]), np.searchsorted(sorted_keys, keys[:, t], "right")
                for w in np.flatnonzero(high > low):
                    met = own[low[w] : high[w]]
                    for item, begin in zip(self.item[met].tolist(), (at[w] - self.offset[met]).tolist(), strict=True):
                        found.add((int(text[w]), begin, item))
                        pair = int(text[w]), item
                        table[pair] = min(table.get(pair, t), t)
        return found, table


def edited(words: np.ndarray, count: int, kind: str, rng: np.random.Generator) -> np.ndarray:
    """``count`` words replaced by others, left out, or added, at random places."""
    at = np.sort(rng.choice(len(words), count, replace=False)) if kind != "inserted" else np.sort(rng.integers(0, len(words) + 1, count))
    if kind == "deleted":
        return np.delete(words, at)
    if kind == "inserted":
        return np.insert(words, at, -1)
    out = words.copy()
    out[at] = -1
    return out


@lru_cache(256)
def tables_for(length: int, edits: float, recall: float) -> int:
    """Tables that bring back ``recall`` of the items of a length, edited as much as is allowed by
    replacing, leaving out or adding words; found by trying ``TRIALS`` items for each kind."""
    rng = np.random.default_rng(length)
    items = [(k, np.arange(k * length, (k + 1) * length)) for k in range(TRIALS)]
    index = Index.__new__(Index)
    index._enter(items, edits, None)
    needed = 1
    for kind in ("replaced", "deleted", "inserted"):
        texts = [np.concatenate([np.full(length, -1), edited(x, _allowed(length, edits), kind, rng), np.full(length, -1)]) for _, x in items]
        ids = np.concatenate(texts)
        first = np.cumsum([len(t) for t in texts]) - np.array([len(t) for t in texts])
        _, table = index._met(ids, first)
        met = sorted(table.get((k, k), WALKS * TABLES) for k in range(TRIALS))
        needed = max(needed, min(WALKS * TABLES, met[int(np.ceil(recall * TRIALS)) - 1] + 1))
    return needed


def best_match(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(edits, end) of the passage of ``text`` nearest to ``item``, the first such."""
    n = len(item)
    column, step = np.arange(n + 1), np.arange(n + 1)
    best = (n, 0)
    for j, word in enumerate(text):
        new = np.empty(n + 1, np.int64)
        new[0] = 0
        new[1:] = np.minimum(column[:-1] + (item != word), column[1:] + 1)
        column = np.minimum.accumulate(new - step) + step
        if column[n] < best[0]:
            best = int(column[n]), j + 1
    return best


def _nearest(item: np.ndarray, ids: np.ndarray, begins: list[int], k: int, first: int, end: int) -> tuple[int, int] | None:
    """(edits, end) of the nearest passage to an item that begins within ``k`` words of one of
    ``begins`` (ascending), in the text ``ids[first:end]``; the first such."""
    n = len(item)
    for begin in begins:
        if begin >= first and np.array_equal(ids[begin : min(end, begin + n)], item):
            return 0, begin + n
    best, k0 = None, 0
    while k0 < len(begins):  # places whose surroundings overlap are searched together
        k1 = k0 + 1
        while k1 < len(begins) and begins[k1] - k <= begins[k1 - 1] + n + 2 * k:
            k1 += 1
        low, high = max(first, begins[k0] - k), min(end, begins[k1 - 1] + n + 2 * k)
        if high > low:
            edits, at = best_match(item, ids[low:high])
            if best is None or edits < best[0]:
                best = edits, low + at
        k0 = k1
    return best


def _found(index, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix: Index = index.value
        for batch in common.slices(batches):
            word, offsets = sequences(batch.column("text"))
            ids = np.insert(ix.ids(word), offsets[1:], -1)  # one foreign word ends each text
            first = offsets[:-1] + np.arange(batch.num_rows)
            end = np.append(first[1:], len(ids))
            best: dict[tuple[int, int], tuple[int, int, int]] = {}
            starts: dict[tuple[int, int], list[int]] = defaultdict(list)
            for doc, start, at in ix.candidates(ids, first) if ix.items else []:
                starts[doc, at].append(start)
            for (doc, at), begins in starts.items():
                item, k = ix.items[at][1], int(ix.allowed[at])
                found = _nearest(item, ids, begins, k, int(first[doc]), int(end[doc]))
                if found and found[0] <= k:
                    best[doc, at] = found[0], found[1] - int(first[doc]), len(item)
            doc_id, text_key = batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist()
            rows = [(doc_id[d], text_key[d], ix.items[at][0], *found) for (d, at), found in sorted(best.items())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((batch.schema.field("doc_id").type, pa.int64(), _ARROW.get(kind, pa.int64()), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "text_key", "item_id", "edit_distance", "end_word", "item_words"],
            )

    return run


_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}


def leaks(docs: DataFrame, benchmark: DataFrame, edits: float = 0.2, min_words: int = 1, items: int = ITEMS, recall: float = RECALL) -> DataFrame:
    """One row per document and item it holds: doc_id, text_key, item_id, edit_distance, end_word
    (words up to the passage's end), item_words.

    ``recall`` is the share of the passages within the allowed edits that the tables are laid out to
    find. Items too short for an edit are searched exactly. Items shorter than ``min_words`` words
    (NULL and empty ones always) match nothing. Of several passages the nearest counts, the earliest among equals. NULL and empty texts
    hold nothing; a NULL doc_id or item_id is reported as NULL; repeated rows are reported each;
    repeated items once; other columns are ignored.
    """
    texts = common.body(docs).withColumn("text_key", F.xxhash64("text"))
    asked = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    asked = common.saved(asked, "items")
    blocks = max(1, -(-asked.count() // items))
    doc_kind, item_kind = dict(texts.dtypes)["doc_id"], dict(asked.dtypes)["item_id"]
    out = f"doc_id {doc_kind}, text_key long, item_id {item_kind}, edit_distance long, end_word long, item_words long"
    found = None
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()  # about ``items`` rows
        index = common.shared(docs.sparkSession, Index(sorted(((r[0], r[1]) for r in own), key=repr), edits, max(1, min_words), recall))
        part = texts.mapInArrow(_found(index, item_kind), out)
        found = part if found is None else found.unionByName(part)
    return found
