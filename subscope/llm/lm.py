"""Language-model scoring by logistic mixing of hashed-context bit predictors.

A text is its words, A-Z in lower case, and an end. The most frequent words, the end and an escape
are leaves of a binary tree; a rarer word is the escape, then its bytes and a blank, each byte a leaf
of a second tree. So a text is a row of bits. Each bit is predicted by several contexts:

* in the first tree: none, the topic so far, the topic and the last byte of the word before, and the
  word before if it is one of the most frequent (else its last byte);
* in the second tree: the topic and the last one, two or three bytes, and the last four bytes.

The topic is the likeliest class of a mixture of unigrams given the words before it in the text. A
context and a node make a slot of a table with counts of both bits, gathered from all training text.
The predictors' logits are added with weights that a gate selects (how well the two longest contexts
are known), the weights are learned online, block after block of bits, and an adaptive map corrects
the mixed probability at last. The bits' costs add up to the probability of the text.

Counts grow with the corpus and are added in 64 bits; the tables have a fixed size. The byte code
comes from the bytes of all training words. Topics, weights and map start from a bounded sample, then
all training documents teach them: topics by rounds of expectation-maximisation, weights and map
online, in groups dealt out by hash, a task a group; the groups' weights are averaged by the bits
they saw and their maps' counts are added. All sums are exact, so that neither the order nor the
partitions of the input matter. A training document's own bits are taken out of the counts that
predict them.
"""

from __future__ import annotations

import copy
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm import common

#: Training documents from which topics, weights and map start at most, and their longest text.
SAMPLE, SAMPLE_CHARS = 600, 20_000
#: Rounds in which all training documents fit the topics.
ROUNDS = 2
#: One training document in so many learns weights and map (1: all of them), in groups of about so many.
SHARE, GROUP = 1, 4096
#: Bits that a task counts before it hands its tables on, and different tokens that it holds before
#: they are counted.
HANDED, HELD = 1 << 30, 1 << 20
#: Most frequent words that every task knows for the base score, and those that are leaves, if they
#: are that frequent at least.
FREQUENT, LEAVES, LEAST = 1 << 18, 1 << 17, 8
TOPICS = 8
#: Most frequent words that are a context by themselves.
NAMED = 512
#: Tables: (name, slots as a power of two) in the order of the predictors of each tree.
TREE = (("none", 18), ("topic", 21), ("ending", 21), ("word", 21))
BYTES = (("one", 17), ("two", 20), ("three", 21), ("four", 21))
TABLES = [*TREE, *BYTES]
#: Slots that travel together.
BLOCK = 1 << 13
GATES, MAP, RATE = 16, 33, 3.0
#: Different tokens, and symbols of rare words, whose costs a scoring task keeps at most for its next texts.
KEPT = 1 << 20
#: Bits of rare words' symbols whose logits a learning task keeps for its next texts.
KEPT_BITS = 1 << 19
#: Places of the mixed logit that scoring tells apart.
PLACES = 2048
_BLANK = 0x20
_K = np.random.default_rng(99).integers(1, 1 << 62, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CODEC = pa.Codec("zstd", compression_level=1)
_TOKENS = 1 << 11
#: Tokens of a block of online learning, and those among which different ones are looked up once.
_STEP, _WINDOW = 1 << 10, 1 << 18


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, word numbers of all tokens in a row, tokens per text), ends left out."""
    # a copy, as ascii_lower misreads a slice that was cast
    own = texts.take(pa.array(np.arange(len(texts)))).cast(pa.large_string()).fill_null("")
    split = pc.ascii_split_whitespace(pc.ascii_lower(own))
    flat = pc.list_flatten(split)
    text = pc.list_parent_indices(split).to_numpy()
    coded = flat.dictionary_encode()
    number, words = coded.indices.to_numpy(), coded.dictionary
    empty = pc.index(words, pa.scalar("", words.type)).as_py()
    if empty >= 0:
        keep = number != empty
        number, text = number[keep], text[keep]
    return words, number, np.bincount(text, minlength=len(texts))


class Code:
    """A prefix code: for leaf i, entries ``first[i]:first[i + 1]`` of inner nodes and bits."""

    def __init__(self, counts: np.ndarray):
        n = len(counts)
        heap = [(int(c) + 1, s) for s, c in enumerate(counts)]
        heapq.heapify(heap)
        parent, side = np.full(2 * n, -1), np.zeros(2 * n, np.int8)
        inner = n
        while len(heap) > 1:
            (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
            parent[x] = parent[y] = inner
            side[y] = 1
            heapq.heappush(heap, (a + b, inner))
            inner += 1
        leaf, at, steps = [], [], []
        now, step = np.arange(n), 0
        own = np.arange(n)
        while len(now):
            up = parent[now] >= 0
            now, own = now[up], own[up]
            leaf.append(own)
            at.append(np.stack([parent[now] - n, side[now]], 1))
            steps.append(np.full(len(own), -step))
            now, step = parent[now], step + 1
        leaf, at, steps = np.concatenate(leaf), np.concatenate(at), np.concatenate(steps)
        order = np.lexsort((steps, leaf))
        self.nodes, self.bits = at[order, 0].astype(np.uint64), at[order, 1].astype(np.int8)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(leaf, minlength=n))])
        self.size = np.diff(self.first)

    def entries(self, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the leaf, entry) of every bit of the leaves in a row."""
        size = self.size[leaves]
        total = np.cumsum(size)
        entry = np.arange(int(total[-1]) if len(total) else 0) + np.repeat(self.first[leaves] - total + size, size)
        return np.repeat(np.arange(len(leaves)), size), entry

    def spell(self, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the leaf, node, bit) of every bit of the leaves in a row."""
        at, entry = self.entries(leaves)
        return at, self.nodes.take(entry), self.bits.take(entry)


class Setting:
    """What training and scoring share: leaves, codes and topics."""

    def __init__(self, words: pa.Array, times: np.ndarray, rest: int, ends: int, sample: pa.Array, symbols: np.ndarray | None = None):
        self.words = words
        self.tree = Code(np.concatenate([times, [rest, ends]]))
        if symbols is None:
            data, _ = _raw(pc.ascii_lower(sample))
            symbols = np.bincount(data, minlength=256) + np.bincount([_BLANK], minlength=256) * max(1, len(data) // 8)
        self.bytes = Code(symbols)
        self.topics = np.zeros((len(words) + 2, TOPICS), np.float32)
        self.prior = np.zeros(TOPICS, np.float32)
        self._learn_topics(sample)

    def _learn_topics(self, sample: pa.Array) -> None:
        """Classes of the sample by expectation-maximisation over a mixture of unigrams."""
        if len(sample) < TOPICS or not len(self.words):
            return
        words, number, per_text = tokens(sample)
        leaf = self.leaves(words)[number]
        text = np.repeat(np.arange(len(per_text)), per_text)
        pair, times = np.unique(text * np.int64(len(self.words) + 2) + leaf, return_counts=True)
        text, leaf = pair // (len(self.words) + 2), pair % (len(self.words) + 2)
        best = None
        for restart in range(4):
            share = np.random.default_rng(restart).dirichlet(np.full(TOPICS, 0.3), len(per_text))
            for _ in range(40):
                mass = np.stack([np.bincount(leaf, weights=times * share[text, k], minlength=len(self.words) + 2) for k in range(TOPICS)], 1)
                average = mass.sum(1, keepdims=True) / max(1, mass.sum())
                rate, prior = _rates(mass, average, share.sum(0), len(share))
                score = np.stack([np.bincount(text, weights=times * rate[leaf, k], minlength=len(per_text)) for k in range(TOPICS)], 1) + prior
                top = score.max(1, keepdims=True)
                share = np.exp(score - top)
                total = float((top[:, 0] + np.log(share.sum(1))).sum())
                share /= share.sum(1, keepdims=True)
            if best is None or total > best:
                best, self.topics, self.prior = total, rate.astype(np.float32), prior.astype(np.float32)
        self.topics -= self.topics.mean(1, keepdims=True)

    def tree_bits(self, leaf: np.ndarray, topic: np.ndarray, ending: np.ndarray, past: np.ndarray):
        """(token of each bit, bit, slots of the four tables) in the first tree."""
        at, entry = self.tree.entries(leaf)
        size = self.tree.size[leaf]
        node = self.tree.nodes.take(entry)
        far = node * _K[5]
        contexts = (
            node,
            node * np.uint64(TOPICS) + np.repeat(topic, size),
            _mixed(np.repeat(_ending(ending, topic), size) + far),
            _mixed(np.repeat(_past(past), size) + far),
        )
        return at, self.tree.bits.take(entry), [_slot(c, k) for c, (_, k) in zip(contexts, TREE, strict=True)]

    def byte_bits(self, key: np.ndarray):
        """(symbol of each bit, bit, slots of the four tables) in the second tree; see ``Bits.symbols``."""
        at, entry = self.bytes.entries(key & 255)
        node = self.bytes.nodes.take(entry)
        return at, self.bytes.bits.take(entry), [self.byte_slots(k, key, node) for k in range(4)]

    def byte_slots(self, k: int, key: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Slots of all bits of symbols in a table of the second tree."""
        of = key.view(np.uint64)
        # a context's fields have bits of their own: their products by an odd number add up
        if k == 3:
            context = of & np.uint64(0xFFFFFFFF00)
        else:
            context = of >> np.uint64(40) << np.uint64(16) | of & np.uint64(0xFF00) | (of & np.uint64((0, 0xFF0000, 0xFFFF0000)[k])) << np.uint64(8)
        by = _K[(6, 2, 3, 4)[k]]
        return _slot(_mixed(np.repeat(context * by, self.bytes.size[key & 255]) + node * by), BYTES[k][1])

    def leaves(self, words: pa.Array) -> np.ndarray:
        """Leaves of words; the escape (the last but one) if a word is none."""
        if not len(self.words):
            return np.zeros(len(words), np.int64)
        return pc.index_in(words, value_set=self.words.cast(words.type)).fill_null(len(self.words)).to_numpy().astype(np.int64)


def _rates(mass: np.ndarray, average: np.ndarray, share: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Log rates of the leaves in each topic, and log shares of the topics."""
    rate = np.log((mass + 20 * average + 1e-9) / (mass.sum(0) + 20 + 1e-9 * len(mass)))
    return rate, np.log((share + 1) / (texts + TOPICS))


#: Parts of one that a text's shares in the topics are added up in.
_PARTS = 1 << 16


def _parted(shared):
    """What a partition's texts give to (leaf, topic), as whole numbers; the leaf -1 stands for the
    texts themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        setting: Setting = shared.value
        leaves = len(setting.words) + 2
        mass, share_of = np.zeros((leaves, TOPICS), np.int64), np.zeros(TOPICS, np.int64)
        for part in common.slices(batches, limit=4 * common.SLICE_BYTES):
            words, number, per_text = tokens(part.column("text"))
            of_word = setting.leaves(words)
            text = np.repeat(np.arange(len(per_text)), per_text)
            gain = setting.topics[of_word].astype(np.float64)
            score = np.stack([np.bincount(text, weights=gain[:, k].copy().take(number), minlength=len(per_text)) for k in range(TOPICS)], 1) + setting.prior
            share = np.exp(score - score.max(1, keepdims=True))
            share = np.rint(share / share.sum(1, keepdims=True) * _PARTS)
            share_of += share.sum(0).astype(np.int64)
            own = np.stack([np.bincount(number, weights=share[:, k].copy().take(text), minlength=len(words)) for k in range(TOPICS)], 1).astype(np.int64)
            known = of_word < len(setting.words)
            mass[of_word[known]] += own[known]  # different words
            mass[len(setting.words)] += own[~known].sum(0)
        used = np.flatnonzero(mass.any(1))
        rows = np.concatenate([mass[used], share_of[None]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1), pa.int32()), *(pa.array(rows[:, k]) for k in range(TOPICS))], names=["leaf", *(f"m{k}" for k in range(TOPICS))]
        )

    return run


def fit_topics(train: DataFrame, setting: Setting) -> None:
    """Rounds of expectation-maximisation over all training documents, from the sample's topics."""
    if not setting.topics.any():
        return
    names = [f"m{k}" for k in range(TOPICS)]
    for _ in range(ROUNDS):
        known = common.shared(train.sparkSession, setting)
        parts = train.select("text").mapInArrow(_parted(known), "leaf int, " + ", ".join(f"{n} long" for n in names))
        added = parts.groupBy("leaf").agg(*[F.sum(n).alias(n) for n in names]).toArrow()  # a row for each leaf
        known.destroy()
        leaf, sums = added["leaf"].to_numpy(), np.stack([added[n].to_numpy() for n in names], 1) / _PARTS
        mass = np.zeros((len(setting.words) + 2, TOPICS))
        mass[leaf[leaf >= 0]] = sums[leaf >= 0]
        share = sums[leaf < 0].sum(0)
        rate, prior = _rates(mass, mass.sum(1, keepdims=True) / max(1, mass.sum()), share, share.sum())
        setting.topics, setting.prior = (rate - rate.mean(1, keepdims=True)).astype(np.float32), prior.astype(np.float32)


class Bits:
    """The bits of a few texts' tokens, ends put in: token by token, tree bits then byte bits."""

    def __init__(self, setting: Setting, words: pa.Array, number: np.ndarray, per_text: np.ndarray, leaf: np.ndarray | None = None):
        """``leaf``: the words' leaves, if they are known."""
        self.setting = setting
        n = len(words)
        data, offsets = _raw(words)
        self.data, self.offsets = data, offsets
        leaf = np.append(setting.leaves(words) if leaf is None else leaf, len(setting.words) + 1)
        ending = np.append(data[offsets[1:] - 1] if n else data[:0], 0).astype(np.uint64)
        self.number = np.insert(number.astype(np.int64), np.cumsum(per_text), n)
        self.per_text = per_text + 1
        first = np.cumsum(self.per_text) - self.per_text
        self.leaf = leaf[self.number]
        # of the word before: its last byte, and what stands for it (0: none is before)
        stands = np.where(leaf < NAMED, leaf.astype(np.uint64) + np.uint64(257), ending + np.uint64(1))
        self.ending, self.past = np.zeros(len(self.leaf), np.uint64), np.zeros(len(self.leaf), np.uint64)
        self.ending[1:], self.past[1:] = ending[self.number[:-1]], stands[self.number[:-1]]
        self.ending[first] = self.past[first] = 0
        # the topic before each token: the first of the likeliest
        self.topic = np.zeros(len(self.leaf), np.uint64)
        gains = setting.topics[leaf].T.copy()
        ends = np.append(first, len(self.leaf))
        a = 0
        while a < len(first):
            # texts of so many tokens at a time that sums stay in the cache
            b = max(a + 1, int(np.searchsorted(ends, first[a] + 8 * _TOKENS, "right")) - 1)
            own = slice(int(ends[a]), int(ends[b]))
            start, many, number, topic, best = first[a:b] - first[a], self.per_text[a:b], self.number[own], self.topic[own], None
            for k in range(TOPICS):
                gain = gains[k].take(number).astype(np.float64)
                total = np.cumsum(gain)
                total -= gain
                total -= np.repeat(total[start], many)
                total += setting.prior[k]
                if best is None:
                    best = total
                else:
                    topic[total > best] = k
                    np.maximum(best, total, out=best)
            a = b

    def cut(self, texts: slice) -> Bits:
        """Those of some of the texts."""
        out = copy.copy(self)
        start = int(self.per_text[: texts.start].sum())
        out.per_text = self.per_text[texts]
        own = slice(start, start + int(out.per_text.sum()))
        out.number, out.leaf, out.topic, out.ending, out.past = (x[own] for x in (self.number, self.leaf, self.topic, self.ending, self.past))
        return out

    def pieces(self) -> Iterator[slice]:
        for a in range(0, len(self.leaf), _TOKENS):
            yield slice(a, a + _TOKENS)

    def keys(self, piece: slice = slice(None)) -> np.ndarray:
        """What the first tree's bits and slots of every token depend on, as a number; see ``parts``."""
        far = self.leaf[piece] * TOPICS + self.topic[piece].view(np.int64)
        return ((far << 10) + self.past[piece].view(np.int64) << 8) + self.ending[piece].view(np.int64)

    @staticmethod
    def parts(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(leaf, topic, byte before, what stands for the word before) of such numbers."""
        far = key >> 18
        return far // TOPICS, (far % TOPICS).view(np.uint64), (key & 255).view(np.uint64), (key >> 8 & 1023).view(np.uint64)

    def tree(self, piece: slice):
        """(token of each bit, bit, slots of the four tables) in the first tree."""
        return self.setting.tree_bits(self.leaf[piece], self.topic[piece], self.ending[piece], self.past[piece])

    def rare(self, piece: slice) -> np.ndarray:
        return np.flatnonzero(self.leaf[piece] == len(self.setting.words))

    def spelled(self, piece: slice):
        """The same in the second tree, for the piece's rare words."""
        rare = self.rare(piece)
        at, bit, slots = self.letters(self.number[piece][rare], self.topic[piece][rare])
        return rare.take(at), bit, slots

    def letters(self, word: np.ndarray, topic: np.ndarray):
        """(place of each bit, bit, slots) in the second tree of words by their numbers and topics."""
        owner, key = self.symbols(word, topic)
        of, bit, slots = self.setting.byte_bits(key)
        return owner.take(of), bit, slots

    def symbols(self, word: np.ndarray, topic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the word, what the second tree's bits and slots depend on) of every symbol of words
        by their numbers and topics. The latter is a number: topic, the fourth to the first byte before
        the symbol (none: 0, for the first a blank), the symbol."""
        size = self.offsets[word + 1] - self.offsets[word] + 1
        total = np.cumsum(size)
        owner = np.repeat(np.arange(len(word)), size)
        place = np.arange(len(owner)) - np.repeat(total - size, size)
        at = np.minimum(np.repeat(self.offsets[word], size) + place, max(0, len(self.data) - 1))
        symbol = self.data.take(at).astype(np.int64) if len(self.data) else np.zeros(len(at), np.int64)
        symbol[total - 1] = _BLANK
        key = np.repeat(topic.astype(np.int64) << 40, size)
        key |= symbol
        for k in (1, 2, 3, 4):
            past = np.zeros(len(symbol), np.int64)
            past[k:] = symbol[:-k] if len(symbol) > k else past[k:]
            past[place < k] = _BLANK if k == 1 else 0
            past <<= 8 * k
            key |= past
        return owner, key


def _raw(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words = words.cast(pa.large_string())
    if not len(words):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8) if words.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _ending(ending: np.ndarray, topic: np.ndarray) -> np.ndarray:
    return common.mix((ending << np.uint64(8) | topic) * _K[0])


def _past(past: np.ndarray) -> np.ndarray:
    return common.mix(past * _K[1])


def _mixed(x: np.ndarray) -> np.ndarray:
    """One round: the upper bits of a product come down."""
    return (x ^ (x >> np.uint64(32))) * _K[7] >> np.uint64(20)


def _slot(context: np.ndarray, size: int) -> np.ndarray:
    return (context & np.uint64((1 << size) - 1)).view(np.int64)


def _gather(shared):
    """Counts of both bits in every slot, over a whole partition; only used blocks come out."""

    def handed(tables: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for k, table in enumerate(tables):
            blocks = table.reshape(-1, 2 * BLOCK)
            used = np.flatnonzero(blocks.any(1))
            for a in range(0, len(used), 64):
                rows = used[a : a + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), k), pa.int32()), pa.array(rows, pa.int32()), pa.array([_packed(blocks[r], _PART) for r in rows], pa.binary())], names=["table", "block", "counts"]
                )
            table[:] = 0

    def spelled(setting: Setting, tables: list[np.ndarray], held: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """The second tree's bits of all symbols held, each different symbol of a table once."""
        key, times = _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
        for k, seen in enumerate((7 << 40 | 0xFFFF, 7 << 40 | 0xFFFFFF, 7 << 40 | 0xFFFFFFFF, (1 << 40) - 1)):
            own, often = _summed(key & seen, times)
            for a in range(0, len(own), 4 * _TOKENS):
                x = own[a : a + 4 * _TOKENS]
                at, entry = setting.bytes.entries(x & 255)
                slot = setting.byte_slots(k, x, setting.bytes.nodes.take(entry))
                np.add.at(tables[4 + k], 2 * slot + setting.bytes.bits.take(entry), often[a : a + 4 * _TOKENS].astype(np.int32).take(at))

    def counted(setting: Setting, tables: list[np.ndarray], held: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """The first tree's bits of all tokens held, each different token of a table once."""
        key, times = _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
        leaf, topic, ending, past = Bits.parts(key)
        pair = leaf * TOPICS + topic.view(np.int64)
        for k, own in enumerate((leaf, pair, (pair << 8) + ending.view(np.int64), (leaf << 10) + past.view(np.int64))):
            own, often = _summed(own, times)
            for a in range(0, len(own), _TOKENS):
                x = own[a : a + _TOKENS]
                at, entry = setting.tree.entries(x if k == 0 else x // TOPICS if k == 1 else (x >> 8) // TOPICS if k == 2 else x >> 10)
                node = setting.tree.nodes.take(entry)
                if k == 1:
                    node = node * np.uint64(TOPICS) + (x % TOPICS).view(np.uint64).take(at)
                elif k:
                    context = _ending((x & 255).view(np.uint64), ((x >> 8) % TOPICS).view(np.uint64)) if k == 2 else _past((x & 1023).view(np.uint64))
                    node = _mixed(context.take(at) + node * _K[5])
                np.add.at(tables[k], 2 * _slot(node, TREE[k][1]) + setting.tree.bits.take(entry), often[a : a + _TOKENS].astype(np.int32).take(at))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        setting: Setting = shared.value
        tables, seen, held, rare = [np.zeros(2 << size, np.int32) for _, size in TABLES], 0, [], []
        for part in common.slices(batches, limit=2 * common.SLICE_BYTES):
            bits = Bits(setting, *tokens(part.column("text")))
            key = bits.keys()
            for a in range(0, len(key), HELD):
                piece = slice(a, a + HELD)
                held.append(np.unique(key[piece], return_counts=True))
                seen += int(setting.tree.size[bits.leaf[piece]].sum())
                escaped = bits.rare(piece)
                # not too many letters at a time
                for b in range(0, len(escaped), 8 * _TOKENS):
                    some = escaped[b : b + 8 * _TOKENS]
                    symbol = bits.symbols(bits.number[piece][some], bits.topic[piece][some])[1]
                    seen += int(setting.bytes.size[symbol & 255].sum())
                    rare.append(np.unique(symbol, return_counts=True))
                    if sum(len(x) for x, _ in rare) > HELD:
                        spelled(setting, tables, rare)
                        rare = []
                if seen > HANDED or sum(len(x) for x, _ in held) > HELD:
                    counted(setting, tables, held)
                    held = []
                if seen > HANDED:
                    if rare:
                        spelled(setting, tables, rare)
                        rare = []
                    yield from handed(tables)
                    seen = 0
        if held:
            counted(setting, tables, held)
        if rare:
            spelled(setting, tables, rare)
        yield from handed(tables)

    return run


def _summed(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and their times together."""
    order = np.argsort(key)
    key, times = key[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
    return key[first], np.add.reduceat(times, first) if len(first) else times


_PART, _WHOLE = "<i4", "<i8"


def _packed(block: np.ndarray, kind: str = _WHOLE) -> bytes:
    return _CODEC.compress(np.ascontiguousarray(block, kind).tobytes(), asbytes=True)


def _opened(data: bytes, kind: str = _WHOLE) -> np.ndarray:
    return np.frombuffer(_CODEC.decompress(data, 2 * BLOCK * np.dtype(kind).itemsize, asbytes=True), kind)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by (table, block), equal ones added up in 64 bits; one is held at a time."""
    key, total = None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([_packed(total)], pa.binary())], names=["table", "block", "counts"])

    for batch in batches:
        for table, block, data in zip(*(batch.column(c).to_pylist() for c in ("table", "block", "counts")), strict=True):
            if (table, block) != key:
                if key is not None:
                    yield out()
                key, total = (table, block), np.zeros(2 * BLOCK, np.int64)
            total += _opened(data, _PART)
    if key is not None:
        yield out()


def _restored(kind: str, packed: list[list[tuple[bytes, int]]]) -> Tables:
    return Tables(np.concatenate([np.frombuffer(_CODEC.decompress(x, size, asbytes=True), kind) for x, size in own]) for own in packed)


class Tables(list):
    """Tables of one kind of number that travel and lie on disk packed: every executor keeps its own file
    of what is sent to it, and most slots are empty until the corpus is large."""

    def __reduce__(self):
        cut = [[np.ascontiguousarray(t[a : a + 64 * BLOCK]) for a in range(0, len(t), 64 * BLOCK)] for t in self]
        return _restored, (self[0].dtype.str, [[(_CODEC.compress(x.tobytes(), asbytes=True), x.nbytes) for x in own] for own in cut])


def _logit(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.clip(np.log((one + 0.4) / (zero + 0.4)), -10.5, 10.5)


def _seen(total: np.ndarray) -> np.ndarray:
    """How well a context is known, 0 to 3."""
    return (total > 0).astype(np.int8) + (total > 2) + (total > 15)


#: Logits are 0 or of 2**-24 to 10.5 in size: scaled down they leave two bits of a float's exponent free.
_DOWN, _UP, _LEVEL = np.float32(2.0**-100), np.float32(2.0**100), np.uint32(29)
_PLAIN = np.uint32(0xFFFFFFFF ^ (3 << 29))


class Before:
    """What the tables say of a bit that they have not seen: logits by slot and bit, and levels of the
    two longest contexts, in the same 32 bits. A text is part of the counts, so the bit itself is
    taken out."""

    def __init__(self, counts: list[np.ndarray]):
        self.tables = Tables()
        self.room = [(np.empty((0, 4), np.float32), np.empty(0, np.uint8)) for _ in range(2)]
        # symbols kept, the first of their bits, and how many bits these are
        self.kept = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for k, table in enumerate(counts):
            own = np.empty(len(table), np.uint32)
            zero, one = table[::2], table[1::2]
            for bit in range(2):
                left = (np.maximum(zero - 1, 0), one) if bit == 0 else (zero, np.maximum(one - 1, 0))
                logit = _logit(*left).astype(np.float32)
                if k % 4 > 1:
                    logit *= _DOWN
                own[bit::2] = logit.view(np.uint32)
                if k % 4 > 1:
                    own[bit::2] |= _seen(left[0] + left[1]).astype(np.uint32) << _LEVEL
            self.tables.append(own)

    @property
    def logits(self) -> list[np.ndarray]:
        return [_apart(t)[0] if k % 4 > 1 else t.view(np.float32) for k, t in enumerate(self.tables)]

    @property
    def levels(self) -> list[np.ndarray]:
        return [_apart(t)[1] for k, t in enumerate(self.tables) if k % 4 > 1]

    def _room(self, tree: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Room for n bits' four logits side by side, and for their gates and bits; used again and again."""
        rows, code = self.room[tree]
        if len(rows) < n:
            self.room[tree] = np.empty((n + n // 8, 4), np.float32), np.empty(n + n // 8, np.uint8)
            for old, now in zip((rows, code), self.room[tree], strict=True):
                now[: len(old)] = old
            rows, code = self.room[tree]
        return rows[:n], code[:n]

    def __reduce__(self):
        return _known, (self.tables,)

    def _inputs(self, tree: int, bit: np.ndarray, slots: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
        """(the four predictors' logits, gates)."""
        found = []
        for table, slot in zip(self.tables[4 * tree : 4 * tree + 4], slots, strict=True):
            slot = slot << 1
            slot += bit
            found.append(table.take(slot))
        third, fourth = (_apart(v) for v in found[2:])
        return [*(v.view(np.float32) for v in found[:2]), third[0], fourth[0]], (fourth[1] << np.uint8(2)) | third[1]

    def tree(self, bits: Bits) -> Iterator[tuple[int, list[int], np.ndarray, np.ndarray, np.ndarray]]:
        """(first token, ends of its blocks but the last, bits, logits, gates) of pieces of a text's
        tokens in the first tree; tokens that all tables see alike are looked up once a window."""
        setting = bits.setting
        for w in range(0, len(bits.leaf), _WINDOW):
            key, of = np.unique(bits.keys(slice(w, w + _WINDOW)), return_inverse=True)
            size = setting.tree.size[Bits.parts(key)[0]]
            first = np.cumsum(size) - size
            rows, code = self._room(0, int(size.sum()))
            for a in range(0, len(key), _TOKENS):
                _, bit, slots = setting.tree_bits(*Bits.parts(key[a : a + _TOKENS]))
                x, gate = self._inputs(0, bit, slots)
                gate <<= 1
                gate |= bit.view(np.uint8)
                own = slice(first[a], first[a] + len(bit))
                code[own] = gate
                for k, c in enumerate(x):
                    rows[own, k] = c
            for a in range(0, len(of), _TOKENS):
                at, total = _places(of[a : a + _TOKENS], first, size)
                each = code.take(at)
                yield w + a, total[_STEP - 1 : -1 : _STEP].tolist(), each & np.uint8(1), _rows(rows, at).T, each >> np.uint8(1)

    def spelled(self, bits: Bits) -> Iterator[tuple[int, list[int], np.ndarray, np.ndarray, np.ndarray]]:
        """The same in the second tree, where symbols that all tables see alike are looked up once."""
        setting = bits.setting
        for w in range(0, len(bits.leaf), _WINDOW):
            window = slice(w, w + _WINDOW)
            token = bits.rare(window)
            if not len(token):
                continue
            owner, key = bits.symbols(bits.number[window][token], bits.topic[window][token])
            key, of = np.unique(key, return_inverse=True)
            size = setting.bytes.size[key & 255]
            kept, kept_first, used = self.kept
            first, new = np.zeros(len(key), np.int64), np.ones(len(key), bool)
            if len(kept):
                place = np.searchsorted(kept, key)
                new = kept.take(place, mode="clip") != key
                first[~new] = kept_first[place[~new]]
            fresh, many = key[new], size[new]
            total = used + np.cumsum(many)
            first[new] = total - many
            filled = int(total[-1]) if len(total) else used
            rows, code = self._room(1, filled)
            for a in range(0, len(fresh), 4 * _TOKENS):
                _, bit, slots = setting.byte_bits(fresh[a : a + 4 * _TOKENS])
                x, gate = self._inputs(1, bit, slots)
                gate <<= 1
                gate |= bit.view(np.uint8)
                start = int(total[a] - many[a])
                own = slice(start, start + len(bit))
                code[own] = gate
                for k, c in enumerate(x):
                    rows[own, k] = c
            if filled <= KEPT_BITS and len(fresh):
                kept, kept_first = np.concatenate([kept, fresh]), np.concatenate([kept_first, first[new]])
                order = np.argsort(kept, kind="stable")
                self.kept = kept[order], kept_first[order], filled
            # the first symbol of each block of tokens
            place = np.searchsorted(token[owner], np.arange(0, min(_WINDOW, len(bits.leaf) - w) + _TOKENS, _STEP)).tolist()
            blocks = _TOKENS // _STEP
            for a in range(0, len(place) - blocks, blocks):
                cuts = place[a : a + blocks + 1]
                if cuts[0] < cuts[-1]:
                    at, total = _places(of[cuts[0] : cuts[-1]], first, size)
                    each = code.take(at)
                    yield w + a * _STEP, [int(total[c - cuts[0] - 1]) if c > cuts[0] else 0 for c in cuts[1:-1]], each & np.uint8(1), _rows(rows, at).T, each >> np.uint8(1)


def _known(tables: Tables) -> Before:
    out = Before([])
    out.tables = tables
    return out


def _places(own: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all bits of ``own``, where those of i are ``size[i]`` from ``first[i]`` on; bits up to each."""
    many = size[own]
    total = np.cumsum(many)
    return np.arange(int(total[-1])) + np.repeat(first[own] - total + many, many), total


def _apart(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(logits, levels) of what a table of ``Before`` holds in the same 32 bits."""
    logit = (v & _PLAIN).view(np.float32)
    logit *= _UP
    return logit, (v >> _LEVEL).astype(np.uint8) & np.uint8(3)


def _rows(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of four logits, which move as one number of 16 bytes."""
    return x.view(np.complex128).ravel().take(at).view(np.float32).reshape(-1, 4)


class Learned:
    """Weights by gate and what the adaptive map has counted, of either tree."""

    #: Steps of fixed-point numbers in which groups are added up.
    UNIT = 1 << 16

    def __init__(self, start: Learned | None = None):
        self.weights = np.full((2, GATES, 5), 0.3)
        self.weights[:, :, 0] = 0
        self.steps = [0, 0]
        if start is not None:
            self.weights, self.steps = start.weights.copy(), list(start.steps)
        self.bits = np.zeros((2, GATES))
        self.hits, self.mass = np.zeros((2, GATES, MAP)), np.zeros((2, GATES, MAP))

    def learn(self, tree: int, bits: Bits, known: Before, settled: int = 0) -> None:
        """Online: blocks of bits in their order, each predicted before it teaches; the map learns
        from the token ``settled`` on."""
        for a, ends, bit, x, gate in known.spelled(bits) if tree else known.tree(bits):
            # of each bit, by gate within each block: the mixed logit, and a place for its gate and bit
            z, own, start = np.empty(len(bit)), np.empty(len(bit), np.int64), len(bit)
            cuts = [0, *ends, len(bit)]
            for k, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if a + k * _STEP >= settled:
                    start = min(start, low)
                if low < high:
                    self._step(tree, x.T[low:high], gate[low:high], bit[low:high], z[low:high], own[low:high])
            if start < len(bit):
                self._mapped(tree, own[start:], z[start:])

    def _step(self, tree: int, x: np.ndarray, gate: np.ndarray, bit: np.ndarray, z: np.ndarray, own: np.ndarray) -> None:
        """A block of bits: what is predicted, and what its errors teach; the bits of a gate lie together."""
        weights = self.weights[tree]
        order = np.argsort(gate, kind="stable")
        x = _rows(x, order).T.astype(np.float64, order="C")
        bit = bit.take(order)
        cuts = np.searchsorted(gate, np.arange(GATES + 1, dtype=gate.dtype), sorter=order)
        seen = np.diff(cuts)
        own[:] = np.repeat(np.arange(GATES) * (2 * MAP), seen)
        own += bit
        each = np.repeat(weights.T, seen, axis=1)
        z[:] = each[0]
        for part, c in zip(each[1:], x, strict=True):
            part *= c
            z += part
        np.clip(z, -12, 12, out=z)
        gap = np.negative(z)
        np.exp(gap, out=gap)
        gap += 1
        np.divide(-1, gap, out=gap)
        gap += bit
        self.steps[tree] += 1
        self.bits[tree] += seen
        some = np.flatnonzero(seen)
        at, error = cuts[some], np.zeros((GATES, 5))
        error[some, 0] = np.add.reduceat(gap, at)
        x *= gap
        error[some, 1:] = np.add.reduceat(x, at, axis=1).T
        weights += RATE / (1 + self.steps[tree] / 20) ** 0.5 * error / (seen + 50.0)[:, None]

    def _mapped(self, tree: int, own: np.ndarray, z: np.ndarray) -> None:
        """A bit is shared by the two places of the map beside its logit."""
        low, share = _place(z)
        low <<= 1
        low += own
        many = np.bincount(low, minlength=2 * GATES * MAP).reshape(GATES, MAP, 2)
        upper = np.bincount(low, weights=share, minlength=2 * GATES * MAP).reshape(GATES, MAP, 2)
        lower = many - upper
        for out, of in ((self.hits[tree], lambda y: y[:, :, 1]), (self.mass[tree], lambda y: y.sum(2))):
            out += of(lower)
            out[:, 1:] += of(upper)[:, :-1]

    def sums(self) -> np.ndarray:
        """What groups add up, in fixed-point numbers."""
        flat = np.concatenate([(self.weights * self.bits[:, :, None]).ravel(), self.bits.ravel(), self.hits.ravel(), self.mass.ravel()])
        return np.rint(flat * self.UNIT).astype(np.int64)

    @classmethod
    def of(cls, start: Learned, sums: np.ndarray) -> Learned:
        """The groups together: weights averaged by bits; a gate that none saw keeps the start's."""
        out = cls(start)
        places = np.cumsum([start.weights.size, start.bits.size, start.hits.size])
        weighted, bits, hits, mass = np.split(sums / cls.UNIT, places)
        out.bits, out.hits, out.mass = bits.reshape(out.bits.shape), hits.reshape(out.hits.shape), mass.reshape(out.mass.shape)
        seen = out.bits > 0
        out.weights[seen] = weighted.reshape(out.weights.shape)[seen] / out.bits[seen][:, None]
        return out

    def map(self) -> np.ndarray:
        """The adaptive map: what a mixed logit turned out to be, halfway from the logit itself."""
        own = np.tile(np.linspace(-12, 12, MAP), (2, GATES, 1))
        p = np.clip((self.hits + 20 / (1 + np.exp(-own))) / (self.mass + 20), 1e-6, 1 - 1e-6)
        return 0.5 * (own + np.log(p / (1 - p)))


def started(setting: Setting, counts: list[np.ndarray], sample: pa.Array) -> Learned:
    """What the sample teaches; the map learns once the weights have settled."""
    out = Learned()
    if len(sample):
        bits, known = Bits(setting, *tokens(sample)), Before(counts)
        for tree in range(2):
            out.learn(tree, bits, known, len(bits.leaf) // 3)
    return out


def _taught(shared):
    """What a group of training documents teaches on top of the start, as rows (place, amount)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            setting, known, start = shared.value
            own = own or Learned(start)
            rows = np.cumsum([0, *(part.num_rows for part in common.slices(iter([batch])))]).tolist()
            for a in range(0, len(rows) - 1, 2):
                # words are looked up once for two slices
                ends = rows[a : a + 3]
                whole = Bits(setting, *tokens(batch.column("text").slice(ends[0], ends[-1] - ends[0])))
                for low, high in zip(ends[:-1], ends[1:], strict=True):
                    bits = whole.cut(slice(low - ends[0], high - ends[0]))
                    for tree in range(2):
                        own.learn(tree, bits, known)
        if own is not None:
            sums = own.sums()
            used = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(sums[used], pa.int64())], names=["place", "amount"])

    return run


def learned(train: DataFrame, setting: Setting, counts: list[np.ndarray], start: Learned) -> Learned:
    """What all training documents (columns doc_id, text) teach from the start on, in groups."""
    spark = train.sparkSession
    chosen = train.select("text", F.xxhash64("doc_id", "text").alias("h")).where(F.pmod("h", F.lit(SHARE)) == 0)
    groups = max(1, chosen.count() // GROUP)
    known = common.shared(spark, (setting, Before(counts), start))
    rows = chosen.repartition(groups, "h").sortWithinPartitions("h", "text").select("text").mapInArrow(_taught(known), "place int, amount long")
    total = np.zeros_like(start.sums())
    added = rows.groupBy("place").agg(F.sum("amount").alias("amount")).toArrow()  # as many rows as the model has numbers
    total[added["place"].to_numpy()] += added["amount"].to_numpy()
    known.destroy()
    return Learned.of(start, total)


class Mixer:
    """Tables as logits with levels; weights by gate and the adaptive map of either tree."""

    def __init__(self, setting: Setting, counts: list[np.ndarray], lessons: Learned):
        self.setting = setting
        self.weights, self.map = lessons.weights, lessons.map()
        self.tables = Tables()
        for table in counts:
            zero, one = table[::2].astype(np.float64), table[1::2].astype(np.float64)
            logit = np.rint(_logit(zero, one) * 12).astype(np.int16) + 128
            self.tables.append((_seen(zero + one).astype(np.uint16) << np.uint16(8)) | logit.astype(np.uint16))
        self.kept = [(np.zeros(0, np.int64), np.zeros(0)) for _ in range(2)]
        self._settle()

    def cost(self, words: pa.Array, number: np.ndarray, per_text: np.ndarray, leaf: np.ndarray | None = None) -> np.ndarray:
        """Natural-log cost of every text, its end included."""
        bits = Bits(self.setting, words, number, per_text, leaf)
        # tokens that all tables see alike cost the same
        each = self._alike(0, bits.keys(), lambda x: self.setting.tree_bits(*Bits.parts(x)))
        rare = bits.rare(slice(0, None))
        for a in range(0, len(rare), 16 * _TOKENS):
            some = rare[a : a + 16 * _TOKENS]
            owner, key = bits.symbols(bits.number[some], bits.topic[some])
            each[some] += np.bincount(owner, weights=self._alike(1, key, self.setting.byte_bits), minlength=len(some))
        return np.bincount(np.repeat(np.arange(len(bits.per_text)), bits.per_text), weights=each, minlength=len(per_text))

    def _alike(self, tree: int, key: np.ndarray, bits) -> np.ndarray:
        """Costs of all keys: each different one is made once, and the first of them are kept."""
        key, of, times = np.unique(key, return_inverse=True, return_counts=True)
        known, cost = self.kept[tree]
        place = np.searchsorted(known, key)
        found = known.take(place, mode="clip") == key if len(known) else np.zeros(len(key), bool)
        out = cost.take(place, mode="clip") if len(known) else np.zeros(len(key))
        new = np.flatnonzero(~found)
        out[new] = self._costs(tree, key[new], bits)
        again = (new if len(known) < KEPT // 2 else new[times[new] > 1])[: max(0, KEPT - len(known))]
        if len(again):
            known, cost = np.concatenate([known, key[again]]), np.concatenate([cost, out[again]])
            order = np.argsort(known, kind="stable")
            self.kept[tree] = known[order], cost[order]
        return out[of]

    def _costs(self, tree: int, key: np.ndarray, bits) -> np.ndarray:
        out = np.zeros(len(key))
        for a in range(0, len(key), step := (1 + 3 * tree) * _TOKENS):
            own = key[a : a + step]
            at, bit, slots = bits(own)
            out[a : a + len(own)] = np.bincount(at, weights=self._nats(tree, bit, slots), minlength=len(own))
        return out

    def _settle(self) -> None:
        """What a bit costs, as look-ups: each predictor's share of the logit by gate and level, and
        the mapped cost of either bit by gate and place of the logit."""
        self.shares, self.costs = [], []
        z = (np.arange(PLACES) + 0.5) * (24 / PLACES) - 12
        for tree in range(2):
            shares = self.weights[tree][:, 1:].T[:, :, None] * _LOGITS
            shares[0] += self.weights[tree][:, :1]
            self.shares.append(shares.reshape(4, -1).astype(np.float32))
            low, share = _place(z)
            mapped = self.map[tree][:, low] * (1 - share) + self.map[tree][:, low + 1] * share
            self.costs.append(np.logaddexp(0, np.stack([mapped, -mapped], 2)).ravel().astype(np.float32))

    def _nats(self, tree: int, bit: np.ndarray, slots: list[np.ndarray]) -> np.ndarray:
        value = [table.take(slot) for table, slot in zip(self.tables[4 * tree : 4 * tree + 4], slots, strict=True)]
        row = ((value[3] >> np.uint16(8) << np.uint16(2)) + (value[2] >> np.uint16(8))) << np.uint16(8)
        z = None
        for share, v in zip(self.shares[tree], value, strict=True):
            v &= np.uint16(255)
            v |= row
            part = share.take(v)
            z = part if z is None else np.add(z, part, out=z)
        z += 12
        z *= PLACES / 24
        np.clip(z, 0, PLACES - 1, out=z)
        at = z.astype(np.int32)
        at += row.astype(np.int32) * (PLACES // 256)
        at <<= 1
        at += bit
        return self.costs[tree].take(at)


_LOGITS = ((np.arange(256) - 128) / 12).astype(np.float32)


def _place(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = (z + 12) * np.float32((MAP - 1) / 24)
    low = np.minimum(x.astype(np.int64), MAP - 2)
    x -= low
    return low, x.astype(z.dtype, copy=False)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in common.slices(batches, limit=4 * common.SLICE_BYTES):
        words, number, _ = tokens(part.column("text"))
        times = np.bincount(number, minlength=len(words))
        used = np.flatnonzero(times)
        yield pa.RecordBatch.from_arrays([words.take(pa.array(used)).cast(pa.string()), pa.array(times[used], pa.int64())], names=["word", "times"])


def _symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of counted words, a blank after each."""
    total = np.zeros(256, np.int64)
    for batch in batches:
        data, offsets = _raw(batch.column("word"))
        times = batch.column("times").to_numpy()
        total += np.bincount(data, weights=np.repeat(times, np.diff(offsets)), minlength=256).astype(np.int64)
        total[_BLANK] += times.sum()
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(256), pa.int32()), pa.array(total)], names=["symbol", "times"])


def _scored(model, frequent, total: tuple[int, int, int]):
    ends, all_, distinct = total
    floor = np.log10(all_ + 0.5 * (distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer: Mixer = model.value
        known_words, known_times = frequent.value
        for part in common.slices(batches, limit=4 * common.SLICE_BYTES):
            texts = part.column("text")
            words, number, per_text = tokens(texts)
            place = pc.index_in(words, value_set=known_words.cast(words.type)).fill_null(-1).to_numpy()
            # leaves are the first of the frequent words
            leaf = np.where((place >= 0) & (place < len(mixer.setting.words)), place, len(mixer.setting.words)).astype(np.int64)
            times = np.where(place >= 0, known_times[place], 0) if len(known_times) else np.zeros(len(words), np.int64)
            text = np.repeat(np.arange(len(per_text)), per_text)
            common_ = times[number] > 0
            gain = np.log10(times + 0.5)
            base = np.bincount(text, weights=np.where(common_, gain[number], 0.0), minlength=len(per_text))
            base += np.log10(ends + 0.5) - (per_text + 1) * floor
            n_known = np.bincount(text[common_], minlength=len(per_text)) + (ends > 0)
            pair = text[~common_].astype(np.int64) * max(1, len(words)) + number[~common_]
            pair, often = np.unique(pair, return_counts=True)
            at = np.searchsorted(pair // max(1, len(words)), np.arange(len(per_text) + 1))
            rare = pa.ListArray.from_arrays(
                pa.array(at, pa.int32()),
                pa.StructArray.from_arrays([words.take(pa.array(pair % max(1, len(words)))).cast(pa.string()), pa.array(often, pa.int64())], names=["word", "times"]),
            )
            size = pc.binary_length(texts).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("row"), pa.array(per_text + 1, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base), pa.array(-mixer.cost(words, number, per_text, leaf) / np.log(10)), pa.array(size, pa.int64()), rare],
                names=["doc_id", "row", "n_tokens", "n_known", "base_score", "score", "n_bytes", "rare"],
            )

    return run


def scores(docs: DataFrame, parts: int = 5, held: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte, one row
    per row; the model learns from the documents outside the held-out fold.

    NULL and empty texts are one token, the end (bits_per_byte NULL). Repeated rows count and score
    each; a NULL doc_id counts as the text ``null`` for its fold; other columns are ignored. Without
    training text every bit costs one bit and the base score is 0.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    held_out = common.fold(F.col("doc_id"), parts) == held
    texts = common.body(docs)
    train = texts.where(~held_out)

    counts = common.saved(train.select("text").mapInArrow(_counted, "word string, times long").groupBy("word").agg(F.sum("times").alias("times")), "words")
    words, distinct = counts.agg(F.coalesce(F.sum("times"), F.lit(0)), F.count(F.lit(1))).head()
    ends = train.count()
    total = ends, words + ends, distinct + (ends > 0)
    # the least count that no more than FREQUENT words reach: no task has to rank all words
    how_many = counts.groupBy("times").agg(F.count(F.lit(1)).alias("words")).toArrow().sort_by([("times", "descending")])
    fits = np.flatnonzero(np.cumsum(how_many["words"].to_numpy()) <= FREQUENT)
    least = how_many["times"][int(fits[-1])].as_py() if len(fits) else 1 << 62
    top = counts.where(F.col("times") >= least).toArrow().sort_by([("times", "descending"), ("word", "ascending")])
    frequent = pa.array(top["word"].to_pylist(), pa.string()), top["times"].to_numpy()
    # where every word fits, none is rare
    whole = distinct <= FREQUENT

    picked = train.where(F.char_length("text") <= SAMPLE_CHARS).select("doc_id", F.xxhash64("doc_id").alias("h"), "text").orderBy("h", "doc_id", "text").limit(SAMPLE).collect()
    sample = pa.array([r["text"] for r in picked], pa.large_string())
    leaves = frequent[1][:LEAVES][frequent[1][:LEAVES] >= LEAST]
    found = counts.mapInArrow(_symbols, "symbol int, times long").groupBy("symbol").agg(F.sum("times").alias("times")).toArrow()  # 256 rows
    symbols = np.zeros(256, np.int64)
    symbols[found["symbol"].to_numpy()] = found["times"].to_numpy()
    setting = Setting(frequent[0].slice(0, len(leaves)), leaves, words - int(leaves.sum()), ends, sample, symbols)
    fit_topics(train, setting)
    gathered = train.select("text").mapInArrow(_gather(common.shared(spark, setting)), "table int, block int, counts binary")
    added = gathered.repartition("table", "block").sortWithinPartitions("table", "block").mapInArrow(_added, "table int, block int, counts binary")
    # sums are exact; what a model sees of them has the seven digits of a 32-bit float
    tables = [np.zeros(2 << size, np.float32) for _, size in TABLES]
    for r in common.saved(added, "tables").toLocalIterator():  # as many blocks as the tables have
        tables[r["table"]][2 * BLOCK * r["block"] : 2 * BLOCK * (r["block"] + 1)] = _opened(bytes(r["counts"]))
    model = common.shared(spark, Mixer(setting, tables, learned(train, setting, tables, started(setting, tables, sample))))

    run = _scored(model, common.shared(spark, frequent), total)
    rows = texts.withColumn("row", F.monotonically_increasing_id())
    out = rows.mapInArrow(run, f"doc_id {kind}, row long, n_tokens long, n_known long, base_score double, score double, n_bytes long, rare array<struct<word:string,times:long>>")
    out = common.saved(out, "scored")
    if whole:
        # words that no training text has
        gain = F.aggregate("rare", F.lit(0.0), lambda a, x: a + x["times"]) * F.log10(F.lit(0.5))
        found = out.select("*", gain.alias("more"), F.lit(0).cast("long").alias("more_known"))
    else:
        each = out.select("row", F.explode("rare").alias("r")).select("row", F.col("r.word").alias("word"), F.col("r.times").alias("often"))
        joined = each.join(counts.select("word", F.col("times").alias("c")), "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
        sums = joined.groupBy("row").agg(F.sum(F.col("often") * F.log10(F.col("c") + 0.5)).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("often")).otherwise(0)).alias("more_known"))
        found = out.join(sums, "row", "left")
    bits = F.when(F.col("n_bytes") > 0, -F.col("score") / F.lit(float(np.log10(2))) / F.col("n_bytes"))
    return found.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(words + ends).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        "score",
        bits.alias("bits_per_byte"),
    )
