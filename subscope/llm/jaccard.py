"""Jaccard join over word n-grams: a blocked sparse product of the document by n-gram incidence.

The incidence matrix has a row for each distinct set of n-grams, so exact copies are one row. The
columns have one total order, rare columns first. Two rows whose similarity reaches the threshold
``t`` share a column among the first ``n - ceil(t * n) + 1`` of each; the first one they share is
rare or common. Rare columns are multiplied as they are: few rows hold one. A pair whose first
shared column is common shares no rare one, so both rows have almost only common columns, and a row
with more than ``(1 - t) / t * n`` rare ones is in no such pair.

Common columns are multiplied in blocks. Two rows of which the smaller has ``s`` columns differ in
``(1 - t) / t * s`` columns at most. Dealt into more blocks than that, the rows agree in all columns
of some block, so rows are brought together by the hash of their columns in a block, not by a single
column that a third of all rows may hold. The number of blocks follows from a class of sizes; a row
is dealt out for each class that the smaller row of a pair may be in.

Bounds from the two sizes, the places of the shared column and a parity sketch, whose bits differ no
more than the rows do, discard pairs before any row is read again. For the pairs that pass, overlaps
are accumulated over all their columns, a block of pairs at a time, exactly.

Connected rows need no expansion into all pairs: the first product pairs every row of a column with
the column's hub (the row with the fewest rare columns). Rows that this links are contracted. The
second product pairs what is still apart within a column, outside the column's largest component
against all of it, so that no link between components is missed. Near rows share most columns: a pair
is left to an earlier shared column where the columns just before this one in both rows hold one, so
it is met about once and not once a column.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from subscope.llm import common

#: Documents that a column has at least to be common, and slots of the table that says how common a
#: column is: many for each common column, 64 MB at most. A rare column in a common one's slot counts
#: as common, which costs work, never a link.
COMMON, SLOTS_LEAST, SLOTS_MOST = 16, 1 << 20, 1 << 26
#: Sizes grow by this factor from class to class.
CLASS = 1.25
#: Times that a row is dealt out anew where too many of its blocks are empty.
SEEDS = 8
#: Bits of the filter that says which rows have a candidate.
FILTER_BITS = 1 << 24
#: Numbers of 64 parity bits of a row's sketch.
WORDS = 4
_PARITY = [f"parity_{k}" for k in range(WORDS)]
#: Rows with more n-grams than this have a wide sketch too, of four parity bits for each n-gram at least.
NARROW = 400
#: Rows of which a pair has one that are sent to every task at most.
SENT = 1_000_000
#: N-grams that one block of the counting pass holds.
BLOCK = 1 << 21
#: Columns of a row before each that tell whether a pair has met already.
BEFORE = 4
#: Parts over which a block's rows are spread at least before the hubs of the parts meet, and rows of
#: the table for each further part.
SPREAD, PART_ROWS = 16, 1 << 20

_STEP = np.random.default_rng(7).integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def grams(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of every text, ascending, and the offsets of the texts.

    A text with fewer than ``n`` words has its whole sequence as one; a text without words, none.
    """
    data, offsets = common.buffer(texts)
    starts, ends = common.words(data)
    word = common.word_hashes(data, starts, ends)
    doc = np.searchsorted(offsets, starts, "right") - 1
    count = np.bincount(doc, minlength=len(texts)).astype(np.int64)
    first = np.cumsum(count) - count
    total = np.zeros(len(word), np.uint64)
    rank = np.arange(len(word)) - np.repeat(first, count)
    length = np.minimum(np.repeat(count, count), n)
    for k in range(n):
        term = np.zeros(len(word), np.uint64)
        term[: len(word) - k] = word[k:] * _STEP[k]
        total += np.where(k < length, term, np.uint64(0))
    total = common.mix(total + length.astype(np.uint64))
    keep = rank < np.repeat(np.maximum(count - n, 0) + (count > 0), count)
    total, doc = total[keep], doc[keep]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        total[a:b].sort()
    new = np.ones(len(total), bool)
    new[1:] = (total[1:] != total[:-1]) | (doc[1:] != doc[:-1])
    return total[new], np.concatenate([[0], np.cumsum(np.bincount(doc[new], minlength=len(texts)))])


def digests(total: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit digest of every set, as a signed number; sets that differ in size never meet."""
    out = np.zeros(len(offsets) - 1, np.uint64)
    size = np.diff(offsets)
    full = size > 0
    if full.any():
        out[full] = np.add.reduceat(common.mix(total ^ np.uint64(0x9E3779B97F4A7C15)), offsets[:-1][full])
    return common.mix(out + size.astype(np.uint64)).view(np.int64)


def parities(total: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """``WORDS`` numbers of 64 parity bits for every set: two sets differ in as many n-grams at least
    as their parities differ in bits."""
    size = np.diff(offsets)
    hashed = common.mix(total + np.uint64(0x632BE59BD9B4E019))
    out = []
    for k in range(WORDS):
        own = (hashed >> np.uint64(6)) % np.uint64(WORDS) == k
        bit = np.where(own, np.uint64(1) << (hashed & np.uint64(63)), np.uint64(0))
        word = np.zeros(len(size), np.uint64)
        full = size > 0
        if full.any():
            word[full] = np.bitwise_xor.reduceat(bit, offsets[:-1][full])
        out.append(word.view(np.int64))
    return out


@lru_cache(8)
def size_classes(permille: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(least size, blocks, empty blocks that are expected at most) of the classes of sizes, from the
    least size at which two different rows can link."""
    spare = lambda size: (1000 - permille) * size // permille  # noqa: E731 - columns that linked rows differ in
    low = next((k for k in range(1, 1002) if spare(k)), 1 << 62)
    lows, blocks, empty = [], [], []
    while low < 1 << 40:
        high = max(low + 1, int(low * CLASS))
        most, less = spare(high - 1), 0
        for _ in range(50):  # to a fixed point: more blocks, more of them empty
            many = most + 1 + less
            mean = many * math.exp(-(low - spare(low)) / many)
            less = math.ceil(mean + 2 * math.sqrt(mean) + 1)
        lows.append(low)
        blocks.append(most + 1 + less)
        empty.append(less)
        low = high
    return np.array(lows, np.int64), np.array(blocks, np.int64), np.array(empty, np.int64)


def signatures(total: np.ndarray, owner: np.ndarray, size: np.ndarray, permille: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the blocks of the rows' common columns ``total``; ``size`` has all rows' sizes.

    A pair of rows agrees in more blocks than a row has empty ones, unless it has too many: then
    both are dealt out again by another hash, and in the end their empty blocks count too.
    """
    lows, blocks, empty = size_classes(permille)
    # classes that the smaller row of a pair can be in: its size is t n to n
    high = np.searchsorted(lows, size, "right") - 1
    low = np.maximum(np.searchsorted(lows, (size * permille + 999) // 1000, "right") - 1, 0)
    rows = np.unique(owner) if len(owner) else owner
    rows = rows[high[rows] >= 0]
    found, of = [], []
    span = int((high - low)[rows].max(initial=-1)) + 1
    for back in range(span):
        row = rows[high[rows] - back >= low[rows]]
        kind = np.full(len(size), -1)
        kind[row] = high[row] - back
        for seed in range(SEEDS):
            if not len(row):
                break
            mine = np.flatnonzero(kind[owner] >= 0)
            hashed = common.mix(total[mine] + np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64)))
            at = owner[mine]
            many = blocks[kind[at]]
            first = np.zeros(len(size) + 1, np.int64)
            first[row + 1] = blocks[kind[row]]
            first = np.cumsum(first)
            place = first[at] + (hashed % many.astype(np.uint64)).astype(np.int64)
            sums = np.zeros(int(first[-1]), np.uint64)
            np.add.at(sums, place, common.mix(hashed))
            count = np.bincount(place, minlength=len(sums))
            who = np.repeat(np.arange(len(size)), np.diff(first))
            block = np.arange(len(sums)) - first[who]
            name = common.mix(sums + common.mix((block * SEEDS + seed).astype(np.uint64) * np.uint64(4099) + kind[who].astype(np.uint64)))
            bare = np.bincount(who[count == 0], minlength=len(size))
            again = np.zeros(len(size), bool)
            again[row] = bare[row] > empty[kind[row]]
            keep = (count > 0) | (again[who] & (seed == SEEDS - 1))
            found.append(name[keep])
            of.append(who[keep])
            row = row[again[row]]
            kind[~again] = -1
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(of)


def wide(total: np.ndarray) -> bytes:
    """Parity bits of one set, a power of two and four for each n-gram at least."""
    bits = 1 << int(4 * len(total) - 1).bit_length()
    slot = common.mix(total + np.uint64(0x632BE59BD9B4E019)) & np.uint64(bits - 1)
    return np.packbits(np.bincount(slot.astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """Bits that two wide sketches differ in; the longer one is folded to the shorter one's size."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()
        kept = 0

        def counts() -> pa.RecordBatch:
            value, times = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64), return_counts=True)
            value, times = value[times > 1].view(np.int64), times[times > 1]
            none = pa.nulls(len(value), pa.int64())
            return pa.RecordBatch.from_arrays([none] * (4 + WORDS) + [pa.array(value), pa.array(times, pa.int64()), pa.nulls(len(value), pa.binary())], names=names)

        names = ["doc_id", "text_key", "node", "n", *_PARITY, "gram", "times", "wide"]
        for part in common.slices(batches):
            total, offsets = grams(part.column("text"), n)
            node, size = digests(total, offsets), np.diff(offsets)
            none = pa.nulls(len(node), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), part.column("text_key"), pa.array(node), pa.array(size, pa.int64()), *map(pa.array, parities(total, offsets)), none, none,
                 pa.array([wide(total[a:b]) if b - a > NARROW else None for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], pa.binary())], names=names
            )
            for i, key in enumerate(node.tolist()):
                if key not in seen:
                    seen.add(key)
                    held.append(total[offsets[i] : offsets[i + 1]])
                    kept += size[i]
            if kept > BLOCK:
                yield counts()
                held, seen, kept = [], set(), 0
        yield counts()

    return run


def _postings(n: int, permille: int, levels):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        level = levels.value
        for part in common.slices(batches):
            total, offsets = grams(part.column("text"), n)
            node, size = digests(total, offsets), np.diff(offsets)
            fresh = np.zeros(len(node), bool)
            for i, key in enumerate(node.tolist()):
                if size[i] and key not in seen:
                    fresh[i] = True
                    seen.add(key)
            if len(seen) > 500_000:  # only saves repeats
                seen.clear()
            owner = np.repeat(np.arange(len(node)), size)
            slot = (total & np.uint64(len(level) - 1)).astype(np.int64)
            own_level = level[slot]
            order = np.lexsort((total, own_level, owner))
            place = np.arange(len(total)) - np.repeat(offsets[:-1], size)
            prefix = size - (size * permille + 999) // 1000 + 1
            rare = own_level[order] == 0
            take = (place < np.repeat(prefix, size)) & np.repeat(fresh, size) & rare
            gram = total[order][take]
            # rows that can link without a rare column
            lone = np.bincount(owner[own_level == 0], minlength=len(size))
            plain = fresh & (lone <= (1000 - permille) * size // permille)
            inside = plain[owner] & (own_level > 0)
            block, at = signatures(total[inside], owner[inside], size, permille)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([gram, block]).view(np.int64)),
                    pa.array(np.concatenate([node[owner[take]], node[at]])),
                    pa.array(np.concatenate([size[owner[take]], size[at]]), pa.int32()),
                    # a pair of these rows shares no rare column: those are the places before the first shared one
                    pa.array(np.concatenate([place[take], lone[at]]), pa.int32()),
                    pa.array(np.concatenate([np.zeros(int(take.sum()), np.int32), np.ones(len(at), np.int32)])),
                ],
                names=["gram", "node", "n", "place", "level"],
            )

    return run


def _hubs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by column and salt; the first row of each is the hub of the others.

    Copies of a row that several tasks have met are skipped. Columns with a single row vanish. The
    hub's own row comes out too if others follow it or if the column is common (then the hubs of
    its parts meet later).
    """
    carry = None
    names = ("gram", "salt", "node", "n", "place", "level")
    for batch in batches:
        if not batch.num_rows:
            continue
        gram, salt, node, n, place, level = (batch.column(c).to_numpy(zero_copy_only=False) for c in names)
        if carry is not None:
            gram, salt, node, n, place, level = (np.concatenate([[x], y]) for x, y in zip(carry, (gram, salt, node, n, place, level), strict=True))
        start = np.ones(len(gram), bool)
        start[1:] = (gram[1:] != gram[:-1]) | (salt[1:] != salt[:-1])
        hub = np.maximum.accumulate(np.where(start, np.arange(len(gram)), 0))
        member = ~start & (node != node[hub])
        member[1:] &= node[1:] != node[:-1]
        first = np.zeros(len(gram), bool)
        first[hub[member]] = True
        own = np.flatnonzero(start & (first | (level > 0)))
        rest = np.flatnonzero(member)
        at, to = np.concatenate([own, rest]), hub[rest]
        none = pa.nulls(len(own), pa.int64())
        wide = [pa.concat_arrays([none, pa.array(x[to].astype(np.int64))]) for x in (node, n, place)]
        yield pa.RecordBatch.from_arrays([pa.array(x[at].astype(np.int64)) for x in (gram, level, node, n, place)] + wide, schema=_HUBS_SCHEMA)
        # the hub of the last column goes on; a later copy of the last row would link once more
        carry = tuple(x[hub[-1]] for x in (gram, salt, node, n, place, level))


_HUBS_NAMES = ("gram", "level", "node", "n", "place", "hub", "hub_n", "hub_place")
_HUBS_SCHEMA = pa.schema([(name, pa.int64()) for name in _HUBS_NAMES])
_HUBS = ", ".join(f"{name} long" for name in _HUBS_NAMES)


def _reach(n_a, place_a, n_b, place_b, permille: int):
    """Whether two sizes and the places of a shared column leave room for the threshold."""
    # overlap >= t / (1 + t) * (n_a + n_b); it is at most what is left after the places
    left = F.least(n_a - place_a, n_b - place_b).cast("long")
    return (left * (1000 + permille) >= (n_a + n_b) * permille) & (F.least(n_a, n_b) * 1000 >= F.greatest(n_a, n_b) * permille)


def _near(permille: int):
    """Whether the parities of a and b leave room for the threshold: linked rows differ in at most
    (1 - t) / (1 + t) of their n-grams together."""
    apart = reduce(lambda x, y: x + y, (F.bit_count(F.col(f"{p}_a").bitwiseXOR(F.col(f"{p}_b"))) for p in _PARITY))
    return apart.cast("long") * (1000 + permille) <= (F.col("n_a") + F.col("n_b")) * (1000 - permille)


def _once(apart: DataFrame, *names: str) -> DataFrame:
    """Pairs (columns with _a and _b) within a column whose components differ, in either order of the
    rows outside the main component, each where the rows meet first as far as ``before`` tells.

    Rare columns come in the order of all rows' places, so the first one that a pair shares is never
    left out, and that is the one whose places bound a pair. Blocks have one place, so any order does.
    """
    earlier = Window.partitionBy("node", "level").orderBy("place", "gram").rowsBetween(-BEFORE, -1)
    rows = common.saved(apart.withColumn("before", F.collect_list("gram").over(earlier)), "apart")
    a = rows.where("component <> main").select("gram", *(F.col(c).alias(f"{c}_a") for c in ("node", "component", "before", *names)))
    b = rows.select("gram", *(F.col(c).alias(f"{c}_b") for c in ("node", "component", "main", "before", *names)))
    # a pair outside the main component comes from either side: take it once
    cross = a.join(b, "gram").where("component_a <> component_b and (component_b = main_b or node_a < node_b)")
    return cross.where(~F.arrays_overlap("before_a", "before_b"))


def _pair(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _wanted(n: int, bits):
    """The sets of the rows that have a candidate, each once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        mask = bits.value
        for part in common.slices(batches):
            total, offsets = grams(part.column("text"), n)
            node = digests(total, offsets)
            slot = (node.view(np.uint64) & np.uint64(FILTER_BITS - 1)).astype(np.int64)
            want = (mask[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1
            keys, sets = [], []
            for i in np.flatnonzero(want):
                key = int(node[i])
                if key not in seen:
                    seen.add(key)
                    keys.append(key)
                    sets.append(total[offsets[i] : offsets[i + 1]].tobytes())
            if len(seen) > 500_000:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], names=["node", "grams"])

    return run


def _product(permille: int):
    """Overlap counts of a block of pairs, accumulated in one pass over its (pair, column) entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            sets = [np.frombuffer(x, np.uint64) for x in column.to_pylist()]
            size = np.array([len(x) for x in sets], np.int64)
            return np.concatenate(sets), size

        for batch in batches:
            # about as many entries at once whatever the rows' sizes
            size = pc.add(pc.binary_length(batch.column("grams_a")), pc.binary_length(batch.column("grams_b")))
            upto, start = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64)), 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + 2 * BLOCK, "right")))
                part = batch.slice(start, stop - start)
                (x, n_a), (y, n_b) = entries(part.column("grams_a")), entries(part.column("grams_b"))
                pair = np.concatenate([np.repeat(np.arange(len(n)), n) for n in (n_a, n_b)])
                column = np.concatenate([x, y])
                order = np.lexsort((column, pair))
                pair, column = pair[order], column[order]
                overlap = np.bincount(pair[1:][(column[1:] == column[:-1]) & (pair[1:] == pair[:-1])], minlength=len(n_a))
                linked = overlap * 1000 >= (n_a + n_b - overlap) * permille
                a, b = part.column("a").to_numpy(), part.column("b").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(a[linked]), pa.array(b[linked]), pa.array(overlap[linked])], names=["a", "b", "overlap"])
                start = stop

    return run


def _apart(permille: int):
    """Pairs whose wide sketches leave room for the threshold, where both rows have one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            bits = np.array([0 if x is None or y is None else differing(x, y) for x, y in zip(batch.column("wide_a").to_pylist(), batch.column("wide_b").to_pylist(), strict=True)], np.int64)
            near = pa.array(bits * (1000 + permille) <= n * (1000 - permille))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(near) for c in ("a", "b")], names=["a", "b"])

    return run


def _bounded(pairs: DataFrame, sketch: DataFrame, permille: int) -> DataFrame:
    """Pairs whose sizes, parities and wide sketches leave room for the threshold."""
    nodes = common.saved(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "met")
    few = F.broadcast(nodes) if nodes.count() <= SENT else nodes
    own = common.saved(sketch.join(few, "node", "left_semi"), "sketches")
    side = lambda k, *more: own.select(F.col("node").alias(k), *(F.col(c).alias(f"{c}_{k}") for c in ("n", *more)))
    near = pairs.join(side("a", *_PARITY), "a").join(side("b", *_PARITY), "b").where(_near(permille)).select("a", "b")
    both = near.join(side("a", "wide"), "a").join(side("b", "wide"), "b")
    return both.select("a", "b", "n_a", "n_b", "wide_a", "wide_b").mapInArrow(_apart(permille), "a long, b long")


def _verified(docs: DataFrame, pairs: DataFrame, sketch: DataFrame, n: int, permille: int) -> DataFrame:
    """The pairs that reach the threshold, from their whole rows."""
    kept = common.saved(_bounded(pairs, sketch, permille), "bounded")
    if kept.isEmpty():
        return kept.withColumn("overlap", F.lit(0).cast("long"))
    nodes = common.saved(kept.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    sets = common.saved(_sets_of(docs, nodes, n), "grams")
    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("grams_a"))
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("grams_b"))
    joined = kept.join(left, "a").join(right, "b").select("a", "b", "grams_a", "grams_b")
    return common.saved(joined.mapInArrow(_product(permille), "a long, b long, overlap long"), "links")


def _sets_of(docs: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """The sets of ``nodes`` (and of a few others that share a bit with them)."""
    spark = docs.sparkSession
    slot = F.col("node").bitwiseAND(F.lit(FILTER_BITS - 1))
    # a row for each used byte of the filter: at most FILTER_BITS / 8
    byte = nodes.select((slot / 8).cast("int").alias("at"), F.expr(f"shiftleft(1, cast(pmod(node & {FILTER_BITS - 1}, 8) as int))").alias("bit"))
    used = byte.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    mask = np.zeros(FILTER_BITS >> 3, np.uint8)
    mask[used["at"].to_numpy()] = used["bits"].to_numpy()
    found = docs.mapInArrow(_wanted(n, common.shared(spark, mask)), "node long, grams binary")
    return found.join(nodes, "node", "left_semi").groupBy("node").agg(F.first("grams").alias("grams"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b): the smallest node that links reach.

    Every round takes the least label among a node and its neighbours, then the label's own label,
    so that long chains shrink by a power of two. Each round is written to the shared folder.
    """
    both = common.saved(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    label = common.saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(label.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        step = label.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("new"))
        step = common.saved(step, "labels")
        jump = step.select(F.col("node").alias("new"), F.col("new").alias("far"))
        new = common.saved(step.join(jump, "new", "left").select("node", "old", F.coalesce("far", "new").alias("component")), "labels")
        label = new.select("node", "component")
        if new.where("old <> component").isEmpty():
            return label


def classes(docs: DataFrame, n: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_shingles, component_id.

    Two documents link when the Jaccard similarity of their sets of distinct ``n``-word shingles
    reaches ``threshold`` (a multiple of 0.001); words are runs of bytes other than ASCII white
    space, A-Z in lower case. ``component_id`` is the least doc_id that links reach. NULL and empty
    texts have no shingle and link with nothing; a NULL doc_id is a document, but never names a
    component unless nothing else can. Repeated rows are rows of one set. Other columns are ignored.
    """
    permille = round(threshold * 1000)
    spark = docs.sparkSession
    texts = common.body(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    first = common.saved(texts.mapInArrow(_sets(n), f"doc_id long, text_key long, node long, n long, {' long, '.join(_PARITY)} long, gram long, times long, wide binary"), "sets")
    rows_full = first.where("node is not null")
    rows = rows_full.select("doc_id", "text_key", "node", "n")

    heavy = first.where("gram is not null").groupBy("gram").agg(F.sum("times").alias("times")).where(F.col("times") >= COMMON)
    heavy = common.saved(heavy, "common")
    slots = SLOTS_LEAST
    while slots < min(SLOTS_MOST, 64 * heavy.count()):
        slots *= 2
    slot = F.col("gram").bitwiseAND(F.lit(slots - 1)).cast("int").alias("slot")
    used = heavy.groupBy(slot).agg(F.max("times").alias("times")).toArrow()  # a row for each slot at most
    level = np.zeros(slots, np.uint8)
    level[used["slot"].to_numpy()] = np.minimum(np.log2(used["times"].to_numpy()), 60).astype(np.uint8)

    posted = texts.select("text").mapInArrow(_postings(n, permille, common.shared(spark, level)), "gram long, node long, n int, place int, level int")
    spread = max(SPREAD, first.where("node is not null").count() // PART_ROWS)
    salt = F.when(F.col("level") > 0, F.pmod(F.xxhash64("node"), F.lit(spread))).otherwise(F.lit(0)).cast("int")
    ratio = F.col("place") / F.col("n")
    parts = posted.withColumn("salt", salt).repartition("gram", "salt").sortWithinPartitions("gram", "salt", ratio, "n", "node")
    hubs = common.saved(parts.mapInArrow(_hubs, _HUBS), "hubs")

    # the parts of a block: their hubs meet at the best of them
    lone = hubs.where("level > 0 and hub is null")
    best = lone.groupBy("gram").agg(F.min(F.struct(ratio.alias("r"), "n", "node", "place")).alias("h"), F.count("*").alias("parts")).where("parts > 1")
    met = lone.join(best, "gram").where("node <> h.node").select("node", "n", "place", F.col("h.node").alias("hub"), F.col("h.n").alias("hub_n"), F.col("h.place").alias("hub_place"))
    star = hubs.where("hub is not null").select("node", "n", "place", "hub", "hub_n", "hub_place").union(met)
    star = star.where(_reach(F.col("n"), F.col("place"), F.col("hub_n"), F.col("hub_place"), permille))
    pairs = common.saved(star.select(*_pair(F.col("node"), F.col("hub"))).distinct(), "pairs")

    posts = hubs.select("gram", "level", "node", "n", "place")
    # copies of a set have the same sketch: one of them stands for all
    once = Window.partitionBy("node").orderBy("text_key", "doc_id")
    sketch = rows_full.select("node", "n", *_PARITY, "wide", "text_key", "doc_id").withColumn("_k", F.row_number().over(once)).where("_k = 1").select("node", "n", *_PARITY, "wide")
    links = _verified(texts, pairs, sketch, n, permille)

    joined = components(links)
    own = common.saved(posts.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node")).distinct(), "own")
    size = own.groupBy("gram", "component").agg(F.count(F.lit(1)).alias("size"))
    main = size.groupBy("gram").agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    apart = own.join(main.select("gram", "main"), "gram").join(sketch.drop("n", "wide"), "node")
    cross = _once(apart, "n", "place", *_PARITY)
    cross = cross.where(_reach(F.col("n_a"), F.col("place_a"), F.col("n_b"), F.col("place_b"), permille) & _near(permille))
    cross = cross.select(*_pair(F.col("node_a"), F.col("node_b"))).distinct().join(pairs, ["a", "b"], "left_anti")
    more = _verified(texts, common.saved(cross, "pairs"), sketch, n, permille)
    if not more.isEmpty():
        joined = components(links.select("a", "b").union(more.select("a", "b")))

    # copies of one set are one class; the least doc_id names it
    node = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = node.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_node = common.saved(named.join(least, "component").select("node", "component_id"), "classes")
    # few distinct classes hold many copies: the join below reads a row for each class on one side
    full = rows.where("n > 0").join(of_node, "node").select("doc_id", "text_key", F.col("n").alias("n_shingles"), "component_id")
    empty = rows.where("n = 0").select("doc_id", "text_key", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)
