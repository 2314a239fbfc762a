"""Vector code compression: codebooks of vector parts by Lloyd rounds over cover trees.

Vectors are cut into equal parts, each part position has a codebook. Vectors lie in blocks; a block
has one cover tree per part position, built once and written. A tree node is a ball around one of
its points and knows how many points lie below it and their sum, so a round gives a whole subtree
to an entry when the triangle inequality lets no other entry be as near to any of its points. Only
ambiguous nodes go on to their children, and points of ambiguous leaves are compared exactly.
Everything that reaches a result is integer arithmetic; distances in floating point decide only
whether a node is clear, with a margin, so the result is that of plain Lloyd rounds, ties included.

Components are ``floor(scale x)``. Vectors that are NULL or hold NULL or non-finite components are
dropped. Vectors shorter than the longest, or than the next multiple of the number of parts, are
filled up with zeros. Components are held within +-2^27 at 64 dimensions (the bound keeps squared
distances within 64 bits). Repeated rows count as often as they occur; rows without an id are coded
but start no codebook unless fewer rows with an id are there than entries. With fewer rows than
entries the codebook has as many entries as rows; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm import common

#: Vectors of a block, and points of a tree node that is not split further.
BLOCK, LEAF = 16_384, 12
#: Rows of a label's total, so that a label of most rows is joined by several tasks.
SALT = 32


class Forest:
    """Cover trees of a block, one for each part position, in arrays.

    ``points`` is (rows, parts, width) integers; point ``part * rows + row`` is that part of that
    row. ``order`` lists the points so that those below a node are ``order[first:last]``. Nodes are
    listed level by level, the children of a node are ``child`` up to ``child + children``.
    """

    FIELDS = ("order", "part", "centre", "radius", "first", "last", "child", "children")

    def __init__(self, points: np.ndarray, **fields: np.ndarray):
        self.rows, self.parts, self.width = points.shape
        self.flat = np.ascontiguousarray(points.transpose(1, 0, 2)).reshape(-1, self.width)
        for name, value in (fields or self._grown()).items():
            setattr(self, name, value)
        running = np.zeros((len(self.flat) + 1, self.width), np.int64)
        np.cumsum(self.flat[self.order], axis=0, out=running[1:])
        self.sums = running[self.last] - running[self.first]

    def _grown(self) -> dict[str, np.ndarray]:
        flat, order = self.flat, np.arange(len(self.flat))
        part = np.arange(self.parts)
        first, last = part * self.rows, (part + 1) * self.rows
        centre, levels, base = first, [], 0
        while True:
            count = last - first
            at, node = _ranges(first, count), np.repeat(np.arange(len(first)), count)
            point = order[at]
            apart = _square(flat[point], flat[centre[node]])
            radius = np.sqrt(np.maximum.reduceat(apart, np.cumsum(count) - count).astype(np.float64))
            split = (count > LEAF) & (radius > 0)
            level = {"part": part, "centre": centre, "radius": radius, "first": first, "last": last, "child": np.zeros_like(first), "children": np.zeros_like(first)}
            levels.append(level)
            if not split.any():
                break
            below = split[node]
            at, node, point, apart = at[below], node[below], point[below], apart[below]
            parents, leaders, owner = _covered(flat, node, point, apart, centre, radius / 2)
            by = np.argsort(parents, kind="stable")  # children of a node stand together
            place = np.empty_like(by)
            place[by] = np.arange(len(by))
            owner = place[owner]
            order[at] = point[np.argsort(owner, kind="stable")]
            size = np.bincount(owner, minlength=len(by))
            level["children"] = np.bincount(parents, minlength=len(first))
            base += len(first)
            level["child"] = base + np.cumsum(level["children"]) - level["children"]
            first, part, centre = at[np.cumsum(size) - size], part[parents[by]], leaders[by]
            last = first + size
        return {"order": order} | {k: np.concatenate([x[k] for x in levels]) for k in levels[0]}

    def given(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(nodes, their entries, points, their entries): whole subtrees, and the points of leaves
        that had to be compared. ``book`` is (parts, entries, width)."""
        nodes, picked, points, chosen = [], [], [], []
        active = np.arange(self.parts)
        while len(active):
            part = self.part[active]
            best, near, second = _nearest(self.flat[self.centre[active]], part, book)
            radius = self.radius[active]
            # no other entry can be as near to any point of the ball; floats are off by far less than this
            clear = second - near - 2 * radius > 1e-6 + 1e-9 * (second + radius)
            clear |= np.isinf(second) | (radius == 0)
            nodes.append(active[clear])
            picked.append(best[clear])
            active = active[~clear]
            leaf = active[self.children[active] == 0]
            own = self.order[_ranges(self.first[leaf], self.last[leaf] - self.first[leaf])]
            points.append(own)
            chosen.append(_nearest(self.flat[own], own // self.rows, book)[0])
            inner = active[self.children[active] > 0]
            active = _ranges(self.child[inner], self.children[inner])
        return tuple(np.concatenate(x) for x in (nodes, picked, points, chosen))

    def totals(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts (parts, entries) and sums (parts, entries, width) of what each entry is given."""
        entries = book.shape[1]
        nodes, picked, points, chosen = self.given(book)
        slot = np.concatenate([self.part[nodes] * entries + picked, points // self.rows * entries + chosen])
        times = np.concatenate([self.last[nodes] - self.first[nodes], np.ones(len(points), np.int64)])
        each = np.concatenate([self.sums[nodes], self.flat[points]])
        count = np.zeros(self.parts * entries, np.int64)
        total = np.zeros((self.parts * entries, self.width), np.int64)
        np.add.at(count, slot, times)
        np.add.at(total, slot, each)
        return count.reshape(self.parts, entries), total.reshape(self.parts, entries, self.width)

    def codes(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, parts) entries and the squared distances of the rows' parts added up."""
        nodes, picked, points, chosen = self.given(book)
        code = np.empty(len(self.flat), np.int64)
        size = self.last[nodes] - self.first[nodes]
        code[self.order[_ranges(self.first[nodes], size)]] = np.repeat(picked, size)
        code[points] = chosen
        part = np.arange(len(code)) // self.rows
        error = _square(self.flat, book[part, code])
        return code.reshape(self.parts, self.rows).T, error.reshape(self.parts, self.rows).sum(0)


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each range, one after the other."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def _square(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("...i,...i->...", d, d)


def _covered(flat, node, point, apart, centre, reach) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Balls of radius ``reach[node]`` that cover each node's points, all nodes at a time.

    A node's first ball is around its own centre, each further one around its first point that no
    ball holds. Returns the balls' nodes, their centre points, and the ball of every point.
    """
    owner, open_ = np.full(len(point), -1), np.arange(len(point))
    parents, leaders, made = [], [], 0
    near = np.sqrt(apart.astype(np.float64)) <= reach[node]
    while len(open_):
        parent = node[open_]
        lead = np.concatenate([[True], parent[1:] != parent[:-1]])
        group = np.cumsum(lead) - 1
        leader = centre[parent[lead]] if not made else point[open_[lead]]
        if made:
            near = np.sqrt(_square(flat[point[open_]], flat[leader][group]).astype(np.float64)) <= reach[parent]
        owner[open_[near]] = made + group[near]
        parents.append(parent[lead])
        leaders.append(leader)
        made += len(leader)
        open_ = open_[~near]
    return np.concatenate(parents), np.concatenate(leaders), owner


def _nearest(points: np.ndarray, part: np.ndarray, book: np.ndarray, block: int = 8192) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest entry of each point's codebook (ties: the lower index), its distance, and the
    distance of the nearest entry that differs from it (infinite if there is none)."""
    best, near, second = np.zeros(len(points), np.int64), np.zeros(len(points)), np.full(len(points), np.inf)
    for p in range(len(book)):
        own = np.flatnonzero(part == p)
        # equal entries: the lower index stands for all
        _, kept = np.unique(book[p], axis=0, return_index=True)
        kept.sort()
        entries = book[p][kept]
        for k in range(0, len(own), block):
            at = own[k : k + block]
            square = _square(points[at][:, None, :], entries[None, :, :])
            first = square.argmin(1)
            row = np.arange(len(at))
            best[at] = kept[first]
            near[at] = np.sqrt(square[row, first].astype(np.float64))
            if len(entries) > 1:
                square[row, first] = np.iinfo(np.int64).max
                second[at] = np.sqrt(square.min(1).astype(np.float64))
    return best, near, second


def _whole(vectors: list, scale: int, length: int, parts: int, limit: int) -> np.ndarray:
    """(rows, parts, width) integer components of vectors of at most ``length``."""
    out = np.zeros((len(vectors), length), np.int64)
    for row, x in enumerate(vectors):
        values = np.floor(np.asarray(x, np.float64) * scale)
        out[row, : len(values)] = np.clip(values, -limit, limit).astype(np.int64)
    return out.reshape(len(vectors), parts, length // parts)


def _planted(kept: DataFrame, scale: int, length: int, parts: int, limit: int) -> DataFrame:
    """One row for each block: ids, labels, integer points and the arrays of its trees."""
    kinds = dict(kept.dtypes)
    arrays = ("points", *Forest.FIELDS)
    schema = f"vec_id array<{kinds['vec_id']}>, label array<{kinds['label']}>, " + ", ".join(f"{x} binary" for x in arrays)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def planted(part: pa.Table):
            points = _whole(part["vector"].to_pylist(), scale, length, parts, limit)
            forest = Forest(points)
            lists = [pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part[c].combine_chunks()) for c in ("vec_id", "label")]
            data = [pa.array([x.tobytes()], pa.binary()) for x in (points, *(getattr(forest, f) for f in Forest.FIELDS))]
            return pa.RecordBatch.from_arrays([*lists, *data], ["vec_id", "label", *arrays])

        held, count = [], 0
        for batch in batches:
            while batch.num_rows:
                head = batch.slice(0, BLOCK - count)
                batch = batch.slice(head.num_rows)
                held.append(head)
                count += head.num_rows
                if count == BLOCK:
                    yield planted(pa.Table.from_batches(held))
                    held, count = [], 0
        if count:
            yield planted(pa.Table.from_batches(held))

    return kept.mapInArrow(run, schema)


def _forests(batches: Iterator[pa.RecordBatch], parts: int, width: int) -> Iterator[tuple[Forest, pa.RecordBatch]]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            read = lambda name, kind=np.int64, row=row: np.frombuffer(row.column(name)[0].as_py(), kind)
            fields = {f: read(f, np.float64 if f == "radius" else np.int64) for f in Forest.FIELDS}
            yield Forest(read("points").reshape(-1, parts, width), **fields), row


def codes(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every vector that is kept.

    A codebook starts as its part of the ``entries`` (at most 256) smallest ids' vectors. Each round
    assigns every part to the nearest entry and replaces each entry that got parts by the floor of
    their mean. ``code`` has two hexadecimal digits a part, ``error`` is the sum of the squared
    distances, ``label_error`` that of all vectors of the label (NULLs together).
    """
    spark = vectors.sparkSession
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits: 1 to 256 entries")
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int").alias("label")
    kept = vectors.select("vec_id", label, F.col("embedding").cast("array<double>").alias("vector"))
    plain = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = kept.where(F.col("vector").isNotNull() & plain)
    longest = kept.agg(F.max(F.size("vector"))).first()[0]
    length = max(1, math.ceil((longest or 0) / parts)) * parts
    width = length // parts
    limit = math.isqrt((1 << 60) // length)
    leading = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector", F.col("label").asc_nulls_last()).limit(entries)
    start = _whole([r["vector"] for r in leading.select("vector").collect()], scale, length, parts, limit)
    book = np.ascontiguousarray(start.transpose(1, 0, 2))
    size = max(1, len(start))
    trees = common.saved(_planted(kept, scale, length, parts, limit), "trees")
    for _ in range(rounds if len(start) else 0):
        sent = common.shared(spark, book)

        def sums(batches, sent=sent):
            for forest, _ in _forests(batches, parts, width):
                count, total = forest.totals(sent.value)
                part, entry = np.nonzero(count)
                names = pa.array((part * size + entry).astype(np.int32))
                yield pa.RecordBatch.from_arrays([names, pa.array(count[part, entry]), pa.array(list(total[part, entry]), pa.list_(pa.int64()))], ["slot", "times", "total"])

        rows = trees.mapInArrow(sums, "slot int, times long, total array<long>")
        rows = rows.select("slot", "times", F.posexplode("total").alias("place", "x")).groupBy("slot", "place")
        book = book.copy()
        # as many rows as the codebooks have components
        for r in rows.agg(F.sum("times").alias("times"), F.sum(F.col("x").cast("decimal(20,0)")).alias("x")).collect():
            book[r["slot"] // size, r["slot"] % size, r["place"]] = int(r["x"]) // r["times"]
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    sent = common.shared(spark, book)
    kinds = dict(kept.dtypes)

    def written(batches):
        for forest, row in _forests(batches, parts, width):
            code, error = forest.codes(sent.value)
            text = code.astype(np.uint8).tobytes().hex()
            texts = [text[k : k + 2 * parts] for k in range(0, len(text), 2 * parts)]
            yield pa.RecordBatch.from_arrays([row.column("vec_id").flatten(), row.column("label").flatten(), pa.array(texts, pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])

    out = common.saved(trees.mapInArrow(written, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"), "codes")
    total = out.groupBy("label").agg(F.sum("error").alias("label_error"))
    total = total.select(F.col("label").alias("_label"), "label_error", F.explode(F.expr(f"sequence(0, {SALT - 1})")).alias("_salt"))
    salted = out.withColumn("_salt", F.pmod(F.xxhash64("code", "vec_id"), F.lit(SALT)).cast("int"))
    joined = salted.join(total, salted["label"].eqNullSafe(total["_label"]) & (salted["_salt"] == total["_salt"]))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
