"""Document fingerprints as invertible Bloom lookup sketches of hashed paragraphs.

A paragraph is a sentence or line, blocks of at most ``BLOCK`` characters of longer ones; its digest
also counts how often the text has had it before, so that digests of a text are distinct. A sketch
adds every digest to one cell in each of three tables: a count, the XOR of the digests and the XOR of
their check hashes. Cells of two sketches subtract; what both hold vanishes, and peeling cells that
hold one digest recovers the digests that differ.

A fingerprint stores sketches of growing size, each with its own salt, up to the first from which the
text's own digests can be peeled. Two fingerprints are compared by themselves, whatever their texts:
the smallest sketches are subtracted and peeled, larger ones after a failure, and where no size that
both have is large enough, the digests of either are peeled from its largest sketch.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm import common

BLOCK = 96
#: Cells of each of the three tables of a fingerprint's smallest sketch, and how sketches grow.
CELLS, GROWTH = 16, 4
#: Digests a cell of a table for which peeling a sketch by itself is tried.
LOAD = 2.4
#: Documents of a range at least; a range holds the root of all documents if that is more.
RANGE = 4000
_UNITS = re.compile(rf"[^\n.!?]{{1,{BLOCK}}}[\n.!?]*|[\n.!?]+")
_CHECK = np.uint64(0xA24BAED4963EE407)
_SALT = np.uint64(0x9FB21C651E98DF25)
_CELL = np.dtype([("count", "<i4"), ("key", "<u8"), ("check", "<u4")])


def digests(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct paragraph digests of every text, and n+1 offsets."""
    hash_, each = xxhash.xxh3_64_intdigest, []
    for text in texts:
        each.append([hash_(u) for u in _UNITS.findall(text)])
    count = np.array([len(x) for x in each], np.int64)
    flat = np.array([h for x in each for h in x], np.uint64)
    doc = np.repeat(np.arange(len(texts)), count)
    order = np.lexsort((flat, doc))
    value, at = flat[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (at[1:] != at[:-1])
    first = np.flatnonzero(new)
    nth = np.arange(len(value)) - np.repeat(first, np.diff(np.append(first, len(value))))
    return common.mix(value + nth.astype(np.uint64) * _SALT), np.concatenate([[0], np.cumsum(count)])


def _check(key: np.ndarray) -> np.ndarray:
    return common.mix(key + _CHECK) & np.uint64(0xFFFFFFFF)


def _cells(key: np.ndarray, sketch: np.ndarray, size: np.ndarray, base: np.ndarray, salt: int) -> np.ndarray:
    """(3, key) cell numbers: sketch s has 3 * size[s] cells from base[s]."""
    h = common.mix(key ^ common.mix(np.array([salt], np.uint64)))
    out = np.empty((3, len(key)), np.int64)
    for k in range(3):
        out[k] = base[sketch] + k * size[sketch] + ((h >> np.uint64(20 * k)) % size[sketch].astype(np.uint64)).astype(np.int64)
    return out


def build(key: np.ndarray, sketch: np.ndarray, sign: np.ndarray, size: np.ndarray, salt: int = 0):
    """(counts, keys, checks) of sketches laid out in a row, and their first cells."""
    base = np.cumsum(3 * size) - 3 * size
    total = int(3 * size.sum())
    count, keys, checks = np.zeros(total, np.int64), np.zeros(total, np.uint64), np.zeros(total, np.uint64)
    check = _check(key)
    for cell in _cells(key, sketch, size, base, salt):
        np.add.at(count, cell, sign)
        np.bitwise_xor.at(keys, cell, key)
        np.bitwise_xor.at(checks, cell, check)
    return count, keys, checks, base


def peel(count, keys, checks, base, size, salt: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sketch, digest, sign) of what every sketch holds, and whether each was emptied."""
    owner = np.repeat(np.arange(len(size)), 3 * size)
    found = []
    cells = np.flatnonzero(np.abs(count) == 1)
    while len(cells):
        pure = cells[(np.abs(count[cells]) == 1) & (_check(keys[cells]) == checks[cells])]
        if not len(pure):
            break
        sketch, key, sign = owner[pure], keys[pure], count[pure]
        order = np.lexsort((key, sketch))
        sketch, key, sign = sketch[order], key[order], sign[order]
        once = np.ones(len(key), bool)
        once[1:] = (key[1:] != key[:-1]) | (sketch[1:] != sketch[:-1])
        sketch, key, sign = sketch[once], key[once], sign[once]
        found.append((sketch, key, sign))
        check, touched = _check(key), _cells(key, sketch, size, base, salt)
        for cell in touched:
            np.add.at(count, cell, -sign)
            np.bitwise_xor.at(keys, cell, key)
            np.bitwise_xor.at(checks, cell, check)
        cells = np.unique(touched)
    left = np.add.reduceat((count != 0) | (keys != 0) | (checks != 0), base) if len(size) else np.zeros(0, int)
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return *(np.concatenate([f[i] for f in found] or [none[i]]) for i in range(3)), left == 0


def _first(level: int) -> int:
    """Cells of all sketches below a level."""
    return 3 * CELLS * (GROWTH**level - 1) // (GROWTH - 1)


def written(key: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Stored fingerprints: the number of digests, then the cells of every level in base 64."""
    n = np.diff(offsets)
    out, open_, level = [[] for _ in n], np.arange(len(n)), 0
    while len(open_):
        own, at = _picked(key, offsets, open_)
        size = np.full(len(open_), CELLS * GROWTH**level)
        count, keys, checks, base = build(own, np.repeat(np.arange(len(open_)), np.diff(at)), np.ones(len(own), np.int64), size, level)
        cells = np.empty(len(count), _CELL)
        cells["count"], cells["key"], cells["check"] = count, keys, checks
        for i, row in zip(open_.tolist(), cells.reshape(len(open_), -1), strict=True):
            out[i].append(row.tobytes())
        done = n[open_] <= LOAD * size
        *_, empty = peel(count, keys, checks, base, size, level)
        open_, level = open_[~(done & empty)], level + 1
    return [f"{size:x}:{base64.b64encode(b''.join(x)).decode()}" for size, x in zip(n.tolist(), out, strict=True)]


def stored(prints: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(number of digests, number of levels, cells) of every stored fingerprint."""
    parts = [p.split(":") for p in prints]
    cells = [np.frombuffer(base64.b64decode(x), _CELL) for _, x in parts]
    level = {_first(k): k for k in range(1, 24)}
    return np.array([int(n, 16) for n, _ in parts], np.int64), np.array([level[len(c)] for c in cells], np.int64), cells


def _alone(levels: np.ndarray, cells: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, digest) of everything that fingerprints hold, peeled from their last levels."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    for level in np.unique(levels).tolist():
        own = np.flatnonzero(levels == level)
        rows = np.concatenate([cells[i][_first(level - 1) :] for i in own])
        sketch, key, _, done = _peeled(rows["count"].astype(np.int64), rows["key"].copy(), rows["check"].astype(np.uint64), len(own), level - 1)
        if not done.all():
            raise ValueError("a fingerprint is damaged")
        found.append((own[sketch], key))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _peeled(count, keys, checks, sketches: int, level: int):
    size = np.full(sketches, CELLS * GROWTH**level)
    return peel(count, keys, checks, np.cumsum(3 * size) - 3 * size, size, level)


def differences(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """How many digests the two stored fingerprints of each pair have apart, and how many they hold;
    always complete, from the fingerprints alone."""
    (n_a, level_a, cells_a), (n_b, level_b, cells_b) = stored(a), stored(b)
    out, common_ = np.zeros(len(a), np.int64), np.minimum(level_a, level_b)
    open_, level = np.arange(len(a)), 0
    while (common_[open_] > level).any():
        # no more digests than cells can be told from a sketch
        tried = open_[(common_[open_] > level) & (np.abs(n_a - n_b)[open_] <= 3 * CELLS * GROWTH**level)]
        if len(tried):
            part = slice(_first(level), _first(level + 1))
            x, y = (np.concatenate([cells[i][part] for i in tried]) for cells in (cells_a, cells_b))
            got, _, _, done = _peeled(x["count"].astype(np.int64) - y["count"], x["key"] ^ y["key"], (x["check"] ^ y["check"]).astype(np.uint64), len(tried), level)
            out[tried] = np.bincount(got, minlength=len(tried))
            open_ = np.setdiff1d(open_, tried[done], assume_unique=True)
        level += 1
    if len(open_):
        (doc_a, key_a), (doc_b, key_b) = (_alone(levels[open_], [cells[i] for i in open_]) for levels, cells in ((level_a, cells_a), (level_b, cells_b)))
        doc, key = np.concatenate([doc_a, doc_b]), np.concatenate([key_a, key_b])
        order = np.lexsort((key, doc))
        doc, key = doc[order], key[order]
        both = doc[1:][(doc[1:] == doc[:-1]) & (key[1:] == key[:-1])]
        out[open_] = (n_a + n_b)[open_] - 2 * np.bincount(both, minlength=len(open_))
    return out, n_a + n_b


def likeness(a: list[str], b: list[str]) -> np.ndarray:
    """The share of digests that the two stored fingerprints of each pair have in common; two of
    empty texts are alike."""
    apart, total = differences(a, b)
    return np.where(total == 0, 1.0, 1 - apart / np.maximum(total, 1))


def edited(text: str, other: str) -> str:
    """The last half of the text (rounded down) replaced by as much of the other's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def _in_order(docs: DataFrame, parts: int) -> DataFrame:
    """Documents dealt into ranges of descending doc_id, each followed by the document after it.

    Ids and text hashes are sorted into ranges by themselves; their ends, two rows a range, deal out
    the texts in one pass. The first document of every range is repeated at the end of the range
    before it, and the first of all at the end of the last.
    """
    texts = common.body(docs).withColumn("key", F.xxhash64("text"))
    place = F.struct("doc_id", "key")
    ranged = texts.select("doc_id", "key").repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "key")
    ends = ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.min(place).alias("low"), F.max(place).alias("high")).toArrow()
    ordered = lambda rows: sorted((r["doc_id"] is not None, r["doc_id"], r["key"]) for r in rows)
    shared = common.shared(docs.sparkSession, (ordered(ends["low"].to_pylist()), ordered(ends["high"].to_pylist())))

    @F.arrow_udf("array<int>")
    def buckets(doc_id: pa.Array, key: pa.Array) -> pa.Array:
        lows, highs = shared.value
        out = []
        for row in zip(doc_id.is_valid().to_pylist(), doc_id.to_pylist(), key.to_pylist(), strict=True):
            own = bisect.bisect_right(lows, row) - 1
            out.append([own, (own + 1) % len(lows)] if row == highs[own] else [own])
        return pa.array(out, pa.list_(pa.int32()))

    every = texts.select("doc_id", "text", "key", F.posexplode(buckets("doc_id", "key")).alias("extra", "bucket"))
    return every.repartition("bucket").sortWithinPartitions("bucket", "extra", F.desc_nulls_last("doc_id"), F.desc("key"))


def fingerprints(docs: DataFrame, per_range: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Likeness comes from the fingerprints returned. The next document is that of the next lower
    doc_id (a number, text or date); after the last comes the first. Rows of one doc_id are in the
    order of their texts' hashes, a NULL doc_id comes last; a document that is alone is its own next.
    NULL and empty texts have no paragraph: two of them are alike (1), one and another text are not
    (0). Repeated rows stay; other columns are ignored.
    """
    kind = dict(docs.dtypes)["doc_id"]
    rows_ = docs.count()
    parts = max(1, -(-rows_ // (per_range or max(RANGE, math.isqrt(rows_)))))
    ordered = _in_order(docs, parts).select("doc_id", "text", "bucket", "extra")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last document, whose next is not yet known
        for batch in common.slices(batches):
            rows = list(zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("bucket").to_pylist(), batch.column("extra").to_pylist(), strict=True))
            if held is not None:
                rows.insert(0, held)
            held = rows[-1] if not rows[-1][3] else None
            texts = [r[1] for r in rows]
            # a document and the row after it; rows repeated at the end of a range have no own result
            own = [i for i in range(len(rows) - 1) if not rows[i][3]]
            changed = [edited(texts[i], texts[i + 1]) for i in own]
            prints, prints_e = written(*digests(texts)), written(*digests(changed))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[i][0] for i in own], batch.schema.field("doc_id").type),
                    pa.array([len(texts[i]) for i in own], pa.int64()),
                    pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed], pa.string()),
                    pa.array([prints[i] for i in own], pa.string()),
                    pa.array(prints_e, pa.string()),
                    pa.array(likeness([prints[i] for i in own], prints_e), pa.float64()),
                    pa.array(likeness([prints[i] for i in own], [prints[i + 1] for i in own]), pa.float64()),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    return ordered.mapInArrow(run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _picked(key: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.diff(offsets)[rows] if len(rows) else np.zeros(0, np.int64)
    out = np.concatenate([[0], np.cumsum(size)])
    return key[np.repeat(offsets[:-1][rows] - out[:-1], size) + np.arange(int(size.sum()))] if len(rows) else key[:0], out
