"""What the operators share: slices of bounded size, word hashes, folds, written tables.

A text that is NULL counts as the empty text everywhere.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.session import work_dir

#: Bytes of text that one slice holds at most, unless a single text is longer.
SLICE_BYTES = 1 << 20

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SEPARATOR = ~(np.isin(np.arange(256), [*range(48, 58), *range(65, 91), *range(97, 123)]) | (np.arange(256) >= 0x80))
_SPAN = 64
_RANDOM = np.random.default_rng(20240229)
_TABLE = _RANDOM.integers(1, 1 << 63, (_SPAN, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLAT = _TABLE.ravel()
_FAR = _RANDOM.integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)


def body(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id`` and the whole ``text`` (NULL: empty); other columns only if named."""
    return docs.select("doc_id", *extra, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def fold(doc_id: Column, parts: int) -> Column:
    """The remainder of the key's crc32, written as text; a NULL key counts as the text ``null``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null"))) % parts


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """Written to the shared folder and read back, so that a lost executor repeats no lineage."""
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose texts hold at most ``limit`` bytes together."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.asarray(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False), np.int64)
        start, total = 0, np.cumsum(size)
        while start < len(size):
            done = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def mapped(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``work`` over slices of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield work(part)

    return df.mapInArrow(run, schema)


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes in a row, one blank after each text, and the n+1 offsets."""
    parts = texts.cast(pa.large_string())
    joined = pc.binary_join_element_wise(parts.fill_null(""), *(pa.scalar(x, pa.large_string()) for x in ("", " ")))
    offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
    data = np.frombuffer(joined.buffers()[2], np.uint8) if joined.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, separator: np.ndarray = _WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs between separator bytes."""
    return _runs(~separator[data])


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    padded = np.zeros(len(inside) + 2, bool)
    padded[1:-1] = inside
    edge = np.flatnonzero(padded[1:] != padded[:-1])
    return edge[::2], edge[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit tabulation hash of each word with A-Z in lower case."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = (ends - starts).astype(np.int32)
    first = np.cumsum(size, dtype=np.int32) - size
    place = np.arange(int(size.sum()), dtype=np.int32)
    byte = _LOWER[data[place + np.repeat(starts.astype(np.int32) - first, size)]]
    place -= np.repeat(first, size)
    value = _FLAT[((place & np.int32(_SPAN - 1)) << np.int32(8)) + byte]
    if int(size.max()) > _SPAN:
        far = place >= _SPAN
        value[far] = mix(value[far] + _FAR[(place[far] // _SPAN) & 4095] * (place[far] // _SPAN).astype(np.uint64))
    return mix(np.add.reduceat(value, first) + size.astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, text numbers) of the words in lower case; see ``plain_spans``."""
    data, starts, ends, doc = plain_spans(texts)
    return word_hashes(data, starts, ends), doc


def plain_spans(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, text numbers) of the words in lower case: runs of letters and digits.

    Every ASCII byte other than a letter or digit separates, and so do the blanks, signs and quotes
    of U+00A0..U+00BF, U+2000..U+207F and U+3000..U+303F.
    """
    data, offsets = buffer(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")))
    apart = _SEPARATOR[data]
    for lead, low, high, size in ((0xC2, 0xA0, 0xBF, 2), (0xE2, 0x80, 0x81, 3), (0xE3, 0x80, 0x80, 3)):
        at = np.flatnonzero(data[: max(0, len(data) - size)] == lead)
        at = at[(data[at + 1] >= low) & (data[at + 1] <= high)]
        for k in range(size):
            apart[at + k] = True
    starts, ends = _runs(~apart)
    return data, starts, ends, np.searchsorted(offsets, starts, "right") - 1


def shared(spark: SparkSession, value):
    """Broadcast of a value whose size its caller bounds."""
    return spark.sparkContext.broadcast(value)
