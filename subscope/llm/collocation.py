"""Phrase collocation mining by Rabin-Karp fingerprints.

Every run of one to four words has a fingerprint that numpy reads off prefix polynomials: one over
the bytes gives a word's hash, one over the word hashes a run's. Scan k counts the runs of k words
and shuffles (fingerprint, times, mark); a mark is a second fingerprint, of other polynomials, and
a pointer to an occurrence. A run is counted if its two shorter parts are frequent, which a bitmap
of bounded size tells without a miss. The last scan writes out the text of frequent fingerprints
only, and only at the occurrence that the least pointer names.

A fingerprint whose second ones differ belongs to several phrases, and so does one whose pointer
led to several texts: all its occurrences are read again and counted by their text.

A NULL text is empty, a NULL language is ``und``. Texts without a word, empty tables, and languages
without a frequent phrase give no rows; repeated rows count as often as they occur.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from subscope.llm import common

#: Words of the longest phrase.
LONGEST = 4
#: Bytes of text that are hashed at once; a longer text is cut between words, with overlap.
SECTION = 1 << 20
#: Fingerprints held by a task before it combines them, and phrases before it hands them on.
HELD, PHRASES = 2_000_000, 200_000
#: Bits of a bitmap for each frequent fingerprint, and of the largest one (16 MB); when that is too
#: full it lets more runs through to the exact counts, and loses none.
BITS_EACH, BITS_MOST = 32, 1 << 27

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
# 0: part of a word, 1: blank between words, 2: end of a piece
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
# odd, so each has an inverse modulo 2^64; the second pair is for the second fingerprint
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03), (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _power_table(base: int):
    """A function of n: the first n powers of ``base`` and of its inverse, modulo 2^64."""
    tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
    steps = (base, pow(base, -1, 1 << 64))

    def upto(n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(tables[0]) < n:
            for k, step in enumerate(steps):
                row = np.full(max(2 * n, 1 << 16), step, np.uint64)
                row[0] = 1
                tables[k] = np.cumprod(row, dtype=np.uint64)
        return tables[0][:n], tables[1][:n]

    return upto


_POWERS = [(_power_table(a), _power_table(b)) for a, b in _BASES]


def _prefix(values: np.ndarray, powers) -> np.ndarray:
    """Prefix polynomial: entry i is the sum of the first i values times their power."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def _between(prefix: np.ndarray, first: np.ndarray, last: np.ndarray, powers) -> np.ndarray:
    """Hash of the values from ``first`` to before ``last``, wherever they stand."""
    return (prefix[last] - prefix[first]) * powers(len(prefix))[1][first]


class Section:
    """Words of some texts: bytes, starts, ends, fingerprints, and where runs of words may go on.

    ``fresh`` is the number of leading words that the section before has counted already.
    """

    def __init__(self, data: np.ndarray, kind: np.ndarray, seeds: np.ndarray, doc: np.ndarray, starts: np.ndarray, ends: np.ndarray, place: np.ndarray, fresh: int, bits: tuple[int, int]):
        self.data, self.starts, self.ends, self.doc, self.fresh = data, starts, ends, doc, fresh
        self.seed, self.place = seeds[doc], place
        self.masks = [np.uint64((1 << b) - 1) for b in bits]
        values = data.astype(np.uint64) + np.uint64(1)
        self.runs = []
        for bytes_, words in _POWERS:
            word = common.mix(_between(_prefix(values, bytes_), starts, ends, bytes_))
            self.runs.append(_prefix(word, words))
        # pieces are numbered by the ends before them; a text's end counts as one
        self.piece = np.cumsum(kind == 2, dtype=np.int64)[starts]

    def at(self, n: int) -> np.ndarray:
        """Places of the words at which a run of ``n`` words begins that is counted here."""
        if len(self.starts) < n:
            return np.zeros(0, np.int64)
        first = np.arange(max(0, self.fresh - n + 1), len(self.starts) - n + 1)
        return first[self.piece[first] == self.piece[first + n - 1]]

    def keys(self, first: np.ndarray, n: int, which: int = 0) -> np.ndarray:
        """Fingerprints of runs of ``n`` words, apart by language and length."""
        raw = _between(self.runs[which], first, first + n, _POWERS[which][1])
        mixed = common.mix(raw + self.seed[first] + np.uint64((n * 0xA24BAED4963EE407) % (1 << 64)))
        return mixed if which else mixed & self.masks[0]

    def marks(self, first: np.ndarray, n: int) -> np.ndarray:
        """32 bits of the second fingerprint, then 32 that tell the occurrence."""
        check = self.keys(first, n, 1) & np.uint64(0xFFFFFFFF00000000)
        return ((check | (common.mix(self.place[first]) >> np.uint64(32))) & self.masks[1]).view(np.int64)

    def hopeful(self, n: int, frequent: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(places, fingerprints) of the runs whose two shorter parts may both be frequent."""
        first = self.at(n)
        if frequent is not None and n > 1:
            for shift in (0, 1):
                first = first[_within(frequent, self.keys(first + shift, n - 1))]
        return first, self.keys(first, n)

    def text(self, first: int, n: int) -> bytes:
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.starts[first : first + n], self.ends[first : first + n], strict=True))


def _within(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether both bits of a fingerprint are set."""
    last = np.uint64(len(bitmap) * 64 - 1)
    found = np.ones(len(keys), bool)
    for shift in (0, 32):
        bit = (keys >> np.uint64(shift)) & last
        found &= (bitmap[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
    return found


def _elected(keys: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """A key for the pair of a fingerprint and an occurrence."""
    return common.mix(keys ^ common.mix(marks.view(np.uint64)))


def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def sections(part: pa.RecordBatch, limit: int, bits: tuple[int, int] = (64, 64)) -> Iterator[tuple[Section, list[str]]]:
    """The texts of a slice in sections of about ``limit`` bytes, with the languages of its rows."""
    texts = part.column("text").cast(pa.large_string())
    joined = pc.binary_join_element_wise(texts, *(pa.scalar(x, pa.large_string()) for x in ("", "\n")))
    offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
    data = np.frombuffer(joined.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    langs = part.column("lang").to_pylist()
    row = part.column("row").to_numpy(zero_copy_only=False).view(np.uint64)
    seeds = np.array([_seed(x) for x in langs], np.uint64)
    start, done, fresh = 0, 0, 0
    while done < len(data):
        stop = min(done + limit, len(data))
        while stop < len(data):  # to the end of the word
            apart = np.flatnonzero(_KIND[data[stop : stop + 65536]])
            if len(apart):
                stop += int(apart[0])
                break
            stop = min(stop + 65536, len(data))
        own = _LOWER[data[start:stop]]
        kind = _KIND[own]
        inside = np.zeros(len(own) + 2, bool)
        inside[1:-1] = kind == 0
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edge[::2], edge[1::2]
        doc = np.searchsorted(offsets, starts + start, "right") - 1
        # a word's place: its row's hash, and its byte in the row's text
        place = row[doc] + (starts + start - offsets[doc]).astype(np.uint64)
        section = Section(own, kind, seeds, doc, starts, ends, place, fresh, bits)
        yield section, langs
        # the next section begins with this one's last words, which a run may go on from
        fresh = min(LONGEST - 1, len(section.starts))
        start, done = start + int(section.starts[-fresh]) if fresh else stop, stop


def _combined(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, times, least mark) of equal keys and second fingerprints that stand together."""
    keys, times, marks = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(keys)
    keys, marks = keys[order], marks[order]
    check = marks >> 32
    edge = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (check[1:] != check[:-1])]))
    return keys[edge], np.add.reduceat(times[order], edge), np.minimum.reduceat(marks, edge)


def _fingerprints(docs: DataFrame, n: int, frequent, limit: int, bits: tuple[int, int]) -> DataFrame:
    """(key, times, mark) of the runs of ``n`` words, combined within tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = frequent.value if frequent else None
        held, count = [], 0

        def out(columns):
            for k in range(0, len(columns[0]), 100_000):
                key, times, mark = (x[k : k + 100_000] for x in columns)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(times), pa.array(mark)], ["key", "times", "mark"])

        for part in common.slices(batches):
            for section, _ in sections(part, limit, bits):
                first, keys = section.hopeful(n, bitmap)
                held.append((keys, np.ones(len(keys), np.int64), section.marks(first, n)))
                count += len(keys)
                if count > HELD:
                    held = [_combined(held)]
                    count = len(held[0][0])
                    if count > HELD // 2:
                        yield from out(held[0])
                        held, count = [], 0
        if count:
            yield from out(_combined(held))

    return docs.mapInArrow(run, "key long, times long, mark long")


def _bitmap(keys: DataFrame, column: str = "key"):
    """Bitmap of the values, broadcast; 16 MB at most (``BITS_MOST``), whatever their number."""
    bits = 1 << 10
    while bits < min(BITS_MOST, BITS_EACH * max(1, keys.count())):
        bits *= 2
    bit = F.explode(F.array(*(F.shiftrightunsigned(column, shift).bitwiseAND(F.lit(bits - 1)) for shift in (0, 32))))
    rows = keys.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("at"))
    # a row for each 64 bits that are not all zero
    rows = rows.agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("set")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    if rows.num_rows:
        out[rows["at"].to_numpy()] = rows["set"].to_numpy().view(np.uint64)
    return common.shared(keys.sparkSession, out)


def _election(marked: DataFrame) -> DataFrame:
    """``_elected`` of each row's key and mark; mixing needs numpy's products modulo 2^64."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, mark = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(_elected(key.view(np.uint64), mark).view(np.int64))], ["key"])

    return marked.select("key", "mark").mapInArrow(run, "key long")


_TEXTS = "lang string, words int, key long, phrase binary, times long"


def _texts(docs: DataFrame, frequent: list, elected, doubtful, limit: int, bits: tuple[int, int]) -> DataFrame:
    """(lang, words, key, phrase, times): the text of frequent fingerprints at the occurrence that
    was elected, once a task and with times NULL; every occurrence of the doubtful ones, counted by
    its text; and, as words = 0, the words of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps, chosen, doubt = [x.value for x in frequent], elected.value, doubtful.value if doubtful else None
        found: Counter = Counter()

        def out():
            rows = [(*name, times or None) for name, times in found.items()]
            found.clear()
            for k in range(0, len(rows), 20_000):
                columns = zip(*rows[k : k + 20_000], strict=True)
                kinds = (pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["lang", "words", "key", "phrase", "times"])

        for part in common.slices(batches):
            for section, langs in sections(part, limit, bits):
                for doc, times in zip(*np.unique(section.doc[section.at(1)], return_counts=True), strict=True):
                    found[langs[doc], 0, 0, b""] += int(times)
                for n in range(1, LONGEST + 1):
                    first, keys = section.hopeful(n, bitmaps[n - 2] if n > 1 else None)
                    known = _within(bitmaps[n - 1], keys)
                    first, keys = first[known], keys[known]
                    one = _within(chosen, _elected(keys, section.marks(first, n)))
                    for at, key in zip(first[one].tolist(), keys[one].view(np.int64).tolist(), strict=True):
                        found[langs[section.doc[at]], n, key, section.text(at, n)] += 0
                    if doubt is not None:
                        again = _within(doubt, keys)
                        for at, key in zip(first[again].tolist(), keys[again].view(np.int64).tolist(), strict=True):
                            found[langs[section.doc[at]], n, key, section.text(at, n)] += 1
                    if len(found) > PHRASES:
                        yield from out()
        yield from out()

    return docs.mapInArrow(run, _TEXTS)


def counts(docs: DataFrame, least: int = 30, limit: int = SECTION, bits: tuple[int, int] = (64, 64)) -> DataFrame:
    """lang, words, phrase, times of every run of one to four words that occurs ``least`` times in
    its language, and, as words = 0, the number of words of each language.

    Fewer ``bits`` of fingerprints and marks cost time, not results (tests make them collide).
    """
    row = F.xxhash64(F.col("doc_id").cast("string"), "text").alias("row")
    docs = common.body(docs, F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")).select("lang", "text", row)
    frequent, tables = [], []
    for n in range(1, LONGEST + 1):
        runs = _fingerprints(docs, n, frequent[-1] if frequent else None, limit, bits)
        agreed = F.shiftright(F.min("mark"), 32) == F.shiftright(F.max("mark"), 32)
        runs = runs.groupBy("key").agg(F.sum("times").alias("times"), F.min("mark").alias("mark"), agreed.alias("agreed"))
        tables.append(common.saved(runs.where(F.col("times") >= least), f"frequent-{n}"))
        frequent.append(_bitmap(tables[-1]))
    runs = tables[0].unionByName(tables[1]).unionByName(tables[2]).unionByName(tables[3])
    elected = _bitmap(_election(runs))
    doubtful = runs.where(~F.col("agreed")).select("key")
    while True:
        several = None if doubtful.isEmpty() else _bitmap(doubtful)
        texts = common.saved(_texts(docs, frequent, elected, several, limit, bits), "texts")
        one = texts.where("words > 0 and times is null").groupBy("key").agg(F.min("lang").alias("lang"), F.min("words").alias("words"), F.min("phrase").alias("phrase"), F.max("phrase").alias("other"))
        more = one.where("phrase <> other").select("key").join(doubtful, "key", "left_anti")
        if more.isEmpty():
            break
        doubtful = common.saved(doubtful.unionByName(more), "doubtful")
    phrase = F.col("phrase").cast("string").alias("phrase")
    plain = runs.select("key", "times").join(one, "key").join(doubtful, "key", "left_anti").select("lang", "words", phrase, "times")
    again = texts.where("words > 0 and times is not null").join(doubtful, "key", "left_semi")
    again = again.groupBy("lang", "words", phrase).agg(F.sum("times").alias("times")).where(F.col("times") >= least)
    total = texts.where("words = 0").groupBy("lang", "words", phrase).agg(F.sum("times").alias("times"))
    return common.saved(plain.unionByName(again).unionByName(total), "phrases")


def phrases(docs: DataFrame, least: int = 30, covered: int = 80, top: int = 2000, **hashing) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase of two to four words that occurs ``a >= least`` times scores
    ``floor(2000000 a / (l + r))`` for the cut into parts of ``l`` and ``r`` occurrences that gives
    the least, ties to the shorter first part. It is left out if a longer phrase that contains it
    occurs at least ``covered`` percent as often. Ranks follow score, then a, both descending, then
    the phrase by its bytes.
    """
    runs = counts(docs, least, **hashing)
    every = runs.where("words > 0").select("lang", "words", "phrase", F.col("times").alias("a"))
    parts = every.select("lang", F.col("phrase").alias("part"), F.col("a").alias("times"))
    long = every.where("words > 1").withColumn("w", F.split("phrase", " "))
    cut = F.explode(F.expr("sequence(1, words - 1)")).alias("k")
    cuts = long.select("lang", "words", "phrase", "a", "w", cut)
    cuts = cuts.select("lang", "words", "phrase", "a", "k", F.expr("concat_ws(' ', slice(w, 1, k))").alias("head"), F.expr("concat_ws(' ', slice(w, k + 1, words - k))").alias("tail"))
    heads = parts.withColumnsRenamed({"part": "head", "times": "l"})
    tails = parts.withColumnsRenamed({"part": "tail", "times": "r"})
    # decimals: a product may pass 64 bits, the quotient does not
    score = F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).withColumn("score", score)
    least_cut = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = scored.groupBy("lang", "words", "phrase", "a").agg(least_cut)
    # every shorter run inside a longer phrase, with the most times of such a phrase
    inner = "flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), i -> concat_ws(' ', slice(w, i, m)))))"
    around = long.where("words > 2").select("lang", F.explode(F.expr(inner)).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    is_covered = F.col("longer").cast("decimal(19,0)") * F.lit(100).cast("decimal(3,0)") >= F.col("a").cast("decimal(19,0)") * F.lit(covered).cast("decimal(3,0)")
    kept = scored.join(around, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~is_covered)
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    total = runs.where("words = 0").select("lang", F.col("times").alias("n"))
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").cast("long").alias("score"))
