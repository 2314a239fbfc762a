"""Byte-level BPE by tree concatenation.

A tokenizer's file gives the vocabulary, the order of merges (the ids) and the special tokens. A
text is cut where its pieces cannot touch each other. A stretch that cannot be cut (a long run of
letters, digits, signs or blanks) is encoded in halves, halves of halves and so on, and joined
upwards: the tokens around a join are encoded again in windows that grow until the window's first
and last token are those the two sides had. Every neighbouring pair is then a pair that the encoder
itself made, and a sequence of such pairs is the encoding of the whole.

Texts above ``PART`` characters are dealt out over tasks in pieces, so that one very long text is
encoded in parallel; the pieces of one text meet again to be joined.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm import common

#: How a byte-level tokenizer of this kind cuts a text (a fixed value of its format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of the longest stretch that is encoded at once.
LEAF = 2048
#: Characters of a text that one task encodes; longer ones are dealt out in pieces.
PART = 1 << 20

_PIECES = regex.compile(PATTERN)


def _alphabet() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes: printable ones stand for themselves, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


@lru_cache(2)
def tokenizer(path: str) -> tuple[tiktoken.Encoding, dict[str, int]]:
    """The encoder of a tokenizer's file, and its special tokens."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte = _alphabet()
    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special), special


def _edge(token: bytes) -> bool:
    """Whether a window may begin at this token: not inside a character."""
    return token[0] & 0xC0 != 0x80


def _merged(data: bytes, enc: tiktoken.Encoding) -> list[int]:
    """The encoding of part of one stretch. It goes past the pattern, whose matcher gives up on long
    runs of blanks and would have nothing to cut here."""
    return enc._encode_single_piece(data)


def join(left: list[int], right: list[int], enc: tiktoken.Encoding) -> list[int]:
    """The encoding of two neighbours of one stretch, from the encodings of both."""
    if not left or not right:
        return left + right
    token = enc.decode_single_token_bytes
    reach = 2
    while True:
        i, j = max(0, len(left) - reach), min(len(right), reach)
        while i and not _edge(token(left[i])):
            i -= 1
        while j < len(right) and not _edge(token(right[j])):
            j += 1
        again = _merged(enc.decode_bytes(left[i:] + right[:j]), enc)
        if (i == 0 or again[0] == left[i]) and (j == len(right) or again[-1] == right[j - 1]):
            return left[:i] + again + right[j:]
        reach *= 2


def tree(leaves: list[list[int]], enc: tiktoken.Encoding) -> list[int]:
    """Neighbours are joined, then neighbours of neighbours, up to the whole stretch."""
    while len(leaves) > 1:
        leaves = [join(leaves[k], leaves[k + 1], enc) if k + 1 < len(leaves) else leaves[k] for k in range(0, len(leaves), 2)]
    return leaves[0] if leaves else []


def halves(text: str, size: int) -> list[str]:
    """The text halved until no part is longer than ``size``."""
    if len(text) <= size:
        return [text]
    return halves(text[: len(text) // 2], size) + halves(text[len(text) // 2 :], size)


def cut(text: str, size: int) -> Iterator[tuple[int, str]]:
    """(stretch, text) pieces in order. Stretch 0: independent of its neighbours; pieces with the
    same other number are parts of one uncut stretch."""
    stretch, start, solid = 0, 0, 0
    for m in _PIECES.finditer(text):
        a, b = m.span()
        if b - a > size:
            stretch += 1
            yield from _settled(text, start, a, solid)
            yield from ((stretch, part) for part in halves(m[0], size))
            start = solid = b
        elif m[0][0].isspace() and a > start and b - start > size and not text[a - 1].isspace():
            # a cut between a visible character and a blank stands whatever follows
            yield 0, text[start:a]
            start = solid = a
        if not m[0][-1].isspace():
            solid = b
    yield from _settled(text, start, len(text), solid)


def _settled(text: str, start: int, end: int, solid: int) -> Iterator[tuple[int, str]]:
    """Up to the last visible character as one piece; blanks after it depend on what follows them."""
    if solid > start:
        yield 0, text[start:solid]
    for m in _PIECES.finditer(text, max(start, solid)):
        if m.start() >= end:
            break
        yield 0, m[0]


def _even(text: str, leaf: int) -> bool:
    """Whether no run of blanks, and none of letters, digits or signs, is longer than ``leaf``."""
    if len(text) <= leaf:
        return True
    sizes = list(map(len, text.split()))
    # blanks beyond one between two words: if a run is too long, there are as many
    blanks = len(text) - sum(sizes) - (len(sizes) - 1)
    # split() also parts words at signs that the pattern counts among the others
    return max(sizes, default=0) <= leaf and blanks < leaf and not any(c in text for c in "\x1c\x1d\x1e\x1f")


def _ordinary(text: str, enc: tiktoken.Encoding, leaf: int) -> list[int]:
    if _even(text, leaf):
        return enc.encode_ordinary(text)
    return concat(((s, _stretch(p, enc, leaf) if s else enc.encode_ordinary(p)) for s, p in cut(text, leaf)), enc)


def _stretch(text: str, enc: tiktoken.Encoding, leaf: int) -> list[int]:
    return tree([_merged(part.encode(), enc) for part in halves(text, leaf)], enc)


def concat(pieces, enc: tiktoken.Encoding) -> list[int]:
    """The pieces' ids in order, those of one stretch joined."""
    out: list[int] = []
    open_stretch, leaves = 0, []
    for stretch, ids in pieces:
        if leaves and stretch != open_stretch:
            out += tree(leaves, enc)
            leaves = []
        if stretch:
            leaves.append(ids)
        else:
            out += ids
        open_stretch = stretch
    return out + tree(leaves, enc)


def _apart(text: str, special: dict[str, int]) -> list[str]:
    """The text between special tokens, with the tokens at odd places."""
    if not any(s in text for s in special):
        return [text]
    return regex.split("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")", text)


def encode_text(text: str, path: str, leaf: int = LEAF) -> list[int]:
    """The ids of one text."""
    enc, special = tokenizer(path)
    out: list[int] = []
    for k, part in enumerate(_apart(text, special)):
        out += [special[part]] if k % 2 else _ordinary(part, enc, leaf)
    return out


def decode_ids(ids, path: str) -> str:
    """The text of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
    return tokenizer(path)[0].decode_bytes(ids).decode("utf-8", "replace")


def _packed(ids: list[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def encode(docs: DataFrame, path: str, leaf: int = LEAF, part: int = PART, decoded: bool = False) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit) of every whole text.

    With ``decoded`` the ids are decoded again by the task that made them, into a further column of
    that name; ``decode`` does the same for ids that are read from anywhere.

    One row per row: repeated rows stay, a NULL text is the empty text (no ids), a NULL doc_id stays
    NULL, other columns are ignored whatever their names.
    """
    texts = common.body(docs)
    short = texts.where(F.char_length("text") <= part)

    def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [encode_text(t, path, leaf) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns(ids)], names=names)

    kind = dict(texts.dtypes)["doc_id"]
    out = f"doc_id {kind}, n_tokens long, ids binary" + (", decoded string" if decoded else "")
    names = ["doc_id", "n_tokens", "ids", *(["decoded"] if decoded else [])]

    def columns(ids: list[list[int]]) -> list[pa.Array]:
        own = [pa.array(map(len, ids), pa.int64()), pa.array(map(_packed, ids), pa.binary())]
        return [*own, pa.array([decode_ids(x, path) for x in ids], pa.string())] if decoded else own

    done = common.mapped(short, whole, out)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special = tokenizer(path)[1]
        for batch in common.slices(batches):
            for key, row, text in zip(batch.column("doc_id"), batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                at = stretch = 0
                for k, section in enumerate(_apart(text, special)):
                    most = 0
                    for s, piece in [(-1, section)] if k % 2 else cut(section, part):
                        most = max(most, s)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([key.as_py()], batch.schema.field("doc_id").type), pa.array([row]), pa.array([at], pa.int64()), pa.array([s + stretch if s > 0 else s], pa.int64()), pa.array([piece])],
                            names=["doc_id", "row", "at", "stretch", "text"],
                        )
                        at += 1
                    stretch += most

    def piece_ids(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc, special = tokenizer(path)
        ids = [
            [special[t]] if s < 0 else _stretch(t, enc, leaf) if s else _ordinary(t, enc, leaf)
            for s, t in zip(batch.column("stretch").to_pylist(), batch.column("text").to_pylist(), strict=True)
        ]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "row", "at", "stretch")), pa.array(map(_packed, ids), pa.binary())], names=["doc_id", "row", "at", "stretch", "ids"])

    def meet(group: pa.Table) -> pa.Table:
        enc, _ = tokenizer(path)
        group = group.sort_by("at")
        ids = concat(((max(0, s), np.frombuffer(b, "<u4").tolist()) for s, b in zip(group["stretch"].to_pylist(), group["ids"].to_pylist(), strict=True)), enc)
        return pa.table([group["doc_id"].slice(0, 1), *columns([ids])], names=names)

    long = texts.where(F.char_length("text") > part).withColumn("row", F.monotonically_increasing_id())
    pieces = long.mapInArrow(deal, f"doc_id {kind}, row long, at long, stretch long, text string").repartition("row", "at")
    found = common.mapped(pieces, piece_ids, f"doc_id {kind}, row long, at long, stretch long, ids binary")
    return done.unionByName(found.groupBy("row").applyInArrow(meet, out))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with the text of its ids as ``decoded``; NULL ids are no ids."""
    kind = dict(encoded.dtypes)["doc_id"]

    def texts(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [decode_ids(np.frombuffer(b or b"", "<u4").tolist(), path) for b in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_tokens", "ids")), pa.array(out, pa.string())], names=["doc_id", "n_tokens", "ids", "decoded"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches, "ids", 4 * common.SLICE_BYTES):
            yield texts(part)

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary, decoded string")
