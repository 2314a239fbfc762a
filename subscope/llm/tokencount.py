"""Token counts by a count-only Viterbi search over a unigram vocabulary.

An Aho-Corasick automaton names every vocabulary piece that ends at each place of a text. Dynamic
programming carries, for each place, the best score, its piece count and whether it ends in unknown
text; no path is kept. Ties go as in the tokenizers library: of equal scores into one place the piece
that begins first stays; a character without a piece of its own is unknown at the least score less
ten; neighbouring unknown characters are one token.

A text is a word mark, then the text with blanks as word marks. Where no piece goes on past a word
mark's left side and all scores are whole numbers (so that sums are exact wherever they begin), the
search falls into independent units, one for each word, and equal units are searched once a task.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from subscope.llm import common

MARK = "▁"
PENALTY = 10.0
#: Units whose counts a task remembers; beyond that it begins anew.
REMEMBERED = 500_000

_UNIT = re.compile(f"^[^{MARK}]+|{MARK}+[^{MARK}]*")


class Counter:
    """The search over one vocabulary of (piece, score)."""

    def __init__(self, vocabulary: Sequence[tuple[str, float]], unknown: int):
        self.automaton = ahocorasick.Automaton()
        pieces = {}
        for at, (piece, score) in enumerate(vocabulary):
            if piece:
                pieces[piece] = (len(piece), score, at == unknown)
        for piece, value in pieces.items():
            self.automaton.add_word(piece, value)
        self.automaton.make_automaton()
        self.single = {p for p in pieces if len(p) == 1}
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min((score for _, score in vocabulary), default=0.0) - PENALTY
        scores = [score for _, score in vocabulary] + [self.unknown]
        self.apart = all(float(s).is_integer() for s in scores) and not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces) and MARK in self.single
        self.known: dict[str, tuple[int, float]] = {}

    def search(self, unit: str) -> tuple[int, float]:
        """(pieces, score) of the best segmentation.

        A place is only looked back at from the end of a piece, so a ring of as many places as the
        longest piece has characters is carried along, however long the unit is.
        """
        n = len(unit)
        ring = min(n + 1, self.longest + 2)
        score, count, open_, reached = [0.0] * ring, [0] * ring, [False] * ring, [False] * ring
        done = 0

        def close(until: int) -> None:
            """Places up to ``until`` get their unknown character, if it has no piece of its own."""
            nonlocal done
            while done < until:
                before, at = done % ring, (done + 1) % ring
                done += 1
                if unit[done - 1] not in self.single:
                    value = self.unknown + score[before]
                    if not reached[at] or value > score[at]:
                        score[at], count[at], open_[at] = value, count[before] + (not open_[before]), True
                reached[(done + 1) % ring] = False

        for last, (size, own, is_unknown) in self.automaton.iter(unit):
            if done < last:
                close(last)
            end, start = (last + 1) % ring, (last + 1 - size) % ring
            value = own + score[start]
            if not reached[end] or value > score[end]:
                joins = is_unknown and open_[start]
                score[end], count[end], open_[end] = value, count[start] + (not joins), is_unknown
                reached[end] = True
        close(n)
        return count[n % ring], score[n % ring]

    def units(self, text: str) -> list[str]:
        if not self.apart:
            return [MARK + text.replace(" ", MARK)]
        if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
            return _UNIT.findall(MARK + text.replace(" ", MARK))
        return text.split(" ")  # each stands for a mark and itself

    def count(self, text: str) -> tuple[int, float]:
        """(tokens, score) of a whole text."""
        if not text:
            return 0, 0.0
        units = self.units(text)
        bare = self.apart and not units[0].startswith(MARK)
        tokens, total, known = 0, 0.0, self.known
        for unit in units:
            found = known.get(unit if not bare else MARK + unit)
            if found is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                whole = MARK + unit if bare else unit
                found = self.search(whole)
                if len(whole) <= 64:
                    known[whole] = found
            tokens += found[0]
            total += found[1]
        return tokens, total


@lru_cache(2)
def counter(path: str) -> Counter:
    """The search over a sentencepiece file's pieces and scores."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    return Counter([(model.id_to_piece(i), model.get_score(i)) for i in range(size)], model.unk_id())


def counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and score of every row's whole text.

    NULL and empty texts have no token (score 0). Repeated rows count alike; a NULL doc_id stays;
    other columns are ignored.
    """
    texts = common.body(docs)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [counter(path).count(t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "n_tokens", "score"])

    return common.mapped(texts, work, f"doc_id {dict(texts.dtypes)['doc_id']}, n_tokens long, score double")
