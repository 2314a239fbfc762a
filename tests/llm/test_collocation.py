import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from subscope.llm import collocation
from tests.llm import cases


def brute(rows, least, covered=80, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) from counts of all runs of one to four words."""
    every, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate({i: i + 32 for i in range(65, 91)})):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, 5):
                every[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in every.items():
        best = {}
        for w, a in f.items():
            if len(w) > 1 and a >= least:
                best[w] = min((2_000_000 * a // (f[w[:k]] + f[w[k:]]), k) for k in range(1, len(w)))
        gone = set()
        for w in best:
            for i in range(len(w)):
                for j in range(i + 2, len(w) + 1):
                    if j - i < len(w) and 100 * f[w] >= covered * f[w[i:j]]:
                        gone.add(w[i:j])
        ranked = sorted((-s, -f[w], " ".join(w).encode(), w, k) for w, (s, k) in best.items() if w not in gone)
        for rank, (s, a, phrase, w, k) in enumerate(ranked[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, f[w[:k]], f[w[k:]], total[lang], -s))
    return sorted(out)


def found(docs, *args):
    return sorted(tuple(r) for r in collocation.phrases(docs, *args).collect())


def made(seed, count=120):
    rng = random.Random(seed)
    stock = ["New", "york", "city", "a", "the", "of", "é", "ünï", "x-y", "42"]
    fixed = ["new York city hall", "of the", "state of the art", "a a a a a a"]
    rows = []
    for _ in range(count):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(stock) for _ in range(rng.randint(0, 60))]
        text = "".join(p + rng.choice([" ", " ", "  ", "\t", ", ", ".\n", " ; "]) for p in parts)
        rows.append((text, rng.choice(["en", "en", "EN", None])))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed):
    rows = made(seed)
    docs = spark.createDataFrame(rows, "text string, lang string").selectExpr("monotonically_increasing_id() doc_id", "*").repartition(3)
    assert found(docs, 5) == brute(rows, 5)
    assert found(docs, 12, 60, 3) == brute(rows, 12, 60, 3)


def test_long_texts_are_cut_without_loss_or_repeat():
    rows = made(7, 30) + [(" ".join(["word"] * 500 + ["w" * 300] * 9), "de")]
    import pyarrow as pa

    schema = pa.schema([("lang", pa.string()), ("text", pa.string()), ("row", pa.int64())])
    part = pa.RecordBatch.from_pylist([{"text": t, "lang": x or "und", "row": k * 999_983} for k, (t, x) in enumerate(rows)], schema=schema)
    for n in range(1, 5):
        seen = []
        for limit in (1, 17, 200, 1 << 20):
            parts = [(s.hopeful(n, None), s) for s, _ in collocation.sections(part, limit)]
            seen.append(np.sort(np.concatenate([collocation._elected(keys, s.marks(first, n)) for (first, keys), s in parts])))
        assert all(np.array_equal(seen[0], x) for x in seen[1:])


@pytest.mark.parametrize("bits", [(5, 64), (5, 0), (64, 0)])
def test_phrases_that_share_a_fingerprint_are_told_apart(spark, bits):
    rows = made(3, 60)
    docs = spark.createDataFrame(rows, "text string, lang string").selectExpr("monotonically_increasing_id() doc_id", "*").repartition(3)
    assert sorted(tuple(r) for r in collocation.phrases(docs, 5, bits=bits, limit=300).collect()) == brute(rows, 5)


def test_odd_rows(spark):
    docs = cases.odd(spark)
    rows = [(r["text"], r["lang"]) for r in docs.select("text", "lang").collect()]
    assert found(docs, 3) == brute(rows, 3)
    assert collocation.phrases(cases.none(spark)).count() == 0
