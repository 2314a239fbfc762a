import random

import numpy as np
import pyarrow as pa
import pytest

from subscope.llm import decontam
from tests.llm import cases


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def planted(rng, kinds):
    """Items, and texts with one edited item each."""
    items = [[f"i{k}w{j}" if rng.random() < 0.6 else f"c{rng.randrange(30)}" for j in range(rng.randint(8, 60))] for k in range(30)]
    rows = []
    for d in range(300):
        k = rng.randrange(len(items))
        words = list(items[k])
        for _ in range(rng.randint(0, int(len(words) * kinds))):
            at = rng.randrange(len(words))
            words[at : at + rng.randint(0, 1)] = [f"z{rng.randrange(99)}"] * rng.randint(0, 1)
        if edits(words, items[k]) > int(0.2 * len(items[k])):
            continue
        around = [f"c{rng.randrange(30)}" for _ in range(rng.randint(0, 200))]
        at = rng.randint(0, len(around))
        rows.append((d, k, " ".join(around[:at] + words + around[at:])))
    return items, rows


def test_recall_of_edited_passages_and_exact_distances(spark):
    items, rows = planted(random.Random(1), 0.2)
    docs = spark.createDataFrame([(d, t) for d, _, t in rows], "doc_id long, text string")
    benchmark = spark.createDataFrame([(k, " ".join(w).upper()) for k, w in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontam.leaks(docs, benchmark).collect()}
    assert sum((d, k) in got for d, k, _ in rows) >= 0.97 * len(rows)
    texts = {d: t.split() for d, _, t in rows}
    for (d, k), r in got.items():
        end, least = r["end_word"], r["edit_distance"]
        assert least <= int(0.2 * len(items[k]))
        assert least == min(edits(texts[d][a:end], items[k]) for a in range(max(0, end - len(items[k]) - 15), end + 1))


def test_exact_passages_are_found_whatever_the_signs(spark):
    rows = [(i, f"Something else. {t.replace(' ', ' | ').upper()}!! and more") for i, t in enumerate(["one two three four five six", "seven eight nine ten eleven twelve"])]
    docs = spark.createDataFrame([*rows, (2, "one two three nine ten eleven"), (3, None)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, "One two, three four five six."), (8, "seven eight nine ten eleven twelve"), (9, None), (10, ""), (11, "short one"), (12, "Eight; nine"), (13, "and")], "item_id long, text string")
    found = lambda **how: sorted((r["doc_id"], r["item_id"], r["edit_distance"]) for r in decontam.leaks(docs, benchmark, **how).collect())
    assert found(min_words=5) == [(0, 7, 0), (1, 8, 0)]
    # items too short for an edit are found exactly
    assert found() == [(0, 7, 0), (0, 13, 0), (1, 8, 0), (1, 12, 0), (1, 13, 0)]


def test_blocks_of_items_give_the_same(spark):
    docs, benchmark = spark.read.parquet(f"{cases.TABLES}/documents.parquet"), spark.read.parquet(f"{cases.TABLES}/benchmark.parquet")
    whole = sorted(map(tuple, decontam.leaks(docs, benchmark).collect()))
    assert whole and whole == sorted(map(tuple, decontam.leaks(docs, benchmark, items=7).collect()))


def test_odd_rows(spark):
    docs, none = cases.odd(spark), cases.none(spark)
    benchmark = docs.select(docs["doc_id"].alias("item_id"), "text", "row", "score")
    found = decontam.leaks(docs, benchmark)
    assert {r["doc_id"] for r in found.collect()} >= {0, 1, 2, None}
    assert decontam.leaks(none, benchmark).count() == 0
    assert decontam.leaks(docs, benchmark.where("false")).count() == 0


def test_windows_longer_than_the_text():
    index = decontam.Index([(1, "a b c d e f")], 0.2, 5)
    word, at = decontam.sequences(pa.array(["a b c d e", "", "f"]))
    assert len(word) == 6 and at.tolist() == [0, 5, 5, 6]
    assert len(index.items) == 1
    assert decontam.tables_for(40, 0.2, 0.5) <= decontam.tables_for(40, 0.2, 0.99) <= decontam.WALKS * decontam.TABLES


@pytest.mark.parametrize("kind", ["replaced", "deleted", "inserted"])
def test_recall_of_every_length_at_the_limit(kind):
    rng = np.random.default_rng(77)
    low = {}
    for n in (5, 7, 9, 10, 12, 15, 19, 25, 40, 59, 60, 90, 120, 200, 250, 300, 360, 2000):
        items = []
        for k in range(200 if n < 400 else 40):  # two in five words are common to many items
            items.append((k, np.where(rng.random(n) < 0.6, np.arange(k * n, (k + 1) * n), 10**7 + rng.integers(0, 30, n))))
        known = np.unique(np.concatenate([x for _, x in items]))
        items = [(k, np.searchsorted(known, x)) for k, x in items]
        index = decontam.Index.__new__(decontam.Index)
        index._enter(items, 0.2, decontam.RECALL)
        texts = []
        for _, x in items:
            around = [np.where((w := rng.integers(0, len(known), rng.integers(0, 60))) >= len(known) - 30, w, -1) for _ in range(2)]
            texts.append(np.concatenate([around[0], decontam.edited(x, int(0.2 * n + 1e-9), kind, rng), around[1], [-1]]))
        sizes = np.array([len(t) for t in texts])
        met = {(t, i) for t, _, i in index.candidates(np.concatenate(texts), np.cumsum(sizes) - sizes)}
        low[n] = sum((k, k) in met for k, _ in items) / len(items)
    assert min(low.values()) >= 0.97, low


def test_equals_a_search_of_all_pairs(spark):
    docs, benchmark = spark.read.parquet(f"{cases.TABLES}/documents.parquet"), spark.read.parquet(f"{cases.TABLES}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]): r["edit_distance"] for r in decontam.leaks(docs, benchmark).collect()}
    words = lambda df, key: {r[key]: decontam.sequences(pa.array([r["text"] or ""]))[0] for r in df.collect()}
    want, items = {}, words(benchmark, "item_id")
    for d, text in words(docs, "doc_id").items():
        for i, item in items.items():
            # a near passage has four fifths of the item's words
            if len(np.intersect1d(item, text)) >= 0.5 * len(np.unique(item)):
                least, _ = decontam.best_match(item, text)
                if least <= int(0.2 * len(item) + 1e-9):
                    want[d, i] = least
    assert got == want and len(want) > 3


def test_recall_where_an_items_first_words_are_missing(spark):
    rng = random.Random(3)
    items = [[f"i{k}w{j}" if rng.random() < 0.6 else f"c{rng.randrange(30)}" for j in range(rng.choice((25, 59, 80, 150, 299)))] for k in range(60)]
    rows = []
    for k, words in enumerate(items):
        for share in (0.5, 0.8, 1.0):
            gone = int(share * (len(words) // 5))
            rows.append((len(rows), k, " ".join(words[gone:] + [f"c{rng.randrange(30)}" for _ in range(rng.randint(0, 200))])))
    docs = spark.createDataFrame([(d, t) for d, _, t in rows], "doc_id long, text string")
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(docs, benchmark).collect()}
    assert sum((d, k) in got for d, k, _ in rows) >= 0.97 * len(rows)


def test_recall_of_long_items_whose_first_words_are_other_words(spark):
    rng = random.Random(6)
    items = [[f"i{k}w{j}" if rng.random() < 0.6 else f"c{rng.randrange(30)}" for j in range(rng.choice((400, 700, 1300, 1800)))] for k in range(24)]
    rows = []
    for k, words in enumerate(items):
        gone = len(words) // 5
        rows.append((k, " ".join([f"c{rng.randrange(30)}" for _ in range(50)] + [f"z{rng.randrange(99)}" for _ in range(gone)] + words[gone:])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["edit_distance"] for r in decontam.leaks(docs, benchmark).collect()}
    assert [k for k, _ in rows if (k, k) not in got] == []
    assert all(got[k, k] == len(items[k]) // 5 for k, _ in rows)
