import collections
import hashlib

import numpy as np
import pytest

from subscope.llm import fingerprint as fp
from tests.llm import cases


@pytest.mark.parametrize("seed", range(5))
def test_peeling_recovers_the_differing_digests(seed):
    rng = np.random.default_rng(seed)
    both = rng.integers(0, 1 << 62, 300, dtype=np.uint64)
    a, b = rng.integers(0, 1 << 62, 7, dtype=np.uint64), rng.integers(0, 1 << 62, 5, dtype=np.uint64)
    key = np.concatenate([both, a, both, b])
    sign = np.concatenate([np.ones(307, np.int64), -np.ones(305, np.int64)])
    size = np.array([32])
    _, got, way, done = fp.peel(*fp.build(key, np.zeros(len(key), np.int64), sign, size), size)
    assert done.all() and set(got[way == 1]) == set(a) and set(got[way == -1]) == set(b)


def test_stored_fingerprints_tell_all_differences():
    rng = np.random.default_rng(1)
    sizes = [(0, 0), (3, 0), (30, 30), (36, 36), (40, 40), (900, 1), (5000, 5000), (20_000, 3), (0, 700)]
    a = [rng.integers(0, 1 << 62, n, dtype=np.uint64) for n, _ in sizes]
    b = [np.concatenate([x[: len(x) // 2], rng.integers(0, 1 << 62, n, dtype=np.uint64)]) for x, (_, n) in zip(a, sizes, strict=True)]
    at = lambda xs: np.concatenate([[0], np.cumsum([len(x) for x in xs])])
    expected = [len(set(x) ^ set(y)) for x, y in zip(a, b, strict=True)]
    prints = [fp.written(np.concatenate(xs), at(xs)) for xs in (a, b)]
    apart, total = fp.differences(*prints)
    assert apart.tolist() == expected and total.tolist() == [len(x) + len(y) for x, y in zip(a, b, strict=True)]
    assert fp.differences(prints[0], prints[0])[0].tolist() == [0] * len(sizes)


@pytest.mark.parametrize("seed", range(4))
def test_every_stored_fingerprint_can_be_peeled_by_itself(seed):
    rng = np.random.default_rng(seed)
    sets = [rng.integers(0, 1 << 62, n, dtype=np.uint64) for n in range(400)]
    prints = fp.written(np.concatenate(sets), np.concatenate([[0], np.cumsum(range(400))]))
    _, levels, cells = fp.stored(prints)
    doc, key = fp._alone(levels, cells)
    assert [set(key[doc == i]) for i in range(400)] == [set(x) for x in sets]
    # sketches are larger than needed by a few times at most, but for a few that got stuck
    assert sum(len(c) > 64 + 14 * n for n, c in enumerate(cells)) < 10


def units(text):
    return collections.Counter(fp._UNITS.findall(text))


def brute(rows):
    """Everything but the fingerprints, in plain Python."""
    out = []
    for i, (key, text) in enumerate(rows):
        other = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + other[:half]

        def near(x, y):
            a, b = units(x), units(y)
            total = sum(a.values()) + sum(b.values())
            return 1.0 if not total else round(2 * sum((a & b).values()) / total, 9)

        out.append((repr(key), len(text), hashlib.sha256(changed.encode()).hexdigest(), near(text, changed), near(text, other)))
    return sorted(out)


def checked(docs, rows, per_range):
    got = fp.fingerprints(docs, per_range).collect()
    assert sorted((repr(r["doc_id"]), r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got) == brute(rows)
    return got


@pytest.mark.parametrize("per_range", [10**6, 40, 3])
def test_equals_brute_force(spark, per_range):
    docs = spark.read.parquet(f"{cases.SMALL}/documents.parquet")
    rows = sorted(cases.texts_of(docs), reverse=True)
    got = checked(docs, rows, per_range)
    prints = collections.defaultdict(set)
    for r, (_, text) in zip(sorted(got, key=lambda r: -r["doc_id"]), rows, strict=True):
        prints[text].add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values()) and len(set.union(*prints.values())) == len(prints)


def test_odd_rows(spark):
    docs = cases.odd(spark)
    got = fp.fingerprints(docs, 7).collect()
    assert len(got) == docs.count()
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (101, 102)}) == 1
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert fp.fingerprints(cases.none(spark)).count() == 0
    alone = docs.where("doc_id = 3").limit(1)
    assert [r["near_next"] for r in fp.fingerprints(alone).collect()] == [1.0]


def test_text_keys(spark):
    docs = spark.read.parquet(f"{cases.SMALL}/documents.parquet").selectExpr("concat('d', doc_id) AS doc_id", "text")
    checked(docs, sorted(cases.texts_of(docs), reverse=True), 30)


def test_likeness_follows_from_the_columns(spark):
    got = fp.fingerprints(spark.read.parquet(f"{cases.SMALL}/documents.parquet"), 50).collect()
    again = fp.likeness([r["fingerprint"] for r in got], [r["edited_fingerprint"] for r in got])
    assert again.tolist() == [r["near_edited"] for r in got]
    got.sort(key=lambda r: -r["doc_id"])
    again = fp.likeness([r["fingerprint"] for r in got], [r["fingerprint"] for r in got[1:] + got[:1]])
    assert again.tolist() == [r["near_next"] for r in got]


def test_texts_are_not_hashed_through_expressions_that_grow(spark):
    docs = spark.read.parquet(f"{cases.SMALL}/documents.parquet")
    few, many = (len(fp._in_order(docs, n)._jdf.queryExecution().optimizedPlan().toString()) for n in (2, 100))
    assert abs(few - many) < 100
