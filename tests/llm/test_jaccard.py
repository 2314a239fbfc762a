import random
import re

import numpy as np
import pytest

from subscope.llm import jaccard
from tests.llm import cases


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate({i: i + 32 for i in range(65, 91)}))
    return frozenset([tuple(words)] if 0 < len(words) < n else [tuple(words[i : i + n]) for i in range(len(words) - n + 1)])


def brute(rows, n, permille):
    """(doc_id, size, component) of every row, from all pairs."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and both * 1000 >= permille * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    names = {}
    for i, (key, _) in enumerate(rows):
        if sets[i] and key is not None:
            names[root(i)] = min(names.get(root(i), key), key)
    return sorted((repr(k), len(s), repr(names.get(root(i)) if s else k)) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True)))


def found(docs, n, threshold):
    return sorted((repr(r["doc_id"]), r["n_shingles"], repr(r["component_id"])) for r in jaccard.classes(docs, n, threshold).collect())


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force_on_edited_copies(spark, seed):
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(400)
    shared = [word() for _ in range(40)]
    rows = []
    for _ in range(12):
        base = [word() for _ in range(rng.randint(4, 120))] + shared * rng.randint(0, 1)
        for _ in range(rng.randint(1, 14)):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                at = rng.randrange(len(copy) + 1)
                copy[at : at + rng.randint(0, 1)] = [word()] * rng.randint(0, 1)
            rows.append((len(rows) * 7 % 1009, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for n, permille in ((4, 850), (5, 800), (2, 500)):
        assert found(docs, n, permille / 1000) == brute(rows, n, permille)


def test_template_with_own_fields_and_hub_missing(spark):
    # many copies near the threshold that share a template, and whose base is not there
    rng = random.Random(9)
    base = ["t%d" % i for i in range(100)]
    rows = []
    for i in range(90):
        copy = list(base)
        for k in range(rng.randint(1, 3)):
            copy[rng.randrange(100)] = f"own{i}x{k}"
        rows.append((i, " ".join(copy)))
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), 4, 0.85) == brute(rows, 4, 850)


def test_common_columns_are_spread_and_met(spark, monkeypatch):
    rng = random.Random(2)
    passage = " ".join("p%d" % i for i in range(30))
    rows = [(i, passage + " " + " ".join("q%d" % rng.randrange(10**6) for _ in range(rng.choice([0, 1, 2, 60])))) for i in range(300)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 4, 0.85) == brute(rows, 4, 850)


@pytest.mark.parametrize("permille", [500, 800, 850, 950, 1000])
def test_linked_rows_agree_in_a_block(permille):
    rng = np.random.default_rng(permille)
    missed = 0
    for size in [*range(1, 30), 47, 100, 333, 2000]:
        for _ in range(6):
            base = rng.integers(1, 1 << 62, size, dtype=np.uint64)
            spare = (1000 - permille) * size // permille
            gone = int(rng.integers(0, spare + 1))
            # as different as is allowed: some columns left out, others added
            other = np.concatenate([base[: size - gone], rng.integers(1, 1 << 62, spare - gone if gone < size else 0, dtype=np.uint64)])
            both = len(np.intersect1d(base, other))
            if both * 1000 < (len(base) + len(other) - both) * permille or set(base) == set(other):
                continue
            total = np.concatenate([np.sort(base), np.sort(other)])
            owner = np.repeat([0, 1], [len(base), len(other)])
            name, of = jaccard.signatures(total, owner, np.array([len(base), len(other)]), permille)
            missed += not len(np.intersect1d(name[of == 0], name[of == 1]))
    assert missed == 0


def test_wide_sketches_never_differ_more_than_the_sets():
    rng = np.random.default_rng(3)
    for _ in range(200):
        base = rng.integers(1, 1 << 62, int(rng.integers(2, 3000)), dtype=np.uint64)
        other = np.concatenate([base[rng.random(len(base)) < rng.random()], rng.integers(1, 1 << 62, int(rng.integers(1, 2000)), dtype=np.uint64)])
        apart = len(np.setxor1d(base, other))
        got = jaccard.differing(jaccard.wide(base), jaccard.wide(other))
        assert got <= apart and got == jaccard.differing(jaccard.wide(other), jaccard.wide(base))


def test_pages_of_common_paragraphs_make_few_pairs(spark):
    """Pages of 6 out of 60 paragraphs: no two link, every column is common."""
    rng = random.Random(8)
    paragraphs = [" ".join("p%dw%d" % (k, rng.randrange(10**6)) for _ in range(50)) for k in range(60)]
    pages = lambda count: [(i, " ".join(paragraphs[k] for k in sorted(rng.sample(range(60), 6)))) for i in range(count)]
    made = {}
    saved = jaccard.common.saved
    for count in (500, 2000):
        seen = {}

        def kept(df, purpose, seen=seen):
            out = saved(df, purpose)
            seen[purpose] = seen.get(purpose, 0) + (out.count() if purpose == "pairs" else 0)
            return out

        jaccard.common.saved = kept
        try:
            rows = pages(count) + [(10_000 + i, " ".join(paragraphs[:6]) + f" own{i}") for i in range(20)]
            got = jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string"), 4, 0.85).collect()
        finally:
            jaccard.common.saved = saved
        made[count] = seen["pairs"]
        assert {r["component_id"] for r in got if r["doc_id"] >= 10_000} == {min(r["component_id"] for r in got if r["doc_id"] >= 10_000)}
    # pairs that share half of their paragraphs at least; a product by single columns makes 4,239,170
    assert made[2000] < 2000 * 30, made


def test_odd_rows(spark):
    docs = cases.odd(spark)
    assert found(docs, 4, 0.85) == brute(cases.texts_of(docs), 4, 850)
    assert jaccard.classes(cases.none(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    rows = {r["node"]: r["component"] for r in jaccard.components(edges).collect()}
    assert rows == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_pairs_that_share_many_columns_are_met_about_once(spark):
    """Rows of families share most of 40 columns; the first shared one is never left out."""
    rng = random.Random(6)
    rows, posts = [], {}
    for node in range(60):
        columns = sorted(c for c in range(1000 * (node % 3), 1000 * (node % 3) + 40) if rng.random() < 0.8)
        posts[node] = columns
        rows += [(c, 0, node, place, node if node > 8 else 0, 0) for place, c in enumerate(columns)]
    apart = spark.createDataFrame(rows, "gram long, level int, node long, place int, component long, main long")
    got = jaccard._once(apart, "place").select("gram", "node_a", "node_b").collect()
    pair = lambda a, b: (min(a, b), max(a, b))
    own = lambda k: k if k > 8 else 0
    first = {(min(both), a, b) for a in posts for b in posts if a < b and own(a) != own(b) and (both := set(posts[a]) & set(posts[b]))}
    met = [(r["gram"], *pair(r["node_a"], r["node_b"])) for r in got]
    assert first <= set(met) and {m[1:] for m in met} == {f[1:] for f in first}
    # one pair a shared column would be about 25 times as many
    assert len(met) < 1.2 * len(first), (len(met), len(first))
