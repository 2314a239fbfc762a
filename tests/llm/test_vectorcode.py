import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from subscope.llm import vectorcode


def brute(rows, parts, entries, rounds, scale):
    """(vec_id, code, error, label_error, digest) by plain Lloyd rounds with Python integers."""
    kept = [(i, label, [math.floor(scale * x) for x in v]) for i, label, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    length = max(1, math.ceil(max((len(v) for *_, v in kept), default=0) / parts)) * parts
    width = length // parts
    kept = [(i, label, v + [0] * (length - len(v))) for i, label, v in kept]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    leading = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[cut(v, p) for *_, v in leading] for p in range(parts)]
    given = lambda v, p: min(range(len(books[p])), key=lambda e: (apart(cut(v, p), books[p][e]), e))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            members = {}
            for *_, v in kept:
                members.setdefault(given(v, p), []).append(cut(v, p))
            new.append([[sum(x) // len(members[e]) for x in zip(*members[e], strict=True)] if e in members else books[p][e] for e in range(len(books[p]))])
        books = new
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, total = [], {}
    for i, label, v in kept:
        codes = [given(v, p) for p in range(parts)]
        error = sum(apart(cut(v, p), books[p][c]) for p, c in enumerate(codes))
        total[label] = total.get(label, 0) + error
        out.append((i, label, "".join(f"{c:02x}" for c in codes), error))
    return sorted(((i, c, e, total[label], digest) for i, label, c, e in out), key=repr)


def found(df, *args):
    return sorted((tuple(r) for r in vectorcode.codes(df, *args).collect()), key=repr)


SCHEMA = "vec_id long, label int, embedding array<float>"


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_lloyd(spark, monkeypatch, seed):
    rng = random.Random(seed)
    coarse = lambda: rng.choice([-1.0, -0.5, 0.0, 0.25, 1.0])  # noqa: E731 - many ties
    rows = [(i * 7 % 401, rng.choice([1, 2, None]), [coarse() if seed else rng.gauss(0, 1) for _ in range(12)]) for i in range(400)]
    rows += [(500 + i, 3, rows[0][2]) for i in range(120)]  # copies
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for parts, entries, rounds in ((3, 9, 2), (4, 20, 1), (2, 64, 3)):
        assert found(df, parts, entries, rounds, 16) == brute(rows, parts, entries, rounds, 16)


def test_odd_rows(spark):
    rows = [(1, None, None), (2, 1, [1.0, None]), (3, 1, [float("nan"), 1.0]), (4, 1, [float("inf"), 1.0]), (5, 1, []), (6, None, [1.0]), (6, None, [1.0]), (None, 2, [-0.3, 0.7, 5.0]), (7, 2, [1.0, 2.0, 3.0, 4.0, 5.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    clashing = df.select("*", *(F.lit(0).alias(c) for c in ("vector", "_salt", "_label", "slot", "part", "code", "error", "points", "order")))
    assert found(clashing, 2, 64, 2, 256) == brute(rows, 2, 64, 2, 256)
    assert found(df.where("false")) == []
    assert found(df.where("vec_id < 5")) == []
    assert len(found(df.drop("label"))) == 5


def test_subtrees_are_given_whole_and_nodes_bound_their_points():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (12, 2, 3))
    points = centres[rng.integers(0, 12, 3000)] + rng.integers(-20, 20, (3000, 2, 3))
    forest = vectorcode.Forest(points)
    assert sorted(forest.order) == list(range(6000))
    for node in range(len(forest.first)):
        own = forest.flat[forest.order[forest.first[node] : forest.last[node]]]
        assert np.sqrt(((own - forest.flat[forest.centre[node]]) ** 2).sum(1).max()) <= forest.radius[node] + 1e-9
        assert (own.sum(0) == forest.sums[node]).all()
        kids = range(forest.child[node], forest.child[node] + forest.children[node])
        assert not kids or sum(forest.last[k] - forest.first[k] for k in kids) == len(own)
        assert all(forest.radius[k] <= forest.radius[node] / 2 for k in kids)
    book = np.ascontiguousarray(centres.transpose(1, 0, 2))
    nodes, _, compared, _ = forest.given(book)
    assert len(compared) < 600  # most points are below nodes that were given whole
    count, total = forest.totals(book)
    assert count.sum() == 6000 and (total.sum((0, 1)) == forest.flat.sum(0)).all()
