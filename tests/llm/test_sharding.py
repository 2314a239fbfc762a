import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from subscope.llm import sharding
from tests.llm import cases


def fewest(old, capacities):
    """Least bytes that have to move, by trying all sizes of the new shards."""
    total, best = sum(old.values()), None
    spans = [range(low, high + 1) for low, high in capacities.values()]
    for sizes in itertools.product(*spans):
        if sum(sizes) == total:
            stay = sum(min(size, old.get(j, 0)) for j, size in zip(capacities, sizes, strict=True))
            best = total - stay if best is None else min(best, total - stay)
    return best


@pytest.mark.parametrize("seed", range(40))
def test_blocks_move_the_fewest_bytes(seed):
    rng = random.Random(seed)
    old = {i: rng.randint(0, 12) for i in rng.sample(range(6), rng.randint(1, 5))}
    total, n = sum(old.values()), rng.randint(1, 4)
    capacities = {j: (low := max(0, total // n - rng.randint(0, 3)), low + rng.randint(0, 6)) for j in range(n)}
    if not sum(a for a, _ in capacities.values()) <= total <= sum(b for _, b in capacities.values()):
        with pytest.raises(ValueError):
            sharding.blocks(old, capacities)
        return
    got = sharding.blocks(old, capacities)
    for i, size in old.items():
        assert sum(b.size for b in got if b.old == i) == size
    for j, (low, high) in capacities.items():
        assert low <= sum(b.size for b in got if b.new == j) <= high
    assert sum(b.size for b in got if b.old != b.new) == fewest(old, capacities)
    assert len(got) <= 2 * (len(old) + n)


def test_a_row_above_its_share_has_a_shard_by_itself():
    assert sharding.equal(100, 4) == {0: (25, 25), 1: (25, 25), 2: (25, 25), 3: (25, 25)}
    assert sharding.equal(100, 3, 0.0, {0: 10, 1: 60, 2: 30}) == {0: (10, 10), 1: (60, 60), 2: (30, 30)}


def check(docs, layout, shards, near):
    rows = [r.asDict() for r in layout.rows.collect()]
    assert sorted(repr((r["doc_id"], r["text"])) for r in rows) == sorted(repr((r["doc_id"], r["text"])) for r in docs.collect())
    sizes, slots = [0] * shards, [[] for _ in range(shards)]
    for r in rows:
        sizes[r["shard"]] += len((r["text"] or "").encode()) + 16
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert max(sizes) - min(sizes) <= near, sizes
    return sizes


def test_shards_are_near_equal_and_few_bytes_move(spark):
    docs = spark.read.parquet(f"{cases.TABLES}/documents.parquet")
    old = F.crc32(F.col("doc_id").cast("string")) % 32
    layout = sharding.reshard(docs, old, 40)
    sizes = check(docs, layout, 40, 1_000)  # 25 rows each; the median row has 1,526
    before = {}
    for r in docs.collect():
        i = zlib.crc32(str(r["doc_id"]).encode()) % 32
        before[i] = before.get(i, 0) + len((r["text"] or "").encode()) + 16
    mean = sum(sizes) / 40
    must = sum(max(0, before[i] - mean) for i in before)
    assert must <= layout.moved <= must * 1.1 + 40_000  # whole rows: a part of a row for each cut


def test_shards_that_need_not_change_are_not_written(spark):
    rows = [(i, "x" * 84, i % 4 if i < 380 else 3) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int").repartition(5)
    layout = sharding.reshard(docs, F.col("shard"), 4, tolerance=0.06)
    check(docs, layout, 4, 1200)
    assert 0 < len(layout.written) < 4
    kept = {r["doc_id"]: r["shard"] for r in layout.rows.collect()}
    assert sum(kept[i] != s for i, _, s in rows) * 100 == layout.moved == 900


def test_one_hot_shard_of_equal_rows_is_split(spark):
    docs = spark.createDataFrame([(1, "same text")] * 3000 + [(2, None)] * 100, "doc_id long, text string").repartition(4)
    check(docs, sharding.reshard(docs, F.lit(7), 9), 9, 60)


def test_odd_rows(spark):
    docs = cases.odd(spark)
    layout = sharding.reshard(docs, F.col("doc_id") % 5, 3)
    assert set(docs.columns) <= set(layout.rows.columns)
    sizes = check(docs, layout, 3, 200_000)
    # one row is longer than a shard's share: it has a shard by itself
    assert abs(sorted(sizes)[0] - sorted(sizes)[1]) < 8000 and max(sizes) == 100_016
    for n in (1, 40):
        check(docs, sharding.reshard(docs, F.lit(None), n), n, 200_000)
    assert sharding.reshard(cases.none(spark), F.lit(1), 3).rows.count() == 0
