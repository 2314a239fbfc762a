import collections
import math
import os
import pickle
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from subscope.llm import lm, queries
from tests.llm import cases


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate({i: i + 32 for i in range(65, 91)}))


def brute(rows):
    held = lambda key: zlib.crc32(("null" if key is None else str(key)).encode()) % 5 == 1
    counts, ends = collections.Counter(), 0
    for key, text in rows:
        if not held(key):
            counts.update(words(text))
            ends += 1
    total, distinct = sum(counts.values()) + ends, len(counts) + (ends > 0)
    floor = math.log10(total + 0.5 * (distinct + 1))
    out = []
    for key, text in rows:
        own = words(text)
        base = sum(math.log10(counts[w] + 0.5) - floor for w in own) + math.log10(ends + 0.5) - floor
        out.append((repr(key), held(key), len(own) + 1, sum(w in counts for w in own) + (ends > 0), total, round(base, 5)))
    return sorted(out)


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 20])
def test_base_score_equals_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    for docs in (cases.odd(spark), spark.read.parquet(f"{cases.SMALL}/documents.parquet")):
        rows = lm.scores(docs).collect()
        assert sorted((repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in rows) == brute(cases.texts_of(docs))
        assert all(r["score"] < 0 for r in rows)
        assert lm.scores(cases.none(spark)).count() == 0


def test_better_than_the_base_on_held_out_text(spark):
    rows = [r for r in queries.QUERIES["op6_lm_scores"](spark, cases.TABLES).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_probabilities_of_all_next_leaves_sum_to_one():
    rng = np.random.default_rng(0)
    vocabulary = [f"w{k}" for k in range(30)]
    sample = pa.array([" ".join(rng.choice(vocabulary, 40)) for _ in range(30)], pa.large_string())
    setting = lm.Setting(pa.array(vocabulary[:10]), np.arange(20, 10, -1), 100, 30, sample)
    tables = [np.zeros(2 << size, np.int32) for _, size in lm.TABLES]
    for table in tables:
        table[: 1 << 12] = rng.integers(0, 30, 1 << 12)
    model = lm.Mixer(setting, tables, lm.started(setting, tables, sample))
    leaves = len(setting.words) + 2
    total = 0.0
    for leaf in range(leaves):
        bits = lm.Bits(setting, *lm.tokens(pa.array(["w1 w2 w3"], pa.large_string())))
        bits.leaf[3] = leaf  # the place after three words
        at, bit, slots = bits.tree(slice(0, 4))
        total += math.exp(-model._nats(0, bit, slots)[at == 3].sum())
    assert total == pytest.approx(1, abs=1e-4)


def test_codes_are_complete_and_paths_are_right():
    code = lm.Code(np.array([50, 20, 5, 1, 0, 0]))
    assert sum(2.0**-k for k in code.size) == pytest.approx(1)
    paths = {tuple(zip(code.nodes[a:b], code.bits[a:b], strict=True)) for a, b in zip(code.first[:-1], code.first[1:], strict=True)}
    assert len(paths) == 6 and len({p[0][0] for p in paths}) == 1


def test_blocks_add_up():
    block = np.arange(2 * lm.BLOCK, dtype=np.int32)
    one = pa.RecordBatch.from_arrays([pa.array([0, 0, 1], pa.int32()), pa.array([3, 3, 0], pa.int32()), pa.array([lm._packed(block, lm._PART)] * 3, pa.binary())], names=["table", "block", "counts"])
    rows = [r for b in lm._added(iter([one])) for r in b.to_pylist()]
    assert [(r["table"], r["block"]) for r in rows] == [(0, 3), (1, 0)] and (lm._opened(rows[0]["counts"]) == 2 * block).all()


def test_tokens_of_slices_are_those_of_the_texts():
    texts = [f"Été {k} Über\tEnde {'x' * k} ñ" if k % 7 else None for k in range(400)]
    whole = pa.array(texts)
    for a in (0, 3, 150):
        found, number, per_text = lm.tokens(whole.slice(a, 90))
        got = found.take(pa.array(number)).to_pylist()
        assert got == [w for t in texts[a : a + 90] for w in words(t or "")]
        assert per_text.tolist() == [len(words(t or "")) for t in texts[a : a + 90]]


def test_base_score_over_many_slices(spark, monkeypatch):
    from subscope.llm import common

    monkeypatch.setattr(common, "SLICE_BYTES", 3000)
    docs = spark.read.parquet(f"{cases.SMALL}/documents.parquet")
    sliced = [lm.tokens(b.column("text")) for b in common.slices(iter(docs.toArrow().to_batches()), limit=3000)]
    assert sum(len(n) for _, n, _ in sliced) == sum(len(words(t)) for _, t in cases.texts_of(docs))


def test_counts_are_added_in_64_bits():
    block = np.full(2 * lm.BLOCK, (1 << 31) - 1, np.int32)
    many = pa.RecordBatch.from_arrays([pa.array([0] * 5, pa.int32()), pa.array([0] * 5, pa.int32()), pa.array([lm._packed(block, lm._PART)] * 5, pa.binary())], names=["table", "block", "counts"])
    (out,) = lm._added(iter([many]))
    assert (lm._opened(out.column("counts")[0].as_py()) == 5 * ((1 << 31) - 1)).all()


class Given:
    def __init__(self, value):
        self.value = value


def small_model(texts):
    sample = pa.array(texts, pa.large_string())
    words, number, _ = lm.tokens(sample)
    times = np.bincount(number, minlength=len(words))
    order = np.argsort(-times, kind="stable")[:12]
    setting = lm.Setting(words.take(pa.array(order)), times[order], int(times.sum() - times[order].sum()), len(texts), sample)
    return setting, sample


def counted(setting, sample):
    tables = [np.zeros(2 << size, np.int64) for _, size in lm.TABLES]
    for out in lm._gather(Given(setting))(iter([pa.RecordBatch.from_arrays([sample], names=["text"])])):
        for table, block, data in zip(*(c.to_pylist() for c in out.columns), strict=True):
            tables[table][2 * lm.BLOCK * block : 2 * lm.BLOCK * (block + 1)] += lm._opened(data, lm._PART)
    return tables


def prose(n, seed=0):
    rng = np.random.default_rng(seed)
    vocabulary = [f"wörd{k}" for k in range(60)]
    return [" ".join(rng.choice(vocabulary, 50, p=np.arange(60, 0, -1) / 1830)) for _ in range(n)]


def test_tables_handed_on_early_hold_the_same_counts(monkeypatch):
    setting, sample = small_model(prose(40))
    whole = counted(setting, sample)
    monkeypatch.setattr(lm, "HANDED", 1000)
    assert all((a == b).all() for a, b in zip(whole, counted(setting, sample), strict=True))
    bits = lm.Bits(setting, *lm.tokens(sample))
    assert whole[0].sum() == len(bits.tree(slice(0, None))[1]) and whole[4].sum() == len(bits.spelled(slice(0, None))[1])


def test_score_equals_a_slow_recomputation():
    setting, sample = small_model(prose(60))
    counts = counted(setting, sample)
    lessons = lm.started(setting, counts, sample)
    texts = pa.array([*prose(4, 1), "unseen wörd1", ""], pa.large_string())
    fast = lm.Mixer(setting, counts, lessons).cost(*lm.tokens(texts))
    bits, per_text = lm.Bits(setting, *lm.tokens(texts)), []
    owner = np.repeat(np.arange(len(texts)), bits.per_text)
    per_text, map_ = [0.0] * len(texts), lessons.map()
    for tree, (at, bit, slots) in enumerate((bits.tree(slice(0, None)), bits.spelled(slice(0, None)))):
        for i in range(len(bit)):
            pairs = [(int(t[2 * s[i]]), int(t[2 * s[i] + 1])) for t, s in zip(counts[4 * tree : 4 * tree + 4], slots, strict=True)]
            level = [sum(a + b > bound for bound in (0, 2, 15)) for a, b in pairs]
            gate = 4 * level[3] + level[2]
            weights = lessons.weights[tree][gate]
            z = weights[0] + sum(w * math.log((b + 0.4) / (a + 0.4)) for w, (a, b) in zip(weights[1:], pairs, strict=True))
            x = (min(max(z, -12), 12) + 12) * (lm.MAP - 1) / 24
            low = min(int(x), lm.MAP - 2)
            mapped = map_[tree][gate][low] * (1 - x + low) + map_[tree][gate][low + 1] * (x - low)
            per_text[owner[at[i]]] += math.log1p(math.exp(mapped if not bit[i] else -mapped))
    # look-ups round logits to twelfths
    assert fast == pytest.approx(per_text, rel=0.02, abs=0.1)


def test_learning_goes_over_all_partitions_and_does_not_depend_on_them(spark, monkeypatch):
    docs = spark.read.parquet(f"{cases.SMALL}/documents.parquet").select("doc_id", "text")
    setting, sample = small_model([t for _, t in cases.texts_of(docs)][:50])
    counts, start = counted(setting, sample), lm.Learned()
    monkeypatch.setattr(lm, "GROUP", 20)
    seen = []
    for share in (4, 1):
        monkeypatch.setattr(lm, "SHARE", share)
        one, other = (lm.learned(d, setting, counts, start) for d in (docs, docs.repartition(7)))
        assert (one.weights == other.weights).all() and (one.map() == other.map()).all()
        seen.append(one.bits.sum())
    bits = lm.Bits(setting, *lm.tokens(pa.array([t for _, t in cases.texts_of(docs)], pa.large_string())))
    assert seen[1] == len(bits.tree(slice(0, None))[1]) + len(bits.spelled(slice(0, None))[1]) and 0 < seen[0] < seen[1]


def test_all_training_documents_teach(spark, monkeypatch):
    # 20 documents in the sample: all of them are where topics, bytes, weights and map come from
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(f"{'ab'[k % 2]}{w}" for w in rng.integers(0, 40, 60))) for k in range(200)]
    train = spark.createDataFrame(rows, "doc_id long, text string")
    vocabulary = [f"{c}{w}" for c in "ab" for w in range(40)]
    sample = pa.array([t for _, t in rows[:20]], pa.large_string())
    setting = lm.Setting(pa.array(vocabulary), np.full(80, 150), 1, 200, sample, np.bincount([97, 98, 32], minlength=256))
    before = setting.topics.copy()
    lm.fit_topics(train, setting)
    assert not np.array_equal(before, setting.topics)
    again = lm.Setting(pa.array(vocabulary), np.full(80, 150), 1, 200, sample, np.bincount([97, 98, 32], minlength=256))
    lm.fit_topics(train.repartition(5), again)
    assert np.array_equal(again.topics, setting.topics) and np.array_equal(again.prior, setting.prior)
    counts = [np.zeros(2 << size, np.float32) for _, size in lm.TABLES]
    bits = lm.Bits(setting, *lm.tokens(pa.array([t for _, t in rows], pa.large_string())))
    lessons = lm.learned(train, setting, counts, lm.Learned())
    seen = [sum(len((bits.spelled if tree else bits.tree)(piece)[1]) for piece in bits.pieces()) for tree in range(2)]
    assert [round(n) for n in lessons.bits.sum(1)] == seen  # every bit of every document, once


@pytest.mark.parametrize("kind", [np.float32, np.uint16])
def test_tables_travel_packed(kind):
    tables = lm.Tables(np.zeros(2 << size, kind) for _, size in lm.TABLES)
    spots = np.random.default_rng(1).integers(0, 1 << 18, 1000)
    for table in tables:
        table[spots] = spots % 60_000
    sent = pickle.dumps(tables)
    assert len(sent) < 1 << 20 < sum(t.nbytes for t in tables)
    back = pickle.loads(sent)
    assert isinstance(back, lm.Tables) and len(back) == len(tables)
    assert all(a.dtype == b.dtype and (a == b).all() for a, b in zip(tables, back, strict=True))


def test_what_training_sends_leaves_no_file(spark, monkeypatch):
    sent, shared = [], lm.common.shared
    monkeypatch.setattr(lm.common, "shared", lambda *args: sent.append(shared(*args)) or sent[-1])
    docs = spark.createDataFrame([(k, f"a{k % 5} b c{k % 3}") for k in range(60)], "doc_id long, text string")
    setting, sample = small_model([f"a{k % 5} b c{k % 3}" for k in range(60)])
    lm.fit_topics(docs, setting)
    lm.learned(docs, setting, counted(setting, sample), lm.Learned())
    assert sent and not any(os.path.exists(b._path) for b in sent)


def test_tokens_that_tables_see_alike_are_counted_and_looked_up_once(monkeypatch):
    setting, sample = small_model([*prose(40), "unseen unseen wörd1 unseen", ""])
    bits = lm.Bits(setting, *lm.tokens(sample))
    plain = [np.zeros(2 << size, np.int64) for _, size in lm.TABLES]
    for own, (_, bit, slots) in ((plain[:4], bits.tree(slice(None))), (plain[4:], bits.spelled(slice(None)))):
        for table, slot in zip(own, slots, strict=True):
            np.add.at(table, 2 * slot + bit, 1)
    spelled, entries = [], lm.Code.entries
    monkeypatch.setattr(lm.Code, "entries", lambda code, leaves: (spelled.append(len(leaves) * (code is setting.tree)), entries(code, leaves))[1])
    assert all((a == b).all() for a, b in zip(plain, counted(setting, sample), strict=True))
    # 2,000 tokens in four tables
    assert sum(spelled) < 2 * len(bits.leaf), (sum(spelled), len(bits.leaf))
    monkeypatch.undo()
    known = lm.Before(plain)
    for window in (lm._WINDOW, 2 * lm._TOKENS):
        monkeypatch.setattr(lm, "_WINDOW", window)
        at = 0
        for tree, found in enumerate((known.tree(bits), known.spelled(bits))):
            found = list(found)
            _, bit, slots = (bits.spelled if tree else bits.tree)(slice(None))
            x, gate = known._inputs(tree, bit, slots)
            assert np.array_equal(np.concatenate([f[2] for f in found]), bit) and np.array_equal(np.concatenate([f[4] for f in found]), gate)
            assert all(np.array_equal(np.concatenate([f[3][k] for f in found]), x[k]) for k in range(4))
            at += len(bit)
        assert at == plain[0].sum() + plain[4].sum()


def test_what_predicts_a_bit_has_not_seen_it():
    counts = [np.zeros(2 << size, np.float32) for _, size in lm.TABLES]
    for table in counts:
        table[:6] = [3, 0, 1, 20, 0, 1]
    known = lm.Before(counts)
    for logits in known.logits:
        expect = [math.log(0.4 / 2.4), math.log(0.4 / 3.4), math.log(20.4 / 0.4), math.log(19.4 / 1.4), math.log(1.4 / 0.4), 0]
        assert logits[:6] == pytest.approx(expect, abs=1e-5)
    for levels in known.levels:
        assert levels[:6].tolist() == [1, 2, 3, 3, 1, 0]


def spelled_prose(n, seed=0):
    # words that few texts share, of syllables that many do
    rng = np.random.default_rng(seed)
    return [" ".join("".join(rng.choice(["ba", "né", "to", "ri"], 5)) for _ in range(40)) + " the" * 9 for _ in range(n)]


def test_symbols_that_tables_see_alike_are_counted_looked_up_and_scored_once(monkeypatch):
    setting, sample = small_model(spelled_prose(40))
    counts = counted(setting, sample)
    bits = lm.Bits(setting, *lm.tokens(sample))
    rare = bits.rare(slice(None))
    symbols = len(bits.symbols(bits.number[rare], bits.topic[rare])[0]) if hasattr(bits, "symbols") else int((np.diff(bits.offsets)[bits.number[rare]] + 1).sum())
    known, model = lm.Before(counts), lm.Mixer(setting, counts, lm.started(setting, counts, sample))
    spelled, entries = [], lm.Code.entries
    monkeypatch.setattr(lm.Code, "entries", lambda code, leaves: (spelled.append(len(leaves) * (code is setting.bytes)), entries(code, leaves))[1])
    # four tables, each by itself
    for work, times in ((lambda: counted(setting, sample), 4), (lambda: list(known.spelled(bits)), 1), (lambda: model.cost(*lm.tokens(sample)), 1)):
        spelled.clear()
        work()
        assert 0 < sum(spelled) < times * symbols / 4, (sum(spelled), symbols)


def test_what_is_kept_for_the_next_texts_changes_nothing(monkeypatch):
    setting, sample = small_model([*prose(30), *spelled_prose(30)])
    counts, parts = counted(setting, sample), [pa.array(prose(20, s) + spelled_prose(20, s), pa.large_string()) for s in (1, 2, 3, 1)]
    learned, costs = [], []
    for most, most_bits in ((1 << 20, 1 << 19), (100, 300), (0, 0)):
        monkeypatch.setattr(lm, "KEPT", most)
        monkeypatch.setattr(lm, "KEPT_BITS", most_bits)
        known, lessons = lm.Before(counts), lm.Learned()
        for part in parts:
            for tree in range(2):
                lessons.learn(tree, lm.Bits(setting, *lm.tokens(part)), known)
        learned.append(lessons.sums())
        model, made = lm.Mixer(setting, counts, lessons), []
        for part in parts:
            plain = model._costs
            monkeypatch.setattr(model, "_costs", lambda tree, key, bits, plain=plain: (made.append(len(key)), plain(tree, key, bits))[1])
            made.clear()
            costs.append(model.cost(*lm.tokens(part)))
            monkeypatch.setattr(model, "_costs", plain)
            assert all(len(key) <= most and (np.diff(key) > 0).all() for key, _ in model.kept)
        assert known.kept[2] <= most_bits
        # the last texts came before
        assert (sum(made) == 0) == (most > 100)
        costs[-4:] = [np.concatenate(costs[-4:])]
    assert all((x == learned[0]).all() for x in learned) and all((x == costs[0]).all() for x in costs)


def test_logits_and_levels_lie_in_the_same_bits():
    rng = np.random.default_rng(5)
    counts = [np.zeros(2 << size, np.float32) for _, size in lm.TABLES]
    for table in counts:
        table[:4000] = np.where(rng.random(4000) < 0.2, rng.integers(0, 1 << 24, 4000), rng.integers(0, 20, 4000))
        table[4000:4008] = [2, 1, 1 << 24, (1 << 24) - 2, 0, 1 << 30, 1, 0]
    known = lm.Before(counts)
    for back in (known, pickle.loads(pickle.dumps(known))):
        for k, table in enumerate(counts):
            for bit in range(2):
                zero, one = (np.maximum(table[b::2] - (b == bit), 0) for b in range(2))
                assert np.array_equal(back.logits[k][bit::2], lm._logit(zero, one).astype(np.float32))
                if k % 4 > 1:
                    assert np.array_equal(back.levels[k // 4 * 2 + k % 4 - 2][bit::2], lm._seen(zero + one))
    assert sum(t.nbytes for t in known.tables) == sum(4 * len(t) for t in counts)


def test_slices_that_share_their_words_teach_as_before(monkeypatch):
    setting, sample = small_model([*prose(30), *spelled_prose(30)])
    counts, start = counted(setting, sample), lm.Learned()
    known, slices = lm.Before(counts), lm.common.slices
    texts = pa.array([*prose(40, 4), "", None, *spelled_prose(41, 4), "x" * 9000], pa.string())
    batches = [pa.RecordBatch.from_arrays([t], names=["text"]) for t in (texts, texts.slice(3, 30))]
    monkeypatch.setattr(lm.common, "slices", lambda batches, column="text", limit=4000: slices(batches, column, 4000))
    expect = lm.Learned(start)
    for part in lm.common.slices(iter(batches)):
        for tree in range(2):
            expect.learn(tree, lm.Bits(setting, *lm.tokens(part.column("text"))), known)
    (out,) = lm._taught(Given((setting, known, start)))(iter(batches))
    sums = np.zeros_like(start.sums())
    sums[out.column(0).to_numpy()] = out.column(1).to_numpy()
    assert (sums == expect.sums()).all()
