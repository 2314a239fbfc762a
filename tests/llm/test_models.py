"""Quality, language and toxicity: parts against brute force, held-out accuracy on whole tables."""

import itertools

import numpy as np
import pyarrow as pa
import pytest

from subscope.llm import common, language, quality, queries, toxicity
from tests.llm import cases


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    per_doc = np.array([1, 4, 3])
    unary, tie = rng.normal(0, 1, 8), rng.normal(0, 1, (2, 2))
    p, pairs = quality.marginals(unary, per_doc, tie)
    expected, expected_pairs, at = [], np.zeros((2, 2)), 0
    for n in per_doc:
        states = list(itertools.product((0, 1), repeat=int(n)))
        weight = np.array([np.exp(sum(unary[at + i] * s for i, s in enumerate(y)) + sum(tie[a, b] for a, b in itertools.pairwise(y))) for y in states])
        weight /= weight.sum()
        expected += [sum(w for w, y in zip(weight, states, strict=True) if y[i]) for i in range(n)]
        for w, y in zip(weight, states, strict=True):
            for a, b in itertools.pairwise(y):
                expected_pairs[a, b] += w
        at += n
    assert np.allclose(p, expected) and np.allclose(pairs, expected_pairs)


def test_line_features_see_lines():
    features, size, per_doc = quality.lines(pa.array(["a b\nA B!\n", "", None, "x"]))
    assert per_doc.tolist() == [3, 1, 1, 1] and size.tolist() == [3, 4, 0, 0, 0, 1]
    assert features.shape[0] == 6 and np.isfinite(features).all()


def test_network_gradients_equal_differences():
    rng = np.random.default_rng(1)
    windows = rng.integers(97, 100, (6, language.WINDOW)).astype(np.uint8)
    mask, label = np.ones(windows.shape, bool), np.arange(6) % 2
    mask[0, 5:] = False
    net = language.Network(["a", "b"], windows, mask, label)

    def loss():
        f, _ = net.cells[0].trace(windows.T)
        b, _ = net.cells[1].trace(windows.T[::-1])
        z = np.einsum("ksn,sc->kcn", np.concatenate([f, b[::-1]], 1), net.out) + net.shift[:, None]
        z = z - z.max(1, keepdims=True)
        logp = z - np.log(np.exp(z).sum(1, keepdims=True))
        return -(logp[:, label, np.arange(6)] * mask.T).sum() / mask.sum()

    for cell in net.cells:  # inside the linear part of the gates
        cell.table, cell.turn = cell.table.astype(np.float64) * 0.1 + 0.3, cell.turn.astype(np.float64) * 0.1
    net.out = net.out.astype(np.float64)
    grads = net._gradients(np.ascontiguousarray(windows.T), mask.T, label)
    for array, grad in ((net.cells[0].table, grads[0]), (net.cells[1].turn, grads[3]), (net.out, grads[4])):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        keep, step = array[at], 1e-5
        array[at] = keep + step
        high = loss()
        array[at] = keep - step
        low = loss()
        array[at] = keep
        assert grad[at] == pytest.approx((high - low) / (2 * step), rel=0.02)


def test_fast_reading_equals_the_trace():
    rng = np.random.default_rng(2)
    cell = language.Cell(rng)
    windows = rng.integers(0, 256, (language.WINDOW, 7)).astype(np.uint8)
    out = np.empty((language.WINDOW, language.STATE, 7), np.float32)
    cell.read(windows, out)
    assert np.allclose(out, cell.trace(windows)[0], atol=1e-5)


def _truth(spark, column, folder=cases.TABLES):
    return {r["doc_id"]: r[column] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}


def test_quality_on_held_out_documents(spark):
    truth = _truth(spark, "quality")
    rows = queries.QUERIES["op4_quality"](spark, cases.TABLES).collect()
    held = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(rows) == 1000 and np.mean([a == b for a, b in held]) > 0.93


def test_language_on_held_out_documents(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{cases.TABLES}/documents.parquet").collect()}
    rows = queries.QUERIES["op5_language"](spark, cases.TABLES).collect()
    held = [r["lang_pred"] == truth[r["doc_id"]] for r in rows if r["held_out"]]
    assert len(rows) == 1000 and np.mean(held) > 0.97


def test_a_language_is_learned_although_its_first_documents_cannot_be(spark):
    # of each language many documents without a letter, or too long, and a few good ones
    good = {"en": "the house and the garden of the people ", "de": "das haus und der garten der leute ist schoen "}
    rows = [(i, "12 34", x) for x, base in (("en", 0), ("de", 1000)) for i in range(base, base + 300)]
    rows += [(2000 + 10 * k + i, good[x] * 8, x) for k, x in enumerate(good) for i in range(8)]
    rows += [(3000 + i, "long " * 15_000, "de") for i in range(20)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most=4)
    asked = spark.createDataFrame([(1, good["en"] * 3), (2, good["de"] * 3)], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in language.predictions(asked, model).collect()} == {1: "en", 2: "de"}


def test_toxicity_on_held_out_documents(spark):
    # the larger table: the smaller one has six toxic documents held out
    truth = _truth(spark, "toxic", cases.LARGE)
    rows = queries.QUERIES["op8_toxicity"](spark, cases.LARGE).collect()
    held = [(r["score"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    toxic, clean = np.array([s for s, t in held if t]), np.array([s for s, t in held if not t])
    assert len(rows) == 10_000 and (toxic[:, None] > clean).mean() > 0.9 and (clean >= 0.5).mean() < 0.02


def test_unlabelled_toxic_texts_do_not_teach_that_toxic_is_clean():
    rng = np.random.default_rng(0)
    text = lambda toxic: " ".join([f"w{k}" for k in rng.integers(0, 300, 40)] + ["vile"] * toxic)
    positive = pa.array([text(1) for _ in range(80)])
    unlabelled = pa.array([text(int(k % 5 == 0)) for k in range(400)])
    model = toxicity.Classifier(positive, unlabelled, 0.2)
    score = model.score(pa.array([text(1) for _ in range(50)] + [text(0) for _ in range(50)]))
    assert (score[:50] >= 0.5).mean() > 0.9 and (score[50:] >= 0.5).mean() < 0.1


def test_odd_rows(spark):
    docs, none = cases.odd(spark), cases.none(spark)
    labels = cases.labels(spark, docs)
    for module in (quality, toxicity):
        model = module.train(docs, labels)
        rows = module.scores(docs, model).collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert module.scores(none, model).count() == 0
        # equal texts score alike
        assert len({r["score"] for r in rows if r["doc_id"] == 0}) == 1
        nothing = module.train(docs, labels.where("false"))
        assert isinstance(nothing, float) and module.scores(docs, nothing).count() == docs.count()
    model = language.train(docs)
    rows = {r["doc_id"]: r for r in language.predictions(docs, model).collect()}
    assert rows[101]["lang_pred"] == rows[102]["lang_pred"] == rows[107]["lang_pred"] == "und"
    assert rows[0]["lang_pred"] in ("de", "en") and 0 <= rows[0]["score"] <= 1
    assert language.train(none) is None
    assert {r["lang_pred"] for r in language.predictions(docs, None).collect()} == {"und"}
    assert common.body(docs).columns == ["doc_id", "text"]


def test_quality_scores_keep_the_labels_shares_in_a_bounded_sample(spark):
    # no text tells the labels apart: a score is the share of good documents, six of seven
    words = ["alpha", "beta", "gamma", "delta"]
    rows = [(i, f"{words[i % 4]} {words[i // 4 % 4]} number {i}") for i in range(2100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(hash((i, 5)) % 7 > 0)) for i, _ in rows], "doc_id long, quality int")
    whole, part = (quality.train(docs, labels, most=most) for most in (2000, 100))
    for model in (whole, part):
        score = [r["score"] for r in quality.scores(docs, model).collect()]
        assert np.mean(score) == pytest.approx(6 / 7, abs=0.05)


def test_quality_label_pairs_follow_the_weights():
    rng = np.random.default_rng(0)
    unary, per_doc, tie = rng.normal(0, 1, 6), np.array([2, 3, 1]), rng.normal(0, 1, (2, 2))
    _, pairs = quality.marginals(unary, per_doc, tie, np.array([2.0, 1.0, 0.0]))
    first, second = (quality.marginals(unary[a:b], np.array([b - a]), tie)[1] for a, b in ((0, 2), (2, 5)))
    assert np.allclose(pairs, 2 * first + second)
