"""Encoding of features against plain computations, and on inputs with gaps, ties and many values."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from subscope.operators import stats
from subscope.plans import encoding


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, a double, b double, c string, d string")


@pytest.mark.parametrize("seed", range(3))
def test_figures_equal_plain_ones(spark, seed):
    rng = random.Random(seed)
    value = lambda: rng.choice([None, float("nan"), 1.0, 2.0, rng.gauss(0, 5), rng.gauss(0, 1e9)])
    rows = [(i, value(), float(i % 7), None, None) for i in range(rng.choice([1, 2, 399, 400]))]
    got = {r["column"]: r for r in encoding.numbers(frame(spark, rows), ["a", "b"]).collect()}
    for k, c in ((1, "a"), (2, "b")):
        have = [r[k] for r in rows if r[k] is not None and r[k] == r[k]]
        median = statistics.median(have) if have else 0.0
        full = [r[k] if r[k] is not None and r[k] == r[k] else median for r in rows]
        assert got[c]["median"] == median
        assert got[c]["mean"] == pytest.approx(statistics.fmean(full), rel=1e-9, abs=1e-9)
        assert got[c]["deviation"] == pytest.approx(statistics.pstdev(full), rel=1e-9, abs=1e-9)


def test_medians_of_empty_and_missing_columns(spark):
    df = frame(spark, [(1, None, 3.0, None, None), (2, None, 4.0, None, None)])
    assert {r["column"]: r["median"] for r in stats.medians(df, ["a", "b"]).collect()} == {"b": 3.5}
    assert stats.medians(df.filter("false"), ["a", "b"]).count() == 0


def test_medians_read_their_input_twice(spark, plan):
    df = spark.range(0, 200_000, 1, 8).select(F.col("id").cast("double").alias("a"), F.lit(5.0).alias("b"), (F.xxhash64("id") % 1000).cast("double").alias("c"))
    got = {r["column"]: r["median"] for r in stats.medians(df, ["a", "b", "c"]).collect()}
    assert got["a"] == 99_999.5 and got["b"] == 5.0
    values = sorted(r["c"] for r in df.select("c").collect())
    assert got["c"] == (values[99_999] + values[100_000]) / 2
    assert plan(stats.medians(df, ["a", "b", "c"])).count("Range (") == 1  # one scan more brackets the middle


def test_modes_slots_and_unknown_values(spark, tmp_path):
    rows = [(i, 1.0, None, x, None) for i, x in enumerate(["y", "x", "x", "y", "z", None])]
    coded = encoding.fit(frame(spark, rows), ["a", "b"], ["c", "d"], str(tmp_path / "e"))
    assert coded.fill == {"c": "x", "d": "missing"} and coded.sizes == {"c": 3, "d": 1}
    names = [r["feature_name"] for r in coded.names().orderBy("place").collect()]
    assert names == ["numeric__a", "numeric__b", "categorical__c_x", "categorical__c_y", "categorical__c_z", "categorical__d_missing"]
    new = frame(spark, [(1, 2.0, 7.0, "new", "new"), (2, None, None, None, None), (3, 1.0, 0.0, "z", None)])
    got = {r["id"]: r["features"].toArray().tolist() for r in coded.encode(new).collect()}
    # a constant column is only centred
    assert got == {1: [1.0, 7.0, 0, 0, 0, 0], 2: [0.0, 0.0, 1, 0, 0, 1], 3: [0.0, 0.0, 0, 0, 1, 1]}


@pytest.mark.parametrize("sent", [encoding.SENT, 10])
def test_many_categories(spark, tmp_path, monkeypatch, sent):
    monkeypatch.setattr(encoding, "SENT", sent)
    df = spark.range(0, 120_000, 1, 8).select("id", F.lit(1.0).alias("a"), F.lit(None).cast("double").alias("b"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.format_string("v%06d", "id")).alias("c"), F.lit("k").alias("d"))
    coded = encoding.fit(df, ["a"], ["c", "d"], str(tmp_path / "e"))
    assert coded.sizes == {"c": 80_001, "d": 1} and coded.fill["c"] == "hot"
    rows = coded.encode(df).filter("id in (0, 1, 119999)").collect()
    at = {r["id"]: r["features"].indices.tolist() for r in rows}
    # the values in their order: hot, v000001, v000002, v000004, ...
    assert at == {0: [1, 80_002], 1: [2, 80_002], 119_999: [80_001, 80_002]}


def test_split_reads_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(0, 1000, 1, 4).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).cast("int").alias("y")).mapInArrow(count, "k string, y int")
    split = stats.stratified_split(df, "y", "k")
    assert {r["y"]: r["n"] for r in split.groupBy("y").agg(F.sum("is_test").alias("n")).collect()} == {0: 67, 1: 67, 2: 67}
    assert seen.value == 1000


def test_a_forest_that_keeps_reached_nodes_grows_the_same_trees(spark):
    from pyspark.ml.feature import VectorAssembler

    from subscope.plans import churn

    columns = [F.randn(k).alias(f"x{k}") for k in range(4)]
    rows = spark.range(0, 600, 1, 3).select((F.rand(9) < 0.3).cast("int").alias(churn.LABEL), F.lit(1.5).alias("weight"), *columns)
    rows = VectorAssembler(inputCols=[f"x{k}" for k in range(4)], outputCol="features").transform(rows)
    forest = churn.random_forest(5, 4)
    assert forest.getCacheNodeIds()
    kept, walked = forest.fit(rows), forest.copy({forest.cacheNodeIds: False}).fit(rows)
    text = lambda model: model.toDebugString.split("\n", 1)[1]  # noqa: E731 - the first line names the model
    assert text(kept) == text(walked)


def test_a_large_forest_grows_in_parts_that_make_one_model(spark, tmp_path, monkeypatch):
    from pyspark.ml.classification import RandomForestClassificationModel
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from subscope.plans import churn

    assert churn.part_sizes(300, 12_000) == [300] and churn.part_sizes(300, 0) == [300]
    for rows in (200_000, 4_320_000, 10**12):
        sizes = churn.part_sizes(300, rows)
        assert sum(sizes) == 300 and len(sizes) <= 12 and max(sizes) <= max(churn.PART_TREES, churn.GROWN // rows)
    columns = [F.randn(k).alias(f"x{k}") for k in range(4)]
    rows = spark.range(0, 600, 1, 3).select("id", (F.rand(9) < 0.3).cast("int").alias(churn.LABEL), F.lit(1.5).alias("weight"), *columns)
    rows = VectorAssembler(inputCols=[f"x{k}" for k in range(4)], outputCol="features").transform(rows)
    forest = churn.random_forest(5, 4)
    whole = churn.grown(forest, rows, 600, str(tmp_path / "whole"))
    assert whole.toDebugString.split("\n", 1)[1] == forest.fit(rows).toDebugString.split("\n", 1)[1]
    fits = []
    monkeypatch.setattr(churn, "GROWN", 1)
    monkeypatch.setattr(churn, "PART_TREES", 2)
    monkeypatch.setattr(type(forest), "fit", lambda self, df, fit=type(forest).fit: fits.append(fit(self, df)) or fits[-1])
    made = churn.grown(forest, rows, 600, str(tmp_path / "parts"))
    assert [m.getNumTrees for m in fits] == [2, 2, 1] and {m.getMaxDepth() for m in fits} == {4}
    assert len({tree.toDebugString.split("\n", 1)[1] for m in fits for tree in m.trees}) == 5
    fits = [RandomForestClassificationModel.load(p) for p in made.parts]  # a fitted model's summary holds the session
    twice = rows.unionByName(rows.limit(50))  # rows that come twice are scored twice
    scored = made.transform(twice)
    assert scored.dtypes == fits[0].transform(twice).dtypes and scored.count() == 650
    columns = lambda m: zip(*m.transform(twice).orderBy("id").select(vector_to_array("rawPrediction"), vector_to_array("probability"), "prediction").collect(), strict=True)
    raw, probability, prediction = columns(made)
    for votes, p, label, *parts in zip(raw, probability, prediction, *[next(columns(m)) for m in fits], strict=True):
        assert votes == pytest.approx([sum(v) for v in zip(*parts, strict=True)])
        assert p == pytest.approx([v / 5 for v in votes]) and label == float(votes[1] > votes[0])
    share = [sum(m.featureImportances[k] * m.getNumTrees for m in fits) / 5 for k in range(4)]
    assert list(made.featureImportances.toArray()) == pytest.approx(share)


def test_the_chain_publishes_a_forest_grown_in_parts(spark, wh, monkeypatch):
    from subscope.plans import churn

    monkeypatch.setattr(churn, "GROWN", 1)
    monkeypatch.setattr(churn, "PART_TREES", 2)
    features = wh.gold("customer_ml_features")
    runs, _ = churn.train_all(features, trees=4, depth=3, max_iter=5)
    forest = runs[1]
    assert isinstance(forest["model"].classifier, churn.Forest) and len(forest["model"].classifier.parts) == 2
    own, other = churn.publish(forest), churn.publish(forest, features)
    shown = lambda df: sorted(tuple(r) for r in df.select("customer_id", "predicted_churn_label", "churn_probability", "split").collect())
    assert shown(own) == shown(other) and own.count() == features.count()
    assert churn.importance(spark, forest).count() == len(forest["model"].encoding.names().collect())
