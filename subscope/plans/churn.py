"""Churn model training, evaluation, scoring and publishing on Spark ML.

Features stay in executors from the table to the published scores; only metrics and the
importance vector, both of fixed size, reach the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscope.operators import conform, scoring, stats
from subscope.operators.rollup import FEATURES
from subscope.plans import encoding
from subscope.session import work_dir

LABEL, KEY = "churn_label", "customer_id"
# texts among the features; the others are numbers
CATEGORICAL = [name for _, name, how in conform.CUSTOMER_SPEC if how in ("lower", "trim") and name in FEATURES]
NUMERIC = [c for c in FEATURES if c not in CATEGORICAL]
METRICS = ("accuracy", "precision", "recall", "f1_score", "roc_auc")
#: A forest of more rows times trees grows in parts: a row keeps 12 bytes for each tree of a fit. A part
#: has ``PART_TREES`` trees at least, so that the number of parts does not follow the rows.
GROWN, PART_TREES = 1 << 25, 25


def prepared(features: DataFrame) -> DataFrame:
    """Id, label and features; numbers as double (L1)."""
    return features.select(
        KEY, LABEL, *CATEGORICAL, *[F.col(c).cast("double").alias(c) for c in NUMERIC]
    )


def filled(df: DataFrame, fill: Mapping[str, str]) -> DataFrame:
    return df.fillna(dict(fill))


class ChurnModel(NamedTuple):
    """A fitted classifier and the encoding it was fitted on."""

    encoding: encoding.Encoding
    classifier: Model | Forest

    def transform(self, df: DataFrame) -> DataFrame:
        """Predictions for encoded rows, or for rows of the feature table."""
        return self.classifier.transform(df if "features" in df.columns else self.encoding.encode(df))


def logistic_regression(train_rows: int, c: float = 1.0, max_iter: int = 1000) -> LogisticRegression:
    """L2-penalised with balanced weights. ``c`` weighs the summed loss, Spark's penalty the
    mean loss, hence ``regParam = 1 / (c * rows)`` (balanced weights sum to the row count)."""
    return LogisticRegression(
        labelCol=LABEL,
        weightCol="weight",
        maxIter=max_iter,
        tol=1e-4,
        elasticNetParam=0.0,
        standardization=False,
        regParam=1.0 / (c * train_rows),
    )


def random_forest(trees: int = 300, depth: int = 12, min_split: int = 5, seed: int = 42) -> RandomForestClassifier:
    """Balanced forest. Spark bounds the size of children, not of split nodes; half of the
    split bound is the nearest equivalent. More memory per task means fewer passes over the
    rows, since each pass grows as many tree nodes as fit; every task of an executor takes that memory,
    and a level of ``PART_TREES`` trees fits. Every row keeps the node it has reached in
    each tree, so that no pass walks all trees from their roots again; the trees are the same."""
    return RandomForestClassifier(
        labelCol=LABEL,
        weightCol="weight",
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=max(1, min_split // 2),
        featureSubsetStrategy="sqrt",
        maxMemoryInMB=256,
        cacheNodeIds=True,
        seed=seed,
    )


def part_sizes(trees: int, rows: int) -> list[int]:
    """Trees of every part of a forest over so many rows; one part if the whole is small."""
    most = max(PART_TREES, GROWN // max(1, rows))
    parts = -(-trees // most)
    return [trees // parts + (k < trees % parts) for k in range(parts)]


class Forest(NamedTuple):
    """A forest grown in parts, each a saved model. The parts are read one after another, so neither the
    driver nor a task ever holds all trees; their votes meet in tables."""

    parts: Sequence[str]

    def _read(self) -> Iterator[RandomForestClassificationModel]:
        return map(RandomForestClassificationModel.load, self.parts)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the columns that a single model adds; every tree votes alike."""
        spark, folder = df.sparkSession, work_dir(df.sparkSession, "votes")
        df.withColumn("_row", F.monotonically_increasing_id()).write.parquet(f"{folder}/rows")
        rows = spark.read.parquet(f"{folder}/rows")
        for k, model in enumerate(self._read()):
            classes = model.numClasses
            votes = vector_to_array(model.getRawPredictionCol())
            model.transform(rows.select("_row", model.getFeaturesCol())).select("_row", *[votes[c].alias(f"_{c}") for c in range(classes)]).write.parquet(f"{folder}/votes/_part={k}")
        # a row has one vote of a part, and adds them in the order of the parts
        cell = lambda k, c: F.max(F.when(F.col("_part") == k, F.col(f"_{c}")))
        total = [reduce(Column.__add__, [cell(k, c) for k in range(len(self.parts))]).alias(f"_{c}") for c in range(classes)]
        raw = F.array(*[f"_{c}" for c in range(classes)])
        most = reduce(Column.__add__, [F.col(f"_{c}") for c in range(classes)])
        return rows.join(spark.read.parquet(f"{folder}/votes").groupBy("_row").agg(*total), "_row").select(
            *df.columns,
            array_to_vector(raw).alias(model.getRawPredictionCol()),
            array_to_vector(F.transform(raw, lambda v: F.when(most == 0, v).otherwise(v / most))).alias(model.getProbabilityCol()),
            (F.array_position(raw, F.array_max(raw)) - 1).cast("double").alias(model.getPredictionCol()),
        )

    @property
    def featureImportances(self) -> DenseVector:
        """The mean over the trees that split, as a single model has it."""
        total = 0
        for model in self._read():
            total = total + model.featureImportances.toArray() * sum(tree.depth > 0 for tree in model.trees)
        return DenseVector(total / (total.sum() or 1.0))


def grown(forest: RandomForestClassifier, train: DataFrame, rows: int, path: str) -> Model | Forest:
    """The forest fitted to ``train``, which has ``rows`` rows, saved to ``path`` and read back. A large one
    is fitted in parts, each with a seed of its own: executors keep what the trees of a part need."""
    sizes = part_sizes(forest.getNumTrees(), rows)
    if len(sizes) == 1:
        forest.fit(train).write().save(path)
        return RandomForestClassificationModel.load(path)
    parts = [f"{path}/part_{k:03d}" for k in range(len(sizes))]
    for k, (part, trees) in enumerate(zip(parts, sizes, strict=True)):
        forest.copy({forest.numTrees: trees, forest.seed: forest.getSeed() + 1_000_003 * k}).fit(train).write().save(part)
    return Forest(parts)


def score(model: ChurnModel, df: DataFrame) -> DataFrame:
    """Predicted label and probability of class 1 for every row."""
    out = model.transform(df)
    return out.select(
        KEY,
        LABEL,
        *[c for c in df.columns if c == "is_test"],
        F.col("prediction").cast("int").alias("predicted"),
        vector_to_array("probability")[1].alias("probability"),
    )


def evaluate(scored: DataFrame) -> dict[str, float]:
    """Accuracy, precision, recall, F1 and exact ROC AUC."""
    row = stats.binary_metrics(scored, LABEL, "predicted").first()
    return {**row.asDict(), "roc_auc": stats.roc_auc(scored, LABEL, "probability").first()["roc_auc"] or 0.0}


def train_and_log(name: str, estimator, params: Mapping[str, object], ready: Prepared) -> dict:
    """Fit on the training rows, save, evaluate on its test rows and describe
    the run (L10).

    What is evaluated is the saved model read back: it carries no training summary, so it
    ships to the executors as the bare model it will be in production. A large forest is saved
    as several models, in the folders ``part_*`` of the run's path.
    """
    example = ready.split.select(*CATEGORICAL, *NUMERIC)
    spark = example.sparkSession
    run_id = uuid.uuid4().hex
    path = f"{ready.folder}/{run_id}"
    table = spark.read.parquet(ready.rows)
    train = table.filter("is_test = 0")
    if isinstance(estimator, RandomForestClassifier):
        classifier = grown(estimator, train, train.count(), path)
    else:
        fitted = estimator.fit(train)
        fitted.write().save(path)
        classifier = type(fitted).load(path)
    model = ChurnModel(ready.encoding, classifier)
    scored = score(model, table.filter("is_test = 1"))
    scored.write.parquet(f"{path}/test_scores")
    return {
        "model_name": name,
        "run_id": run_id,
        "params": {k: str(v) for k, v in params.items()},
        "metrics": evaluate(spark.read.parquet(f"{path}/test_scores")),
        "input_schema": example.schema.json(),
        "output_schema": json.dumps({"predicted": "int", "probability": "double"}),
        "input_example": example.limit(5).toJSON().collect(),
        "model": model,
        "fill": ready.encoding.fill,
        "path": path,
        "rows": ready.rows,
    }


def best(runs: Sequence[dict]) -> dict:
    """The run with the highest ROC AUC."""
    return max(runs, key=lambda r: (r["metrics"]["roc_auc"], r["model_name"]))


class Prepared(NamedTuple):
    """One stratified split with its encoding, written: the split rows, and the vectors for them."""

    split: DataFrame
    encoding: encoding.Encoding
    rows: str
    folder: str


def prepare(features: DataFrame, folder: str | None = None) -> Prepared:
    """Split, fit the preprocessing on the training rows, encode every row; each once."""
    spark = features.sparkSession
    folder = folder or work_dir(spark, "models")
    stats.stratified_split(prepared(features), LABEL, KEY).write.parquet(f"{folder}/split")
    split = spark.read.parquet(f"{folder}/split")
    train = split.filter("is_test = 0")
    coded = encoding.fit(train, NUMERIC, CATEGORICAL, f"{folder}/encoding")
    weights = stats.balanced_weight(train, LABEL).select(LABEL, "weight").distinct()  # a row for each label
    rows = coded.encode(split.join(F.broadcast(weights), LABEL, "left")).select(KEY, LABEL, "is_test", "weight", "features")
    # a file for every core at least, so that fits use all of them
    rows.repartition(spark.sparkContext.defaultParallelism).write.parquet(f"{folder}/rows")
    return Prepared(split, coded, f"{folder}/rows", folder)


def fits(ready: Prepared, trees: int = 300, depth: int = 12, max_iter: int = 1000) -> list[dict]:
    """Both candidate models on the prepared rows."""
    train = ready.split.filter("is_test = 0").count()
    forest = {"algorithm": "RandomForest", "n_estimators": trees, "max_depth": depth, "class_weight": "balanced"}
    linear = {"algorithm": "LogisticRegression", "max_iter": max_iter, "class_weight": "balanced"}
    return [
        train_and_log(name, estimator, params, ready)
        for name, estimator, params in [
            ("Logistic Regression", logistic_regression(train, max_iter=max_iter), linear),
            ("Random Forest", random_forest(trees, depth), forest),
        ]
    ]


def train_all(
    features: DataFrame, folder: str | None = None, trees: int = 300, depth: int = 12, max_iter: int = 1000
) -> tuple[list[dict], DataFrame]:
    """Both candidate models on one stratified split; returns runs and the split frame.

    The preprocessing is fitted once, on the training rows, and every row is encoded and written
    once: fits, evaluation and publishing read that table.
    """
    ready = prepare(features, folder)
    return fits(ready, trees, depth, max_iter), ready.split


def run_table(spark, runs: Sequence[dict]) -> DataFrame:
    """One row per run with parameters, metrics and signature."""
    rows = [
        (r["model_name"], r["run_id"], r["params"], r["metrics"], r["input_schema"], r["output_schema"], r["input_example"], r["path"])
        for r in runs
    ]
    return spark.createDataFrame(
        rows,
        "model_name string, run_id string, params map<string,string>, metrics map<string,double>,"
        "input_schema string, output_schema string, input_example array<string>, path string",
    )


def performance(spark, runs: Sequence[dict]) -> DataFrame:
    """Model performance table, best first."""
    rows = [(r["model_name"], r["run_id"], *[float(r["metrics"][m]) for m in METRICS]) for r in runs]
    schema = "model_name string, run_id string," + ",".join(f"{m} double" for m in METRICS)
    table = spark.createDataFrame(rows, schema)
    return table.withColumn("evaluation_timestamp", F.current_timestamp()).orderBy(
        F.col("roc_auc").desc(), "model_name"
    )


def publish(run: dict, features: DataFrame | None = None) -> DataFrame:
    """Predictions for all customers, banded and rounded for publishing.

    ``split`` tells the rows that the model was fitted on (train) from those that it was evaluated
    on (test). Without ``features`` the run's own encoded rows are scored; rows of another table
    are found by their id, and are ``unseen`` if the run has not met it.
    """
    own = run["model"].encoding.dictionary.sparkSession.read.parquet(run["rows"])
    if features is None:
        rows = own.drop("weight")
    else:
        rows = prepared(features).join(own.select(KEY, "is_test"), KEY, "left")
    scored = score(run["model"], rows)
    which = F.when(F.col("is_test") == 1, "test").when(F.col("is_test") == 0, "train").otherwise("unseen")
    return scoring.predictions(
        scored, F.col("probability"), run["model_name"], run["run_id"], F.col("predicted"), [which.alias("split")]
    ).withColumn("prediction_timestamp", F.current_timestamp())


def importance(spark, run: dict, sample: DataFrame | None = None) -> DataFrame:
    """Impurity importances, or absolute coefficients of a linear model."""
    classifier = run["model"].classifier
    if hasattr(classifier, "featureImportances"):
        values = classifier.featureImportances.toArray()
    else:
        values = abs(classifier.coefficients.toArray())
    rows = spark.createDataFrame([(k, float(v)) for k, v in enumerate(values)], "place long, importance double")
    return run["model"].encoding.names().join(rows, "place").select("feature_name", "importance").orderBy(
        F.col("importance").desc(), "feature_name"
    )
