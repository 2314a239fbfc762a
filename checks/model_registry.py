"""Registered queries on the model chain: what SQL can recompute of split, encoding, run table and
published scores."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from checks.registry import ORACLE, add
from checks.views import rnd
from subscope.operators import quality
from subscope.plans import churn

# The rows that l2_stratified_split chooses, over the feature table.
_SPLIT = """SELECT customer_id, CASE WHEN rn <= quota THEN 1 ELSE 0 END AS is_test FROM
(SELECT *, ROW_NUMBER() OVER (PARTITION BY churn_label ORDER BY sha256(customer_id || '|42')) AS rn,
floor((2 * COUNT(*) OVER (PARTITION BY churn_label) + 5) / 10) AS quota FROM customers)"""
VIEWS = {
    "split_rows": _SPLIT,
    "train_rows": "SELECT a.* FROM analytics a JOIN split_rows s ON a.customer_id = s.customer_id WHERE s.is_test = 0",
    "train_numbers": " UNION ALL ".join(f"SELECT '{c}' AS name, CAST({c} AS DOUBLE) AS v FROM train_rows" for c in churn.NUMERIC),
    "train_texts": " UNION ALL ".join(f"SELECT '{c}' AS name, {k} AS place, {c} AS value FROM train_rows" for k, c in enumerate(churn.CATEGORICAL)),
    "figures": """SELECT name, m AS median, avg(COALESCE(v, m)) AS mean, stddev_pop(COALESCE(v, m)) AS deviation
        FROM (SELECT *, median(v) OVER (PARTITION BY name) AS m FROM train_numbers) GROUP BY name, m""",
    "encoded_names": f"""SELECT k AS place, 'numeric__' || name AS feature_name FROM (VALUES {", ".join(f"({k}, '{c}')" for k, c in enumerate(churn.NUMERIC))}) n(k, name)
        UNION ALL SELECT {len(churn.NUMERIC)} - 1 + ROW_NUMBER() OVER (ORDER BY place, value), 'categorical__' || name || '_' || value
        FROM (SELECT DISTINCT name, place, value FROM train_texts WHERE value IS NOT NULL)""",
}


def model(name: str, build, sql: str) -> None:
    add(name, build, sql, VIEWS)


_six = lambda c: (F.round(c, 6) + F.lit(0.0)).alias(c)  # noqa: E731 - no negative zero

model(
    "l1_features_and_label",
    lambda w: churn.prepared(w.gold("customer_ml_features")),
    f"""SELECT customer_id, churn_label, {", ".join(churn.CATEGORICAL)}, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in churn.NUMERIC)} FROM analytics""",
)
model(
    "l3_training_figures",
    lambda w: w.spark.read.parquet(f"{w.encoded().folder}/encoding/numbers").select(F.col("column").alias("name"), _six("median"), _six("mean"), _six("deviation")),
    f"""SELECT name, {rnd("median", 6)} + 0.0::DOUBLE AS median, {rnd("mean", 6)} + 0.0::DOUBLE AS mean, {rnd("deviation", 6)} + 0.0::DOUBLE AS deviation FROM figures""",
)
model(
    "l4_training_modes",
    lambda w: w.spark.read.parquet(f"{w.encoded().folder}/encoding/modes").select(F.col("column").alias("name"), "mode"),
    """SELECT name, value AS mode FROM (SELECT name, value, ROW_NUMBER() OVER (PARTITION BY name ORDER BY COUNT(*) DESC, value) AS k
    FROM train_texts WHERE value IS NOT NULL GROUP BY name, value) WHERE k = 1""",
)
model(
    "l5_encoded_names",
    lambda w: w.encoded().encoding.names(),
    "SELECT CAST(place AS BIGINT) AS place, feature_name FROM encoded_names",
)
model(
    "l3_l5_standardised_numbers",
    lambda w: w.encoded().encoding.scaled(w.encoded().split).select("customer_id", "is_test", *[_six(c) for c in churn.NUMERIC]),
    f"""SELECT a.customer_id, CAST(s.is_test AS BIGINT) AS is_test, {", ".join(
        f'''{rnd(f"(COALESCE(CAST({c} AS DOUBLE), (SELECT median FROM figures WHERE name = '{c}')) - (SELECT mean FROM figures WHERE name = '{c}')) / COALESCE(NULLIF((SELECT deviation FROM figures WHERE name = '{c}'), 0), 1)", 6)} + 0.0::DOUBLE AS {c}'''
        for c in churn.NUMERIC
    )} FROM analytics a JOIN split_rows s ON a.customer_id = s.customer_id""",
)
model(
    "l6_training_weights",
    lambda w: w.spark.read.parquet(w.encoded().rows).filter("is_test = 0").select("customer_id", "churn_label", "weight"),
    """SELECT customer_id, churn_label, CAST(COUNT(*) OVER () AS DOUBLE) / (2 * COUNT(*) OVER (PARTITION BY churn_label)) AS weight FROM train_rows""",
)
model(
    "l10_run_table",
    lambda w: w.models()["ml_runs"].select(
        "model_name", F.col("params")["algorithm"].alias("algorithm"), F.col("params")["class_weight"].alias("class_weight"),
        F.array_join(F.array_sort(F.map_keys("metrics")), ",").alias("metrics"), F.size("input_example").alias("examples"), (F.length("run_id") > 0).cast("int").alias("has_id"),
    ),
    """SELECT * FROM (VALUES ('Logistic Regression', 'LogisticRegression', 'balanced', 'accuracy,f1_score,precision,recall,roc_auc', 5::BIGINT, 1::BIGINT),
    ('Random Forest', 'RandomForest', 'balanced', 'accuracy,f1_score,precision,recall,roc_auc', 5::BIGINT, 1::BIGINT)) r(model_name, algorithm, class_weight, metrics, examples, has_id)""",
)


def _evaluated(w):
    """Each run's logged metrics against counts of its own test scores, and its AUC against another
    implementation of it."""
    rows = []
    w.models()
    for run in w._runs:
        scores = w.spark.read.parquet(f"{run['path']}/test_scores")
        hits = {(r["churn_label"], r["predicted"]): r["count"] for r in scores.groupBy("churn_label", "predicted").count().collect()}
        tp, fp, fn, tn = (hits.get(k, 0) for k in ((1, 1), (0, 1), (1, 0), (0, 0)))
        auc = BinaryClassificationEvaluator(rawPredictionCol="probability", labelCol="churn_label", numBins=0).evaluate(scores.withColumn("churn_label", F.col("churn_label").cast("double")))
        want = {"accuracy": (tp + tn) / max(1, tp + fp + fn + tn), "precision": tp / max(1, tp + fp), "recall": tp / max(1, tp + fn), "f1_score": 2 * tp / max(1, 2 * tp + fp + fn), "roc_auc": auc}
        rows.append((run["model_name"], tp + fn, tn + fp, int(all(abs(run["metrics"][m] - v) < 1e-9 for m, v in want.items()))))
    return w.spark.createDataFrame(rows, "model_name string, churned long, stayed long, metrics_agree int")


model(
    "l8_l15_evaluation",
    _evaluated,
    """SELECT model_name, CAST(SUM(churn_label) AS BIGINT) AS churned, CAST(SUM(1 - churn_label) AS BIGINT) AS stayed, 1::BIGINT AS metrics_agree
    FROM customers c JOIN split_rows s ON c.customer_id = s.customer_id, (VALUES ('Logistic Regression'), ('Random Forest')) m(model_name)
    WHERE s.is_test = 1 GROUP BY model_name""",
)
model(
    "l11_t6_best_model",
    lambda w: (lambda p, t: t.agg(F.max("roc_auc").alias("best")).join(t.join(p.select("model_name").distinct(), "model_name"), F.col("best") == F.col("roc_auc"))
        .agg(F.count("*").alias("published_best_models")))(w.models()["ml_predictions"], w.models()["ml_model_performance"]),
    "SELECT CAST(1 AS BIGINT) AS published_best_models",
)
model(
    "l12_train_and_test_rows",
    lambda w: w.models()["ml_predictions"].select("customer_id", "actual_churn_label", "split"),
    """SELECT c.customer_id, c.churn_label AS actual_churn_label, CASE s.is_test WHEN 1 THEN 'test' ELSE 'train' END AS split
    FROM customers c JOIN split_rows s ON c.customer_id = s.customer_id""",
)
model(
    "l16_t8_importance_names",
    lambda w: w.models()["ml_feature_importance"].select("feature_name", (F.col("importance") >= 0).cast("int").alias("valid")),
    "SELECT feature_name, 1::BIGINT AS valid FROM encoded_names",
)
model(
    "k7_layer_tables",
    lambda w: (w.silver("customer_360"), w.gold("customer_churn_analytics"), w.store.listing())[2].filter(
        F.col("table_name").isin("customers_clean", "billing_clean", "complaints_clean", "network_events_clean", "customer_360", "customer_churn_analytics")
    ),
    """SELECT * FROM (VALUES ('silver', 'customers_clean'), ('silver', 'billing_clean'), ('silver', 'complaints_clean'),
    ('silver', 'network_events_clean'), ('silver', 'customer_360'), ('gold', 'customer_churn_analytics')) t(layer, table_name)""",
)
model(
    "k6_layer_schemas",
    lambda w: w.spark.createDataFrame([(layer, int(w.spark.catalog.databaseExists(w.store.database(layer)))) for layer in ("bronze", "silver", "gold")], "layer string, present int"),
    "SELECT * FROM (VALUES ('bronze', 1::BIGINT), ('silver', 1::BIGINT), ('gold', 1::BIGINT)) t(layer, present)",
)
model(
    "a18_gold_counts",
    lambda w: quality.layer_counts({n: w.gold(n) for n in ("customer_churn_analytics", "fact_billing", "fact_complaints", "fact_network_events", "dim_customer")}),
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS record_count FROM {v}"
        for n, v in [("customer_churn_analytics", "analytics"), ("fact_billing", "billing"), ("fact_complaints", "complaints"), ("fact_network_events", "network"), ("dim_customer", "dim_customer")]
    ),
)
assert ORACLE
