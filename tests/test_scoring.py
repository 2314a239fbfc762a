import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from subscope.operators import rollup, scoring, star, stats

SCHEMA = (
    "contract_type string, tenure_months int, payment_issue_count int, complaint_severity_score int,"
    "has_network_events int, network_quality_score double, monthly_charges double, churn_label int,"
    "unpaid_invoice_count int, unresolved_complaint_count int"
)


def analytics(spark, *data, **options):
    return scoring.churn_analytics(spark.createDataFrame(data, SCHEMA), **options)


def row(contract="Two year", tenure=60, issues=0, severity=0, events=1, quality=100.0, charge=50.0, churn=0, unpaid=0, unresolved=0):
    return (contract, tenure, issues, severity, events, quality, charge, churn, unpaid, unresolved)


@pytest.mark.parametrize(
    "data, score, band",
    [
        (row(), 8.0, "Low"),
        (row("MONTH-TO-MONTH", 12, 3, 7, 1, 0.0), 100.0, "Critical"),
        (row("Month-to-month", 12, 3, 0, 1, 40.0), 70.0, "Critical"),
        (row("Month-to-month", 24, 0, 0, 1, 100.0), 30.0, "Medium"),
        (row("Month-to-month", 25, 9, 0, 0, 0.0), 43.0, "Medium"),
        (row("Month-to-month", 24, 9, 0, 0, 0.0), 50.0, "High"),
        (row(issues=1, severity=1), 19.0, "Low"),
        (row(tenure=None), 8.0, "Low"),
    ],
)
def test_risk_score_and_band(spark, data, score, band):
    got = analytics(spark, data).first()
    assert (got.risk_score, got.risk_category) == (score, band)


@pytest.mark.parametrize(
    "data, action",
    [
        (row(unpaid=1, unresolved=1), scoring.PAYMENT_ACTION),
        (row(unresolved=1, quality=10.0), scoring.COMPLAINT_ACTION),
        (row(quality=59.99, contract="Month-to-month"), scoring.NETWORK_ACTION),
        (row(quality=60.0, contract="month-to-month"), scoring.CONTRACT_ACTION),
        (row(), scoring.DEFAULT_ACTION),
        (row(events=0, quality=0.0), scoring.NETWORK_ACTION),
    ],
)
def test_first_matching_action(spark, data, action):
    assert analytics(spark, data).first().recommended_action == action


def test_network_rule_can_require_events(spark):
    got = analytics(spark, row(events=0, quality=0.0), guard_missing=True).first()
    assert got.recommended_action == scoring.DEFAULT_ACTION


@pytest.mark.parametrize("charge, segment", [(39.99, "Low Value"), (40.0, "Medium Value"), (79.99, "Medium Value"), (80.0, "High Value"), (None, "Low Value")])
def test_value_segment(spark, charge, segment):
    assert analytics(spark, row(charge=charge)).first().customer_value_segment == segment


@pytest.mark.parametrize("tenure, segment", [(12, "0-12 Months"), (13, "13-24 Months"), (24, "13-24 Months"), (25, "25-48 Months"), (48, "25-48 Months"), (49, "49+ Months"), (None, "49+ Months")])
def test_tenure_segment(spark, tenure, segment):
    df = spark.createDataFrame([(tenure,)], "tenure_months int")
    assert df.select(star.tenure_segment().alias("s")).first().s == segment


@pytest.mark.parametrize("charge, segment", [(39.99, "Low Value"), (40.0, "Medium Value"), (80.0, "High Value"), (None, "High Value")])
def test_charge_segment(spark, charge, segment):
    df = spark.createDataFrame([(charge,)], "monthly_charges double")
    assert df.select(star.charge_segment().alias("s")).first().s == segment


@pytest.mark.parametrize("raw, label", [(" No ", "No Internet Service"), ("none", "No Internet Service"), (None, "Unknown"), ("DSL", "DSL"), ("", "")])
def test_service_label(spark, raw, label):
    df = spark.createDataFrame([(raw,)], "s string")
    assert df.select(star.service_label("s").alias("s")).first().s == label


@pytest.mark.parametrize("p, band, rounded", [(0.0, "Low", 0.0), (0.30, "Low", 0.3), (0.30004, "Medium", 0.3), (0.5, "Medium", 0.5), (0.69996, "High", 0.7), (0.70, "High", 0.7), (0.85, "Critical", 0.85), (1.0, "Critical", 1.0)])
def test_probability_is_banded_before_rounding(spark, p, band, rounded):
    df = spark.createDataFrame([("c", 0, p)], "customer_id string, churn_label int, p double")
    got = scoring.predictions(df, F.col("p"), "m", "r").first()
    assert (got.risk_category, got.churn_probability) == (band, rounded)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["Month-to-month", "One year"]), st.integers(0, 80), st.integers(0, 50), st.integers(0, 50), st.integers(0, 1), st.floats(0, 100)), min_size=1, max_size=20))
def test_risk_score_stays_in_range(spark, data):
    df = analytics(spark, *[row(c, t, i, s, e, q) for c, t, i, s, e, q in data])
    assert all(8 <= r.risk_score <= 100 for r in df.collect())


def _empty(spark, schema):
    return spark.createDataFrame([], schema)


def test_customers_without_facts_are_zero_filled_and_flagged(spark):
    customers = spark.createDataFrame([("C1", 1, 50.0), ("C2", 0, 20.0)], "customer_id string, churn_label int, monthly_charges double")
    billing = spark.createDataFrame([("I1", "C1", 10.0, 1.0, 0.0, 1, 0, 0, None), ("I2", "C1", 20.0, 2.0, 1.0, 0, 1, 0, None)],
        "invoice_id string, customer_id string, total_amount double, usage_charges double, discount_amount double, is_paid int, is_late int, is_unpaid int, billing_month date")
    complaints = _empty(spark, "complaint_id string, customer_id string, resolution_hours double, satisfaction_score int, is_critical int, is_escalated int, is_unresolved int, opened_at timestamp")
    network = spark.createDataFrame([("E1", "C1", "T1", 100.0, 2.0, 50.0, 5, 1, 1, None), ("E2", "C1", "T1", 100.0, 2.0, 50.0, 0, 0, 0, None)],
        "event_id string, customer_id string, tower_id string, latency_ms double, packet_loss_pct double, download_speed_mbps double, outage_minutes int, is_outage int, is_degraded int, event_timestamp timestamp")
    out = {
        r.customer_id: r
        for r in rollup.customer_360(customers, rollup.billing_summary(billing), rollup.complaints_summary(complaints), rollup.network_summary(network)).collect()
    }
    c1, c2 = out["C1"], out["C2"]
    assert (c1.invoice_count, c1.total_billed_amount, c1.payment_reliability_score, c1.payment_issue_count) == (2, 30.0, 0.5, 1)
    assert (c1.network_quality_score, c1.distinct_tower_count, c1.network_issue_rate) == (85.0, 1, 0.5)
    assert (c1.has_billing_history, c1.has_complaints, c1.has_network_events) == (1, 0, 1)
    assert (c2.invoice_count, c2.network_quality_score, c2.network_issue_rate, c2.has_network_events) == (0, 0.0, 0.0, 0)
    assert c2.latest_billing_month is None
    assert (c1.revenue_at_risk, c2.revenue_at_risk) == (50.0, 0.0)


def test_outcome_names(spark):
    df = spark.createDataFrame([(1, 1), (0, 0), (0, 1), (1, 0), (None, 1)], "a int, p int")
    assert [r.o for r in df.select(stats.outcome_label("a", "p").alias("o")).collect()] == [
        "True Positive", "True Negative", "False Positive", "False Negative", "Unknown"]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), max_size=25))
def test_median_is_exact(spark, values):
    import statistics

    df = spark.createDataFrame([(None if v is None else v / 4,) for v in values], "v double")
    present = [v / 4 for v in values if v is not None]
    want = statistics.median(present) if present else None
    assert stats.median(df, "v").first().median == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20)), min_size=2, max_size=40))
def test_auc_equals_pairwise_definition(spark, data):
    df = spark.createDataFrame([(y, s / 20) for y, s in data], "y int, s double")
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    got = stats.roc_auc(df, "y", "s", buckets=3).first().roc_auc
    if not pos or not neg:
        assert got is None
    else:
        wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert got == pytest.approx(wins / (len(pos) * len(neg)))


@pytest.mark.parametrize("n1, n0", [(7, 33), (1, 5), (0, 10), (200, 301)])
def test_split_is_exact_per_label_and_repeatable(spark, n1, n0):
    df = spark.createDataFrame([(f"k{i}", int(i < n1)) for i in range(n1 + n0)], "k string, y int")
    split = stats.stratified_split(df, "y", "k").cache()
    counts = {(r.y, r.is_test): r["count"] for r in split.groupBy("y", "is_test").count().collect()}
    for y, n in ((1, n1), (0, n0)):
        assert counts.get((y, 1), 0) == int(0.2 * n + 0.5)
    again = stats.stratified_split(df.repartition(5), "y", "k")
    assert split.exceptAll(again).count() == 0


def test_metrics_are_zero_when_undefined(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "a int, p int")
    assert stats.binary_metrics(df, "a", "p").first().asDict() == {"accuracy": 1.0, "precision": 0.0, "recall": 0.0, "f1_score": 0.0}
