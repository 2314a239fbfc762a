import datetime as dt

import pytest
from pyspark.sql import functions as F

from subscope.functions import columns as C
from subscope.plans import dashboards, measures as M
from subscope.plans.context import FilterContext, StarModel
from subscope.sources import calendars, lookups


@pytest.fixture(scope="module")
def star(spark):
    """Five customers, one of them unscored, invoices over a gap and a year end, one orphan."""
    dim = spark.createDataFrame(
        [("C1", 0, "Two year", "DSL", 100.0, 10), ("C2", 0, "Two year", "DSL", 20.0, 30), ("C3", 1, "One year", "DSL", 50.0, 50),
         ("C4", 0, "One year", "Fiber optic", 60.0, None), ("C5", 1, "One year", "Unknown", 70.0, 1)],
        "customer_id string, churn_label int, contract_type string, internet_service string, monthly_charges double, tenure_months int",
    )
    predictions = spark.createDataFrame(
        [("C1", 0, 1, 0.9, "Critical"), ("C2", 0, 0, 0.2, "Low"), ("C3", 1, 0, 0.4, "Medium"), ("C4", 0, 1, 0.7, "High")],
        "customer_id string, actual_churn_label int, predicted_churn_label int, churn_probability double, risk_category string",
    )
    d = dt.date
    billing = spark.createDataFrame(
        [("C1", d(2025, 11, 1), 100.0, 0, 1, 0), ("C1", d(2026, 1, 1), 50.0, 1, 0, 0), ("C2", d(2026, 1, 1), 30.0, 0, 1, 0),
         ("C3", d(2025, 12, 1), 10.0, 0, 0, 1), ("C9", d(2026, 1, 1), 5.0, 0, 1, 0)],
        "customer_id string, billing_month date, total_amount double, is_unpaid int, is_paid int, is_late int",
    ).withColumns({"month_key": C.month_key("billing_month"), "discount_amount": F.lit(0.0), "monthly_charges": F.lit(0.0),
                   "usage_charges": F.lit(0.0), "payment_status": F.when(F.col("is_unpaid") == 1, "unpaid").otherwise("paid")})
    ts = lambda *a: dt.datetime(*a)
    complaints = spark.createDataFrame(
        [("C1", ts(2025, 12, 31, 23), "critical", "closed", 10.0, 3, 1, 0, 0), ("C1", ts(2026, 1, 5), "low", "escalated", 60.0, 1, 0, 1, 1),
         ("C2", ts(2026, 1, 31), "low", "closed", 48.0, 5, 0, 0, 0), ("C3", ts(2026, 1, 31), None, "closed", 49.0, 5, 0, 0, 0)],
        "customer_id string, opened_at timestamp, priority string, complaint_status string, resolution_hours double,"
        "satisfaction_score int, is_critical int, is_escalated int, is_unresolved int",
    ).withColumn("month_key", C.month_key("opened_at"))
    network = spark.createDataFrame(
        [("C1", ts(2026, 1, 1), "normal", "Bay Area", 201, 20.0, 1.0, 90.0, 0, 0, 0), ("C1", ts(2026, 1, 2), "Outage", "Bay Area", 201, 400.0, 20.0, 200.0, 30, 1, 1)],
        "customer_id string, event_timestamp timestamp, event_type string, region string, location_key long, latency_ms double,"
        "packet_loss_pct double, download_speed_mbps double, outage_minutes int, is_outage int, is_degraded int",
    ).withColumn("month_key", C.month_key("event_timestamp"))
    facts = {"billing": (billing, "billing_month"), "complaints": (complaints, "opened_at"), "network": (network, "event_timestamp")}
    tables = {
        "dim_customer": dim, "predictions": predictions, "billing": billing, "complaints": complaints, "network": network,
        "dim_network_location": lookups.locations(spark), "fact_days": calendars.fact_days(facts),
        "dim_date": calendars.date_dimension(calendars.spine(spark, "2025-01-01", "2026-12-31")),
    }
    return StarModel(tables.__getitem__)


def one(star, *names, ctx=FilterContext()):
    return M.query(star, list(names), ctx=ctx).first().asDict()


def by(star, names, keys, ctx=FilterContext()):
    out = M.query(star, names, keys, ctx)
    n = len(keys)
    return {tuple(r)[:n] if n > 1 else r[0]: tuple(r)[n:] for r in out.collect()}


def test_customer_measures(star):
    assert one(star, "total_customers", "active_customers", "churned_customers", "active_mrr", "scored_customers") == {
        "total_customers": 5, "active_customers": 3, "churned_customers": 2, "active_mrr": 180.0, "scored_customers": 4}
    got = one(star, "risk_adjusted_arr_exposure", "high_risk_active_mrr", "expected_active_churners", "prediction_coverage_pct", "average_customer_tenure_months")
    assert got["risk_adjusted_arr_exposure"] == pytest.approx((0.9 * 100 + 0.2 * 20 + 0.7 * 60) * 12)
    assert (got["high_risk_active_mrr"], got["prediction_coverage_pct"], got["average_customer_tenure_months"]) == (160.0, 0.8, 22.75)
    assert got["expected_active_churners"] == pytest.approx(1.8)


def test_threshold_follows_the_context(star):
    # overall ARPU is 60, so C1 and C4 qualify; each group uses its own ARPU
    assert one(star, "high_value_high_risk_customers") == {"high_value_high_risk_customers": 2}
    assert by(star, ["high_value_high_risk_customers"], ["dim_customer.contract_type"]) == {"Two year": (1,), "One year": (1,)}


def test_three_high_risk_definitions_stay_apart(star):
    assert one(star, "high_risk_active_customers", "critical_risk_active_customers") == {
        "high_risk_active_customers": 2, "critical_risk_active_customers": 1}


def test_orphans_form_a_blank_member_and_leave_under_a_filter(star):
    assert by(star, ["total_billed_revenue"], ["dim_customer.contract_type"]) == {"Two year": (180.0,), "One year": (10.0,), None: (5.0,)}
    ctx = FilterContext(filters={"dim_customer.contract_type": ["Two year", "One year"]})
    assert one(star, "total_billed_revenue", ctx=ctx) == {"total_billed_revenue": 190.0}


def test_billing_sides_add_up(star):
    got = one(star, "collected_revenue", "outstanding_revenue", "total_billed_revenue", "collected_invoices", "total_invoices")
    assert got["collected_revenue"] + got["outstanding_revenue"] == got["total_billed_revenue"] == 195.0
    assert (got["collected_invoices"], got["total_invoices"]) == (4, 5)


def test_complaint_measures(star):
    got = one(star, "sla_compliance_48h_pct", "average_resolution_hours", "repeat_complainer_rate_pct", "customers_with_complaints", "complaints_per_1k_customers")
    assert got["sla_compliance_48h_pct"] == pytest.approx(2 / 3)
    assert got["average_resolution_hours"] == pytest.approx(107 / 3)
    assert got["repeat_complainer_rate_pct"] == pytest.approx(1 / 3)
    assert (got["customers_with_complaints"], got["complaints_per_1k_customers"]) == (3, 800.0)


def test_network_health(star):
    got = one(star, "network_health_score", "incident_affected_customers", "network_incidents")
    assert got["network_health_score"] == pytest.approx(0.4 * 50 + 0.25 * 0 + 0.2 * 0 + 0.15 * 100)
    assert (got["incident_affected_customers"], got["network_incidents"]) == (1, 1)


def test_empty_selection_is_blank_or_reads_as_zero(star):
    ctx = FilterContext(filters={"network.region": ["Mars"]})
    got = one(star, "network_health_score", "network_health_blank_as_zero", "average_outage_duration_minutes", "network_incident_rate_pct", ctx=ctx)
    assert got["network_health_blank_as_zero"] == 85.0
    assert got["network_health_score"] is got["average_outage_duration_minutes"] is got["network_incident_rate_pct"] is None


def test_month_windows_at_the_last_data(star):
    got = one(star, "billed_revenue_latest_month", "billed_revenue_previous_month", "billed_revenue_mom_pct", "billed_revenue_rolling_3m_average", "billed_revenue_ytd")
    assert got == {"billed_revenue_latest_month": 85.0, "billed_revenue_previous_month": 10.0, "billed_revenue_mom_pct": 7.5,
                   "billed_revenue_rolling_3m_average": 65.0, "billed_revenue_ytd": 85.0}


def test_month_windows_at_the_calendar_end(star):
    ctx = FilterContext(anchor="calendar")
    assert one(star, "billed_revenue_latest_month", "revenue_trend_label", "revenue_trend_color", ctx=ctx) == {
        "billed_revenue_latest_month": None, "revenue_trend_label": "No prior month", "revenue_trend_color": M.GOOD}


def test_anchor_follows_the_selected_range(star):
    ctx = FilterContext(date_to="2025-12-15")
    got = one(star, "billed_revenue_latest_month", "billed_revenue_previous_month", "billed_revenue_ytd", "total_billed_revenue", ctx=ctx)
    assert got == {"billed_revenue_latest_month": 10.0, "billed_revenue_previous_month": 100.0, "billed_revenue_ytd": 110.0, "total_billed_revenue": 110.0}


def test_month_windows_refuse_a_date_axis(star):
    with pytest.raises(ValueError, match="series"):
        M.query(star, ["billed_revenue_ytd"], ["dim_date.year"])


def test_unreachable_group_is_refused(star):
    with pytest.raises(ValueError, match="grouped by"):
        M.query(star, ["total_customers"], ["billing.payment_status"])


def test_condition_replaces_the_selection_on_its_column(star):
    assert by(star, ["total_customers", "active_customers"], ["dim_customer.churn_label"]) == {0: (3, 3), 1: (2, 3)}
    ctx = FilterContext(filters={"dim_customer.churn_label": [1]})
    assert one(star, "total_customers", "active_customers", ctx=ctx) == {"total_customers": 2, "active_customers": 3}


def test_only_replaced_measures_by_their_own_column(star):
    assert by(star, ["active_customers"], ["dim_customer.churn_label"]) == {0: (3,), 1: (3,)}


def test_share_ignores_the_selection_of_its_own_column(star):
    keys = ["dim_customer.contract_type", "dim_customer.internet_service"]
    got = by(star, ["internet_service_mix_pct"], keys)
    assert got[("Two year", "DSL")] == (1.0,) and got[("One year", "Unknown")] == (pytest.approx(1 / 3),)


def test_selection_travels_from_predictions_to_facts(star):
    ctx = FilterContext(filters={"predictions.risk_category": ["Critical"]})
    assert one(star, "total_billed_revenue", "total_customers", "total_complaints", ctx=ctx) == {
        "total_billed_revenue": 150.0, "total_customers": 1, "total_complaints": 2}


def test_null_can_be_selected(star):
    ctx = FilterContext(filters={"complaints.priority": [None, "critical"]})
    assert one(star, "total_complaints", ctx=ctx) == {"total_complaints": 2}


def test_dimension_measure_repeats_on_fact_groups(star):
    got = by(star, ["total_complaints", "total_customers"], ["complaints.priority"])
    assert got == {"critical": (1, 5), "low": (2, 5), None: (1, 5)}


def test_drill_across_keeps_groups_of_every_table(star):
    got = by(star, ["total_customers", "total_invoices", "total_complaints"], ["dim_customer.contract_type"])
    assert got == {"Two year": (2, 3, 3), "One year": (3, 1, 1), None: (None, 1, None)}


def test_series_counts_empty_months(star):
    rows = M.series(star, "total_billed_revenue", ctx=FilterContext("2025-10-01", "2026-02-28")).collect()
    line = {r.year_month: r for r in rows}
    assert list(line) and sorted(line) == ["2025-10", "2025-11", "2025-12", "2026-01", "2026-02"]
    assert [line[m].value for m in sorted(line)] == [None, 100.0, 10.0, 85.0, None]
    assert (line["2025-10"].previous_month, line["2025-11"].mom_pct, line["2026-02"].previous_month) == (None, None, 85.0)
    assert line["2026-01"].rolling_3m_average == pytest.approx(65.0)
    assert line["2026-02"].rolling_3m_average == pytest.approx(95 / 3)
    assert (line["2025-12"].year_to_date, line["2026-01"].year_to_date, line["2026-02"].year_to_date) == (110.0, 85.0, 85.0)


def test_series_agrees_with_the_windows_at_each_anchor(star):
    line = {r.year_month: r for r in M.series(star, "total_billed_revenue").collect()}
    for last, month in (("2025-11-30", "2025-11"), ("2025-12-31", "2025-12"), ("2026-01-31", "2026-01")):
        got = one(star, "billed_revenue_latest_month", "billed_revenue_previous_month", "billed_revenue_ytd", "billed_revenue_rolling_3m_average",
                  ctx=FilterContext(date_to=last, anchor="calendar"))
        row = line[month]
        assert (row.value, row.previous_month, row.year_to_date) == tuple(list(got.values())[:3])
        assert row.rolling_3m_average == pytest.approx(got["billed_revenue_rolling_3m_average"])


def test_labels(star):
    got = one(star, "selected_period_label", "latest_visible_month_label", "executive_subtitle", "churn_risk_status", "customer_overview_subtitle",
              ctx=FilterContext("2025-02-01", "2026-03-09"))
    assert got == {
        "selected_period_label": "01 Feb 2025 — 09 Mar 2026", "latest_visible_month_label": "Mar 2026",
        "executive_subtitle": "01 Feb 2025 — 09 Mar 2026  |  5 customers", "churn_risk_status": "Critical",
        "customer_overview_subtitle": "Average Tenure: 22.8 Months"}


def test_drill_down_leaves_sum_to_the_total(star):
    rows = M.drill_down(star, "total_billed_revenue", ["dim_customer.contract_type", "billing.payment_status"]).collect()
    total = [r.total_billed_revenue for r in rows if r.depth == 0]
    assert total == [195.0]
    for depth in (1, 2):
        assert sum(r.total_billed_revenue for r in rows if r.depth == depth) == 195.0


def test_latest_best_model_and_driver(spark):
    t = dt.datetime
    performance = spark.createDataFrame(
        [("old", t(2025, 1, 1), 0.99, 0.9, 0.9, 0.9, 0.9), ("a", t(2026, 1, 1), 0.7, 0.1, 0.1, 0.1, 0.1), ("b", t(2026, 1, 1), 0.8, 0.2, 0.3, 0.4, 0.5)],
        "model_name string, evaluation_timestamp timestamp, roc_auc double, accuracy double, precision double, recall double, f1_score double")
    importance = spark.createDataFrame([("z", 0.4), ("m", 0.4), ("a", 0.1)], "feature_name string, importance double")
    got = M.model_measures(performance, importance).first()
    assert (got.latest_best_model, got.latest_model_roc_auc_pct, got.top_churn_driver, got.top_driver_importance_pct) == ("b", 0.8, "m", 0.4)


def test_every_numbered_measure_is_defined():
    special = {82, 83, 84, 85, 86, 87, 90, 91, 107}
    assert set(M.MEASURES) | special == set(range(1, 111))
    assert len(dashboards.QUERIES) == 24
