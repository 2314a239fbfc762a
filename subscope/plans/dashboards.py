"""The grouped queries behind the executive dashboard (Q1-Q24)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.plans import measures as M
from subscope.plans.context import FilterContext, StarModel
from subscope.sources import lookups

ALL = FilterContext()


def _ranked(df: DataFrame, value: str) -> DataFrame:
    """Largest value first; ties by the group columns."""
    keys = [F.col(n) for n, kind in df.dtypes if n != value and kind == "string"]
    return df.orderBy(F.col(value).desc_nulls_last(), *keys)


def _by(value, names, by):
    return lambda model, ctx=ALL: _ranked(M.query(model, names, by, ctx), value)


def _card(*names):
    return lambda model, ctx=ALL: M.query(model, list(names), (), ctx)


def q1_outstanding_tree(model: StarModel, ctx: FilterContext = ALL) -> DataFrame:
    levels = ["dim_customer.payment_method", "dim_customer.tenure_segment", "dim_customer.contract_type"]
    return _ranked(M.drill_down(model, "outstanding_revenue", levels, ctx), "outstanding_revenue")


def q8_priority_status(model: StarModel, ctx: FilterContext = ALL) -> DataFrame:
    """Complaints by priority and status with the status share inside each priority."""
    by = ["complaints.priority", "complaints.complaint_status"]
    counts = M.query(model, ["total_complaints"], by, ctx)
    shares = M.share_of_parent(counts, "total_complaints", ["priority"])
    order = lookups.priorities(SparkSession.getActiveSession())
    return shares.join(F.broadcast(order), "priority").orderBy("priority_sort", "complaint_status")


def q17_monthly_collection(model: StarModel, ctx: FilterContext = ALL) -> DataFrame:
    names = ["collected_revenue", "outstanding_revenue", "collection_rate_pct"]
    by = ["dim_date.year_month", "dim_date.year_month_sort"]
    return M.query(model, names, by, ctx).orderBy("year_month_sort")


def q18_date_range(model: StarModel, ctx: FilterContext = ALL) -> DataFrame:
    return model.dates(ctx).agg(
        F.min("full_date").alias("first_date"),
        F.max("full_date").alias("last_date"),
        F.count("full_date").alias("days"),
    )


def q20_invoice_funnel(model: StarModel, ctx: FilterContext = ALL) -> DataFrame:
    stages = lookups.funnel_stages(SparkSession.getActiveSession())
    return M.funnel(model, stages, ctx).orderBy("stage_order")


LOCATION = [f"dim_network_location.{c}" for c in ("region", "latitude", "longitude", "location_label")]

QUERIES = {
    "q1_a21_outstanding_tree": q1_outstanding_tree,
    "q2_status_by_contract": _by(
        "active_customers", ["active_customers", "churned_customers"], ["dim_customer.contract_type"]
    ),
    "q3_prediction_outcomes": _by("scored_customers", ["scored_customers"], ["predictions.prediction_outcome"]),
    "q4_incident_map": _by("network_incidents", ["network_incidents"], LOCATION),
    "q5_speed_latency_by_region": _by(
        "average_download_speed_mbps",
        ["average_download_speed_mbps", "average_latency_ms"],
        ["network.region"],
    ),
    "q6_event_types": _by("total_network_events", ["total_network_events"], ["network.event_type"]),
    "q7_service_mix": _by(
        "internet_service_mix_pct",
        ["internet_service_mix_pct"],
        ["dim_customer.contract_type", "dim_customer.internet_service"],
    ),
    "q8_priority_status": q8_priority_status,
    "q9_customer_status": _by("total_customers", ["total_customers"], ["dim_customer.customer_status"]),
    "q10_affected_by_region": _by(
        "incident_affected_customers",
        ["incident_affected_customers", "average_packet_loss_pct"],
        ["network.region"],
    ),
    "q11_risk_by_action": _by(
        "predicted_revenue_at_risk",
        ["predicted_revenue_at_risk"],
        ["retention.recommended_action", "retention.retention_priority"],
    ),
    "q12_network_health": _card("network_health_score"),
    "q13_risk_distribution": _by("scored_customers", ["scored_customers"], ["predictions.risk_category"]),
    "q14_high_risk_active": _card("high_risk_active_customers"),
    "q15_total_customers": _card("total_customers"),
    "q16_complaints_by_category": _by(
        "total_complaints",
        ["total_complaints", "average_resolution_hours"],
        ["complaints.complaint_category"],
    ),
    "q17_monthly_collection": q17_monthly_collection,
    "q18_date_range": q18_date_range,
    "q19_complaint_status": _by("total_complaints", ["total_complaints"], ["complaints.complaint_status"]),
    "q20_invoice_funnel": q20_invoice_funnel,
    "q21_retention_by_tenure": _by(
        "active_customer_rate_pct",
        ["active_customer_rate_pct", "actual_churn_rate_pct"],
        ["dim_customer.tenure_segment"],
    ),
    "q22_sla_gauge": _card(
        "sla_compliance_48h_pct", "sla_target_pct", "sla_gauge_minimum", "sla_gauge_maximum"
    ),
    "q23_billed_by_status": _by("total_billed_revenue", ["total_billed_revenue"], ["billing.payment_status"]),
    "q24_active_mrr": _card("active_mrr"),
}
