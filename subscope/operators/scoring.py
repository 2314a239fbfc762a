"""Rule-based risk, value and retention scoring."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscope.functions import columns as C
from subscope.operators import stats

# Labels and thresholds of the business rules.
RISK_BANDS = [(70, "Critical"), (50, "High"), (30, "Medium")]
VALUE_BANDS = [(80, "High Value"), (40, "Medium Value")]
PROBABILITY_BANDS = [(0.30, "Low"), (0.50, "Medium"), (0.70, "High")]
RISK_CAP = 100.0
CONTRACT_POINTS = {"month-to-month": 20.0, "other": 5.0}
TENURE_POINTS = [(12, 15.0), (24, 10.0)]
TENURE_LONG_POINTS = 3.0
# points of one unit, and the most that a kind of issue can add
ISSUE_POINTS = {"payment": (8.0, 20.0), "complaint": (3.0, 20.0), "network": (0.25, 25.0)}
PAYMENT_ACTION = "Payment support and retention offer"
COMPLAINT_ACTION = "Resolve open complaints immediately"
NETWORK_ACTION = "Network investigation and service credit"
CONTRACT_ACTION = "Offer long-term contract discount"
DEFAULT_ACTION = "Standard engagement"


def _monthly_contract() -> Column:
    return F.lower("contract_type") == "month-to-month"


def _points(rules: list[tuple[Column, float]], default: float) -> Column:
    return C.first_match([(rule, F.lit(points)) for rule, points in rules], F.lit(default))


def risk_score() -> Column:
    """Points for contract and tenure, and capped points per issue, in all at most ``RISK_CAP``."""
    contract = _points([(_monthly_contract(), CONTRACT_POINTS["month-to-month"])], CONTRACT_POINTS["other"])
    tenure = _points([(F.col("tenure_months") <= limit, points) for limit, points in TENURE_POINTS], TENURE_LONG_POINTS)
    lost_quality = F.when(F.col("has_network_events") == 1, F.lit(100.0) - F.col("network_quality_score")).otherwise(0.0)
    units = {"payment": F.col("payment_issue_count"), "complaint": F.col("complaint_severity_score"), "network": lost_quality}
    issues = [F.least(units[name] * each, F.lit(cap)) for name, (each, cap) in ISSUE_POINTS.items()]
    return F.least(F.lit(RISK_CAP), reduce(Column.__add__, issues, contract + tenure))


def recommended_action(guard_missing: bool = False) -> Column:
    """First rule that applies.

    Customers without network events carry quality 0 after the zero fill and so match the
    network rule; ``guard_missing`` restricts that rule to customers with events.
    """
    poor_network = F.col("network_quality_score") < 60
    if guard_missing:
        poor_network = poor_network & (F.col("has_network_events") == 1)
    return C.first_match(
        [
            (F.col("unpaid_invoice_count") > 0, PAYMENT_ACTION),
            (F.col("unresolved_complaint_count") > 0, COMPLAINT_ACTION),
            (poor_network, NETWORK_ACTION),
            (_monthly_contract(), CONTRACT_ACTION),
        ],
        DEFAULT_ACTION,
    )


def churn_analytics(customer_360: DataFrame, guard_missing: bool = False) -> DataFrame:
    """Customer-360 with risk, value segment, revenue attribution and action."""
    scored = customer_360.withColumn("risk_score", risk_score())
    banded = scored.withColumn("risk_category", C.band_from("risk_score", RISK_BANDS, "Low"))
    charge = F.col("monthly_charges")
    return banded.withColumns(
        {
            "customer_value_segment": C.band_from("monthly_charges", VALUE_BANDS, "Low Value"),
            "actual_churn_revenue": F.when(F.col("churn_label") == 1, charge).otherwise(0.0),
            "business_risk_revenue": F.when(
                F.col("risk_category").isin("High", "Critical"), charge
            ).otherwise(0.0),
            "recommended_action": recommended_action(guard_missing),
        }
    )


def probability_band(p: str | Column) -> Column:
    """Right-closed bands on the unrounded probability."""
    return C.band_upto(p, PROBABILITY_BANDS, "Critical")


def predictions(
    df: DataFrame, probability: Column, model_name: str, run_id: str, predicted: Column | None = None, more: Sequence[Column] = ()
) -> DataFrame:
    """Publishable predictions (L13): band first, then round the probability to 4 digits."""
    scored = df.withColumn("_p", probability)
    label = predicted if predicted is not None else C.flag(F.col("_p") >= 0.5)
    return scored.select(
        "customer_id",
        F.col("churn_label").alias("actual_churn_label"),
        label.alias("predicted_churn_label"),
        F.round("_p", 4).alias("churn_probability"),
        probability_band("_p").alias("risk_category"),
        F.lit(model_name).alias("model_name"),
        F.lit(run_id).alias("run_id"),
        *more,
    )


def rule_based_predictions(analytics: DataFrame) -> DataFrame:
    """The risk score read as a probability: the baseline every trained model has to beat."""
    return predictions(analytics, F.col("risk_score") / 100, "Risk score baseline", "rules")


def with_outcome(predicted: DataFrame) -> DataFrame:
    return predicted.withColumn(
        "prediction_outcome", stats.outcome_label("actual_churn_label", "predicted_churn_label")
    )


RETENTION_COLUMNS = [
    "contract_type",
    "internet_service",
    "payment_method",
    "tenure_months",
    "monthly_charges",
    "total_charges",
    "payment_issue_count",
    "complaint_count",
    "unresolved_complaint_count",
    "average_satisfaction_score",
    "average_latency_ms",
    "average_packet_loss_pct",
    "total_outage_minutes",
    "network_quality_score",
    "recommended_action",
]


def retention_list(analytics: DataFrame, predicted: DataFrame) -> DataFrame:
    """Analytics joined with predictions, revenue at risk and retention priority.

    Both sides are unique by customer, so the join is one to one and cannot skew.
    """
    scores = predicted.select(
        "customer_id",
        F.col("predicted_churn_label").alias("predicted_churn"),
        "churn_probability",
        F.col("risk_category").alias("ml_risk_category"),
    )
    p, charge = F.col("churn_probability"), F.col("monthly_charges")
    joined = analytics.select("customer_id", *RETENTION_COLUMNS).join(scores, "customer_id")
    return joined.withColumns(
        {
            "predicted_revenue_at_risk": F.when(F.col("predicted_churn") == 1, charge).otherwise(0.0),
            "retention_priority": C.first_match(
                [
                    ((p >= 0.70) & (charge >= 80), "P1 - Immediate"),
                    (p >= 0.70, "P2 - Urgent"),
                    (p >= 0.50, "P3 - Monitor"),
                ],
                "P4 - Standard",
            ),
        }
    )


def top_retention(retention: DataFrame, n: int = 20) -> DataFrame:
    """The most urgent customers (T5), ties settled by id."""
    return retention.orderBy(
        F.col("churn_probability").desc(), F.col("monthly_charges").desc(), F.col("customer_id")
    ).limit(n)
