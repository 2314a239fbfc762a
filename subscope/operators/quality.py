"""Quality reports, quarantine, orphan checks and row-count audits.

Every report is one aggregate over one scan, however many rules it holds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from subscope.functions import columns as C


ACCEPTED, QUARANTINED = "accepted", "quarantined"


def report(
    df: DataFrame,
    total: str,
    unique: tuple[str, str] | None = None,
    violations: Mapping[str, Column] | None = None,
    measures: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row: row count, distinct keys, violations per rule, and any further aggregates.

    A rule is violated where its condition is true; NULL is not a violation.
    """
    aggs = [F.count(F.lit(1)).alias(total)]
    if unique:
        aggs.append(F.count_distinct(F.col(unique[1])).alias(unique[0]))
    aggs += [C.count_where(c).alias(n) for n, c in (violations or {}).items()]
    aggs += [c.alias(n) for n, c in (measures or {}).items()]
    return df.agg(*aggs)


def raw_customers(df: DataFrame) -> DataFrame:
    churn = F.col("Churn")
    return report(
        df,
        "total_records",
        ("unique_customers", "customerID"),
        {
            "null_customer_ids": F.col("customerID").isNull(),
            "null_monthly_charges": F.col("MonthlyCharges").isNull(),
            "invalid_churn_values": ~churn.isin("Yes", "No") | churn.isNull(),
        },
    )


def raw_billing(df: DataFrame) -> DataFrame:
    return report(
        df,
        "total_transactions",
        ("unique_invoices", "invoice_id"),
        {
            "null_invoice_ids": F.col("invoice_id").isNull(),
            "null_customer_ids": F.col("customerID").isNull(),
            "negative_amounts": F.col("total_amount") < 0,
            "invalid_payment_status": ~F.col("payment_status").isin("Paid", "Late", "Unpaid"),
        },
        {
            "total_billed_revenue": F.round(C.total("total_amount"), 2),
            "average_invoice_value": F.round(C.mean("total_amount"), 2),
        },
    )


def raw_complaints(df: DataFrame) -> DataFrame:
    return report(
        df,
        "total_complaints",
        ("unique_complaints", "complaint_id"),
        {
            "null_complaint_ids": F.col("complaint_id").isNull(),
            "null_customer_ids": F.col("customerID").isNull(),
            "invalid_resolution_hours": F.col("resolution_hours") < 0,
            "invalid_satisfaction_scores": ~F.col("satisfaction_score").between(1, 5),
            "invalid_priorities": ~F.col("priority").isin("Low", "Medium", "High", "Critical"),
        },
        {
            "average_resolution_hours": F.round(C.mean("resolution_hours"), 2),
            "average_satisfaction_score": F.round(C.mean("satisfaction_score"), 2),
        },
    )


def raw_network(df: DataFrame) -> DataFrame:
    loss = F.col("packet_loss_pct")
    return report(
        df,
        "total_events",
        ("unique_events", "event_id"),
        {
            "null_event_ids": F.col("event_id").isNull(),
            "null_customer_ids": F.col("customerID").isNull(),
            "invalid_latency": F.col("latency_ms") < 0,
            "invalid_packet_loss": (loss < 0) | (loss > 100),
            "invalid_download_speed": F.col("download_speed_mbps") < 0,
            "invalid_outage_duration": F.col("outage_minutes") < 0,
            "total_outage_events": F.col("event_type") == "Outage",
        },
        {
            "average_latency_ms": F.round(C.mean("latency_ms"), 2),
            "average_packet_loss": F.round(C.mean("packet_loss_pct"), 2),
            "average_download_speed": F.round(C.mean("download_speed_mbps"), 2),
        },
    )


def clean_customers(df: DataFrame) -> DataFrame:
    return report(
        df,
        "total_customers",
        ("unique_customers", "customer_id"),
        {
            "null_customer_ids": F.col("customer_id").isNull(),
            "invalid_monthly_charges": F.col("monthly_charges") < 0,
            "invalid_churn_labels": ~F.col("churn_label").isin(0, 1),
        },
        {
            "average_monthly_charges": F.round(C.mean("monthly_charges"), 2),
            "average_tenure": F.round(C.mean("tenure_months"), 2),
        },
    )


def customer_360(df: DataFrame) -> DataFrame:
    return report(
        df,
        "total_rows",
        ("unique_customers", "customer_id"),
        {
            "null_customer_ids": F.col("customer_id").isNull(),
            "customers_with_billing": F.col("has_billing_history") == 1,
            "customers_with_complaints": F.col("has_complaints") == 1,
            "customers_with_network_events": F.col("has_network_events") == 1,
        },
        {
            "average_complaints": F.round(C.mean("complaint_count"), 2),
            "average_network_quality": F.round(C.mean("network_quality_score"), 2),
            "known_revenue_at_risk": F.round(C.total("revenue_at_risk"), 2),
        },
    )


def broken_rules(rules: Mapping[str, Column]) -> Column:
    """Names of the rules that a row does not pass; NULL operands do not pass."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))


def judged(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """All rows with the rules they broke and their ``outcome`` (P4). Written once, partitioned by
    the outcome, the accepted rows and the quarantine are two partitions of one pass."""
    tagged = df.withColumn("broken_rules", broken_rules(rules))
    return tagged.withColumn("outcome", F.when(F.size("broken_rules") == 0, ACCEPTED).otherwise(QUARANTINED))


def split(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and the quarantine: rejected rows with the rules they broke (P4). Both read
    ``df``, so it should be a written table; ``judged`` writes one for both."""
    tagged = judged(df, rules)
    return (
        tagged.filter(F.col("outcome") == ACCEPTED).drop("broken_rules", "outcome"),
        tagged.filter(F.col("outcome") == QUARANTINED).drop("outcome"),
    )


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rejected rows per rule, one row per rule, from one scan."""
    counts = df.agg(
        *[C.count_where(~F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()]
    )
    return counts.unpivot([], list(rules), "rule", "rejected_rows")


def orphan_counts(facts: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Rows and rows without a dimension key per fact table."""
    parts = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("total_rows"),
            F.coalesce(C.count_where(F.col(key).isNull()), F.lit(0)).alias("orphan_records"),
        )
        for name, df in facts.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key is missing from the dimension."""
    return fact.join(dim.select(key), key, "left_anti")


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    parts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("record_count"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def reconcile(df: DataFrame, eligible: Column) -> DataFrame:
    """Rows before, rows kept and rows excluded by a filter, from one scan."""
    kept = C.count_where(eligible)
    return df.agg(
        F.count(F.lit(1)).alias("source_rows"),
        kept.alias("eligible_rows"),
        (F.count(F.lit(1)) - kept).alias("excluded_rows"),
    )


def audited(df: DataFrame, name: str, columns: Sequence[Column] = ()) -> tuple[DataFrame, Observation]:
    """Count rows while they are written, without a second scan (K8)."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("record_count"), *columns), seen
