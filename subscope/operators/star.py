"""Star schema: customer dimension, fact tables, surrogate keys and the relationship map."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscope.functions import columns as C
from subscope.operators import conform
from subscope.session import work_dir
from subscope.sources import lookups

CUSTOMER_COLUMNS = [name for _, name, _ in conform.CUSTOMER_SPEC] + ["churn_label"]
TENURE_BANDS = [(12, "0-12 Months"), (24, "13-24 Months"), (48, "25-48 Months")]
CHARGE_BANDS = [(40, "Low Value"), (80, "Medium Value")]

# Unknown customer ids that are sent to every task at most.
SENT = 1_000_000

# Many-to-one edges a filter travels along, from dimension to fact: (fact, column, dim, column).
RELATIONSHIPS = [
    ("fact_billing", "customer_key", "dim_customer", "customer_key"),
    ("fact_complaints", "customer_key", "dim_customer", "customer_key"),
    ("fact_network_events", "customer_key", "dim_customer", "customer_key"),
    ("fact_billing", "billing_date_key", "dim_date", "date_key"),
    ("fact_complaints", "opened_date_key", "dim_date", "date_key"),
    ("fact_network_events", "event_date_key", "dim_date", "date_key"),
    ("fact_network_events", "location_key", "dim_network_location", "location_key"),
]
# One-to-one edges on which filters travel both ways.
ONE_TO_ONE = [
    ("dim_customer", "customer_churn_predictions", "customer_id"),
    ("dim_customer", "customer_churn_analytics", "customer_id"),
    ("dim_customer", "high_risk_customers", "customer_id"),
]


def tenure_segment() -> Column:
    return C.band_upto("tenure_months", TENURE_BANDS, "49+ Months")


def charge_segment() -> Column:
    return C.band_below("monthly_charges", CHARGE_BANDS, "High Value")


def service_label(c: str | Column) -> Column:
    """One label for all spellings of no internet; NULL becomes Unknown (P20)."""
    c = C.col(c)
    none = F.lower(F.trim(c)).isin("no", "none", "no internet service")
    return F.when(none, "No Internet Service").when(c.isNull(), "Unknown").otherwise(c)


def surrogate(key: str | Column) -> Column:
    """Surrogate key of a business key."""
    return F.xxhash64(C.col(key))


def dim_customer(customers: DataFrame) -> DataFrame:
    """Customer dimension with surrogate key, segments, status and sort key."""
    return customers.select(
        surrogate("customer_id").alias("customer_key"), *CUSTOMER_COLUMNS
    ).withColumns(
        {
            "tenure_segment": tenure_segment(),
            "monthly_charge_segment": charge_segment(),
            "internet_service": service_label("internet_service"),
            "customer_status": F.when(F.col("churn_label") == 1, "Churned").otherwise("Active"),
            "contract_type_sort": C.remap(
                "contract_type", lookups.CONTRACT_ORDER, lookups.CONTRACT_ORDER_OTHER
            ),
        }
    )


def customer_keys(dim: DataFrame) -> DataFrame:
    return dim.select("customer_id", "customer_key")


def with_customer_key(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Left lookup of any surrogate key (J2); rows of unknown customers keep a NULL key.

    The dimension grows with the business, so it is not broadcast by hint. A customer with a
    large share of the fact lands in one shuffle partition, which AQE splits by map output.
    """
    return fact.join(customer_keys(dim), "customer_id", "left")


def unknown_customers(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """Distinct customer ids of ``rows`` that the dimension lacks; ids are combined within tasks.

    Packed files make the dimension look small, but its ids are not sent to the driver and every task."""
    return rows.select("customer_id").distinct().join(dim.select("customer_id").hint("merge"), "customer_id", "left_anti")


def keyed(rows: DataFrame, dim: DataFrame, lay_out_by: str | None = None) -> DataFrame:
    """Left lookup of the surrogate key (J2) where it is computed from the id: in place, without
    moving the fact; rows of unknown customers keep a NULL key.

    The ids that the dimension lacks are written first. Up to ``SENT`` of them go to every task,
    more are joined. Rows that are to be laid out by a column are moved before they get their key,
    so that hashes, which do not compress, do not travel.
    """
    spark = rows.sparkSession
    path = work_dir(spark, "unknown-customers")
    unknown_customers(rows, dim).where("customer_id IS NOT NULL").write.parquet(path)
    unknown = spark.read.schema(rows.select("customer_id").schema).parquet(path).withColumn("_unknown", F.lit(True))
    count = unknown.count()
    known = F.col("customer_id").isNotNull()
    if count:
        rows = rows.join(F.broadcast(unknown) if count <= SENT else unknown, "customer_id", "left")
        known &= F.col("_unknown").isNull()
    if lay_out_by:
        rows = rows.hint("rebalance", lay_out_by)
    return rows.withColumn("customer_key", F.when(known, surrogate("customer_id"))).drop("_unknown")


def fact(
    rows: DataFrame,
    dim: DataFrame,
    spec: conform.Spec,
    month: str,
    flags: Sequence[str],
    dates: dict[str, str],
    by_month: bool = False,
) -> DataFrame:
    """A fact table: the conformed columns and flags, the customer's key, a key for every date role
    (``dates``: name by column), and the month that partitions it; ``by_month`` lays it out by that
    before any key is added."""
    own = [name for _, name, _ in spec]
    rows = rows.withColumn("month_key", C.month_key(month))
    return keyed(rows, dim, "month_key" if by_month else None).select(
        "customer_key",
        *own,
        *flags,
        *(C.date_key(column).alias(name) for column, name in dates.items()),
        "month_key",
    )


def fact_billing(billing: DataFrame, dim: DataFrame, by_month: bool = False) -> DataFrame:
    dates = {"billing_month": "billing_date_key", "payment_date": "payment_date_key"}
    return fact(billing, dim, conform.BILLING_SPEC, "billing_month", ("is_paid", "is_late", "is_unpaid"), dates, by_month)


def fact_complaints(complaints: DataFrame, dim: DataFrame, by_month: bool = False) -> DataFrame:
    flags = ("is_critical", "is_escalated", "is_unresolved")
    return fact(complaints, dim, conform.COMPLAINT_SPEC, "opened_at", flags, {"opened_at": "opened_date_key"}, by_month)


def fact_network_events(events: DataFrame, dim: DataFrame) -> DataFrame:
    flags = ("is_outage", "is_degraded")
    return fact(events, dim, conform.NETWORK_SPEC, "event_timestamp", flags, {"event_timestamp": "event_date_key"})


def on_calendar(df: DataFrame, timestamp: str, calendar: DataFrame, date: str = "full_date") -> DataFrame:
    """Join a timestamp to a calendar by its date part (J11); its size decides how."""
    return df.join(calendar, F.to_date(timestamp) == F.col(date), "left")
