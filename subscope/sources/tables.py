"""Raw domain frames over an order-management schema (customer, orders, lineitem, events).

The result has the columns of the raw sources, so every operator runs on it unchanged. Money
is computed in whole cents, which keeps two-decimal doubles exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.functions import columns as C
from subscope.operators.ingest import PLACE

EVENT_TYPES = {
    "view": "Normal",
    "click": "High Latency",
    "signup": "Packet Loss",
    "purchase": "Service Degradation",
    "error": "Outage",
}
REGIONS = {
    "AFRICA": "Cairo",
    "AMERICA": "Giza",
    "ASIA": "Alexandria",
    "EUROPE": "Delta",
    "MIDDLE EAST": "Upper Egypt",
}
CONTRACTS = {
    "AUTOMOBILE": "Month-to-month",
    "BUILDING": "Month-to-month",
    "FURNITURE": "One year",
    "HOUSEHOLD": "Two year",
}
PAYMENT_METHODS = ["Electronic check", "Mailed check", "Bank transfer", "Credit card"]
STATUSES = {"N": "Paid", "A": " Late ", "R": "Unpaid"}
PRIORITIES = {"1-URGENT": "Critical", "2-HIGH": "High", "3-MEDIUM": "Medium", "5-LOW": "Low"}
CATEGORIES = ["Network Quality", "Billing", "Internet Speed", "Service Outage", "Customer Service"]
CHANNELS = ["Call Center", "Mobile App", "Website", "Branch"]


def _pick(index, values):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _yes_no(condition):
    return F.when(condition, "Yes").otherwise("No")


def _cents(c):
    return F.rint(F.col(c) * 100)


def customer_id(key: str):
    return F.concat(F.lit("C-"), F.col(key).cast("string"))


def customers_raw(customer: DataFrame) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    charge_cents = F.floor(_cents("c_acctbal") / 80)
    tenure = k % 73
    internet = F.when(n % 4 == 0, "DSL").when(n % 4 == 1, "Fiber optic").when(n % 4 == 2, " No ")
    addon = lambda m: F.when(n % 4 == 2, "No internet service").otherwise(_yes_no(k % m == 0))
    return customer.select(
        # every tenth key carries a trailing blank, as hand-typed exports do
        F.concat(customer_id("c_custkey"), F.when(k % 10 == 0, " ").otherwise("")).alias("customerID"),
        F.when(k % 2 == 0, "Male").otherwise("Female").alias("gender"),
        C.flag(k % 7 == 0).alias("SeniorCitizen"),
        _yes_no(k % 3 == 0).alias("Partner"),
        _yes_no(k % 5 == 0).alias("Dependents"),
        tenure.cast("int").alias("tenure"),
        _yes_no(k % 9 != 0).alias("PhoneService"),
        _yes_no(k % 4 == 1).alias("MultipleLines"),
        internet.alias("InternetService"),
        addon(2).alias("OnlineSecurity"),
        addon(3).alias("OnlineBackup"),
        addon(5).alias("DeviceProtection"),
        addon(7).alias("TechSupport"),
        addon(6).alias("StreamingTV"),
        addon(8).alias("StreamingMovies"),
        C.remap("c_mktsegment", CONTRACTS, "Month-to-month").alias("Contract"),
        _yes_no(k % 6 < 4).alias("PaperlessBilling"),
        _pick(k % 4, PAYMENT_METHODS).alias("PaymentMethod"),
        (charge_cents / 100).alias("MonthlyCharges"),
        F.when(k % 11 != 0, charge_cents * tenure / 100).alias("TotalCharges"),
        F.when(k % 97 != 0, _yes_no(_cents("c_acctbal") % 4 == 0)).alias("Churn"),
        F.lit("2024-01-01").cast("date").alias("_ingestion_timestamp"),
    )


def billing_raw(lineitem: DataFrame, orders: DataFrame, placed: bool = False) -> DataFrame:
    """Invoices. ``placed`` adds the order that an invoice's id names, by which the join lays rows out."""
    price, part = _cents("l_extendedprice"), F.col("l_partkey")
    usage = F.when(part % 100 == 0, -price).otherwise(price)
    discount = F.when(part % 101 != 0, F.floor(price * _cents("l_discount") / 100))
    tax = F.floor(price * _cents("l_tax") / 100)
    amount = _cents("l_quantity") + usage - F.coalesce(discount, F.lit(0)) + tax
    status = C.remap("l_returnflag", STATUSES)
    paid_on = F.date_add(F.to_date("l_shipdate"), (part % 34 + 1).cast("int"))
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).select(
        F.concat_ws("-", F.lit("INV"), "l_orderkey", "l_linenumber").alias("invoice_id"),
        customer_id("o_custkey").alias("customerID"),
        F.trunc(F.to_date("l_shipdate"), "MM").alias("billing_month"),
        F.col("l_quantity").alias("MonthlyCharges"),
        (usage / 100).alias("usage_charges"),
        (discount / 100).alias("discount_amount"),
        (tax / 100).alias("tax_amount"),
        (amount / 100).alias("total_amount"),
        _pick(F.col("l_suppkey") % 4, PAYMENT_METHODS).alias("PaymentMethod"),
        status.alias("payment_status"),
        F.when(F.col("l_returnflag") != "R", paid_on).alias("payment_date"),
        F.to_date("l_shipdate").alias("_ingestion_timestamp"),
        *([F.col("l_orderkey").alias(PLACE)] if placed else []),
    )


def complaints_raw(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    closed = F.when(k % 2 == 0, "Closed").otherwise("Resolved")
    status = F.when(F.col("o_orderstatus") == "O", "In Progress").when(
        F.col("o_orderstatus") == "P", "Escalated"
    )
    return orders.select(
        F.concat_ws("-", F.lit("CMP"), "o_orderkey").alias("complaint_id"),
        customer_id("o_custkey").alias("customerID"),
        F.col("o_orderdate").alias("opened_at"),
        _pick(k % 5, CATEGORIES).alias("category"),
        C.first_match([(F.col("o_orderpriority") == a, b) for a, b in PRIORITIES.items()]).alias("priority"),
        F.coalesce(status, closed).alias("status"),
        _pick(k % 4, CHANNELS).alias("channel"),
        (F.floor("o_totalprice") % 97).cast("double").alias("resolution_hours"),
        (k % 6).cast("int").alias("satisfaction_score"),
        F.to_date("o_orderdate").alias("_ingestion_timestamp"),
    )


def network_events_raw(
    events: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    home = (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select("c_custkey", C.remap("r_name", REGIONS).alias("region"))
    )
    return (
        events.withColumn("k", k)
        .join(home.hint("merge"), F.col("user_id") == F.col("c_custkey"), "left")
        .select(
            F.concat_ws("-", F.lit("NET"), "event_id").alias("event_id"),
            customer_id("user_id").alias("customerID"),
            F.col("ts").alias("event_timestamp"),
            C.remap("event_type", EVENT_TYPES).alias("event_type"),
            "region",
            F.concat_ws("-", F.lit("TOWER"), "k").alias("tower_id"),
            F.col("value").alias("latency_ms"),
            (F.col("k") % 41 / 10).alias("packet_loss_pct"),
            ((12000 - _cents("value")) / 100).alias("download_speed_mbps"),
            F.when(F.col("event_type") == "error", F.col("k")).otherwise(0).alias("outage_minutes"),
            F.to_date("ts").alias("_ingestion_timestamp"),
        )
    )


def raw_frames(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    """The four raw sources of a folder of parquet tables, each built when it is asked for; invoices also
    with their place."""
    read = lambda name: spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return {
        "customers_raw": lambda: customers_raw(read("customer")),
        "billing_raw": lambda: billing_raw(read("lineitem"), read("orders")),
        "billing_placed": lambda: billing_raw(read("lineitem"), read("orders"), placed=True),
        "complaints_raw": lambda: complaints_raw(read("orders")),
        "network_events_raw": lambda: network_events_raw(
            read("events"), read("customer"), read("nation"), read("region")
        ),
    }
