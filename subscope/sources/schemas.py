"""Schemas of the four raw sources. They are always given to the reader, never inferred."""

from pyspark.sql import types as T


def _schema(text: str, required: tuple[str, ...]) -> T.StructType:
    fields = [part.split() for part in text.split(",")]
    kinds = {
        "string": T.StringType(),
        "int": T.IntegerType(),
        "double": T.DoubleType(),
        "timestamp": T.TimestampType(),
    }
    return T.StructType([T.StructField(n, kinds[k], n not in required) for n, k in fields])


# Column names, order and types of the raw sources.
CUSTOMERS = _schema(
    "customerID string, gender string, SeniorCitizen int, Partner string, Dependents string,"
    "tenure int, PhoneService string, MultipleLines string, InternetService string,"
    "OnlineSecurity string, OnlineBackup string, DeviceProtection string, TechSupport string,"
    "StreamingTV string, StreamingMovies string, Contract string, PaperlessBilling string,"
    "PaymentMethod string, MonthlyCharges double, TotalCharges double, Churn string",
    required=("customerID",),
)
BILLING = _schema(
    "invoice_id string, customerID string, billing_month timestamp, MonthlyCharges double,"
    "usage_charges double, discount_amount double, tax_amount double, total_amount double,"
    "PaymentMethod string, payment_status string, payment_date timestamp",
    required=("invoice_id", "customerID"),
)
COMPLAINTS = _schema(
    "complaint_id string, customerID string, opened_at timestamp, category string,"
    "priority string, status string, channel string, resolution_hours double,"
    "satisfaction_score int",
    required=("complaint_id", "customerID"),
)
NETWORK_EVENTS = _schema(
    "event_id string, customerID string, event_timestamp timestamp, event_type string,"
    "region string, tower_id string, latency_ms double, packet_loss_pct double,"
    "download_speed_mbps double, outage_minutes int",
    required=("event_id", "customerID"),
)
