"""Raw to conformed rows: validity, latest version, standard names, range rules, flags."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from subscope.functions import columns as C
from subscope.operators.ingest import METADATA, PLACE, VERSION

# (raw column, conformed column, standardisation)
Spec = Sequence[tuple[str, str, str | None]]

# Conformed names and standardisation of the raw columns.
CUSTOMER_SPEC: Spec = [
    ("customerID", "customer_id", "trim"),
    ("gender", "gender", "lower"),
    ("SeniorCitizen", "senior_citizen", None),
    ("Partner", "has_partner", "lower"),
    ("Dependents", "has_dependents", "lower"),
    ("tenure", "tenure_months", None),
    ("PhoneService", "phone_service", "lower"),
    ("MultipleLines", "multiple_lines", "trim"),
    ("InternetService", "internet_service", "trim"),
    ("OnlineSecurity", "online_security", "trim"),
    ("OnlineBackup", "online_backup", "trim"),
    ("DeviceProtection", "device_protection", "trim"),
    ("TechSupport", "tech_support", "trim"),
    ("StreamingTV", "streaming_tv", "trim"),
    ("StreamingMovies", "streaming_movies", "trim"),
    ("Contract", "contract_type", "trim"),
    ("PaperlessBilling", "paperless_billing", "lower"),
    ("PaymentMethod", "payment_method", "trim"),
    ("MonthlyCharges", "monthly_charges", None),
    ("TotalCharges", "total_charges", None),
    ("Churn", "churn", "trim"),
]
BILLING_SPEC: Spec = [
    ("invoice_id", "invoice_id", "trim"),
    ("customerID", "customer_id", "trim"),
    ("billing_month", "billing_month", "date"),
    ("MonthlyCharges", "monthly_charges", None),
    ("usage_charges", "usage_charges", None),
    ("discount_amount", "discount_amount", None),
    ("tax_amount", "tax_amount", None),
    ("total_amount", "total_amount", None),
    ("PaymentMethod", "payment_method", "trim"),
    ("payment_status", "payment_status", "lower"),
    ("payment_date", "payment_date", "ts"),
]
COMPLAINT_SPEC: Spec = [
    ("complaint_id", "complaint_id", "trim"),
    ("customerID", "customer_id", "trim"),
    ("opened_at", "opened_at", "ts"),
    ("category", "complaint_category", "lower"),
    ("priority", "priority", "lower"),
    ("status", "complaint_status", "lower"),
    ("channel", "complaint_channel", "lower"),
    ("resolution_hours", "resolution_hours", None),
    ("satisfaction_score", "satisfaction_score", None),
]
NETWORK_SPEC: Spec = [
    ("event_id", "event_id", "trim"),
    ("customerID", "customer_id", "trim"),
    ("event_timestamp", "event_timestamp", "ts"),
    ("event_type", "event_type", "lower"),
    ("region", "region", "trim"),
    ("tower_id", "tower_id", "trim"),
    ("latency_ms", "latency_ms", None),
    ("packet_loss_pct", "packet_loss_pct", None),
    ("download_speed_mbps", "download_speed_mbps", None),
    ("outage_minutes", "outage_minutes", None),
]
DEGRADED_TYPES = ("high latency", "packet loss", "service degradation", "outage")
UNRESOLVED_STATUSES = ("in progress", "escalated")
NORMAL_EVENT = "normal"


def valid_keys(df: DataFrame, keys: Sequence[str], blank: Sequence[str] = ()) -> DataFrame:
    """Keep rows whose business keys are all present (P3), and not blank unless in ``blank``."""
    return df.filter(C.all_of([F.col(k).isNotNull() if k in blank else F.trim(k) != "" for k in keys]))


def _digits(hashed: str) -> Column:
    """The bytes of a SHA-256, in the order of its digits: half as long where rows move. Other texts
    are their own bytes."""
    text = F.col(hashed)
    return F.coalesce(F.when(F.length(text) == 64, F.unhex(text)), text.cast("binary"))


def latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (VERSION,),
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """The newest version per key (W1), with a total order so the survivor never varies.

    ``row_number() = 1`` plans a per-task group limit below the shuffle: a key that holds a
    third of all rows sends one row per task, not its whole history. Ties fall to the record
    hash when there is one, else to all remaining columns. Text keys tend to share their first
    characters, which is all that Spark's sort prefix holds, so a hash of the keys goes first.
    Where the source says what the rows of a key have in common (``PLACE``), rows that a join has
    brought together by it do not move again.
    """
    if tie_break is None:
        hashed = "_record_hash" in df.columns
        rest = [c for c in df.columns if c not in keys and c not in order and c not in METADATA]
        tie_break = ["_record_hash"] if hashed else rest
    by = [F.col(c).desc_nulls_last() for c in order] + [_digits(c).asc_nulls_first() if c == "_record_hash" else F.col(c).asc_nulls_first() for c in tie_break]
    place = [PLACE] if PLACE in df.columns else []
    newest = W.partitionBy(F.xxhash64(*keys), *place, *keys).orderBy(*by)
    return (
        df.withColumn("_version", F.row_number().over(newest))
        .filter(F.col("_version") == 1)
        .drop("_version")
    )


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key where the other columns depend on the key alone."""
    return df.dropDuplicates(list(keys))


def standardise(df: DataFrame, spec: Spec, keep: Sequence[str] = ()) -> DataFrame:
    """Rename and standardise by a column map."""
    kinds = dict(df.dtypes)

    def one(src, dst, how):
        # a source that already delivers dates or timestamps keeps its type
        if how == "ts" and kinds[src] in ("date", "timestamp", "timestamp_ntz"):
            how = None
        return C.clean(src, how).alias(dst)

    return df.select(*[one(*row) for row in spec], *keep)


def trim_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Trim keys before versions are compared, so ``'A'`` and ``'A '`` are one entity."""
    return df.withColumns({k: F.trim(k) for k in keys})


def with_flags(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """Add 0/1 columns; a NULL condition gives 0."""
    return df.withColumns({name: C.flag(condition) for name, condition in flags.items()})


def fill_total_charges(df: DataFrame) -> DataFrame:
    """Missing total charges become monthly charges times tenure (P5)."""
    derived = F.col("monthly_charges") * F.col("tenure_months")
    return df.withColumn("total_charges", F.coalesce("total_charges", derived))


# Range rules (P4). A row passes a rule only if it is true; NULL operands reject the row.
def billing_rules() -> dict[str, Column]:
    names = ("monthly_charges", "usage_charges", "discount_amount", "tax_amount", "total_amount")
    return {f"{n}_not_negative": F.col(n) >= 0 for n in names}


def complaint_rules() -> dict[str, Column]:
    return {
        "resolution_hours_not_negative": F.col("resolution_hours") >= 0,
        "satisfaction_score_in_1_5": F.col("satisfaction_score").between(1, 5),
    }


def network_rules() -> dict[str, Column]:
    return {
        "latency_not_negative": F.col("latency_ms") >= 0,
        "packet_loss_in_0_100": F.col("packet_loss_pct").between(0, 100),
        "speed_not_negative": F.col("download_speed_mbps") >= 0,
        "outage_minutes_not_negative": F.col("outage_minutes") >= 0,
    }


def billing_flags() -> dict[str, Column]:
    status = F.col("payment_status")
    return {"is_paid": status == "paid", "is_late": status == "late", "is_unpaid": status == "unpaid"}


def complaint_flags() -> dict[str, Column]:
    status = F.col("complaint_status")
    return {
        "is_critical": F.col("priority") == "critical",
        "is_escalated": status == "escalated",
        "is_unresolved": status.isin(*UNRESOLVED_STATUSES),
    }


def network_flags() -> dict[str, Column]:
    kind = F.col("event_type")
    return {"is_outage": kind == "outage", "is_degraded": kind.isin(*DEGRADED_TYPES)}


def conformed(df: DataFrame, keys: Sequence[str], spec: Spec, blank: Sequence[str] = ()) -> DataFrame:
    """Valid keys, newest version, standard columns: the common first half of every source.

    Only a customer without an id is nobody. Invoices, complaints and events with a blank
    reference stay (``blank``) and find no customer, so that nothing billed or reported is lost.

    Range rules come after this step on purpose. If the newest version breaks a rule, the
    entity is rejected rather than replaced by an older version.
    """
    valid = trim_keys(valid_keys(df, keys, blank), keys)
    return standardise(latest(valid, keys[:1]), spec)


def customers_clean(raw: DataFrame) -> DataFrame:
    clean = fill_total_charges(conformed(raw, ["customerID"], CUSTOMER_SPEC))
    return with_flags(clean, {"churn_label": F.lower("churn") == "yes"})


def billing_candidates(raw: DataFrame) -> DataFrame:
    return conformed(raw, ["invoice_id", "customerID"], BILLING_SPEC, blank=["invoice_id", "customerID"])


def complaint_candidates(raw: DataFrame) -> DataFrame:
    return conformed(raw, ["complaint_id", "customerID"], COMPLAINT_SPEC, blank=["complaint_id", "customerID"])


def network_candidates(raw: DataFrame) -> DataFrame:
    return conformed(raw, ["event_id", "customerID"], NETWORK_SPEC, blank=["event_id", "customerID"])


def accepted(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    return df.filter(C.all_of(list(rules.values())))


def billing_clean(raw: DataFrame) -> DataFrame:
    return with_flags(accepted(billing_candidates(raw), billing_rules()), billing_flags())


def complaints_clean(raw: DataFrame) -> DataFrame:
    return with_flags(accepted(complaint_candidates(raw), complaint_rules()), complaint_flags())


def network_events_clean(raw: DataFrame) -> DataFrame:
    return with_flags(accepted(network_candidates(raw), network_rules()), network_flags())


class Source(NamedTuple):
    """A raw source with range rules: its rows, rules and flags."""

    raw: str
    candidates: Callable[[DataFrame], DataFrame]
    rules: Callable[[], dict[str, Column]]
    flags: Callable[[], dict[str, Column]]


JUDGED = {
    "billing": Source("billing_raw", billing_candidates, billing_rules, billing_flags),
    "complaints": Source("complaints_raw", complaint_candidates, complaint_rules, complaint_flags),
    "network_events": Source("network_events_raw", network_candidates, network_rules, network_flags),
}
