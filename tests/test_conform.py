import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from subscope.functions import columns as C
from subscope.operators import conform, quality

NOW = dt.datetime(2026, 1, 1)
OLD = dt.datetime(2025, 1, 1)
BILLING = (
    "invoice_id string, customerID string, billing_month date, MonthlyCharges double, usage_charges double,"
    "discount_amount double, tax_amount double, total_amount double, PaymentMethod string, payment_status string,"
    "payment_date timestamp, _ingestion_timestamp timestamp"
)


def invoice(i="I1", c="C1", monthly=10.0, usage=1.0, discount=0.0, tax=1.0, total=12.0, status="Paid", at=NOW):
    return (i, c, dt.date(2026, 1, 1), monthly, usage, discount, tax, total, " Card ", status, None, at)


def test_blank_and_null_keys_are_dropped(spark):
    df = spark.createDataFrame([("A",), (None,), ("",), ("   ",), (" B ",)], "k string")
    assert sorted(r.k for r in conform.valid_keys(df, ["k"]).collect()) == [" B ", "A"]


def test_newest_version_survives_and_padded_keys_are_one_entity(spark):
    raw = spark.createDataFrame(
        [invoice(total=1.0, at=OLD), invoice("I1 ", total=2.0), invoice("I2", total=3.0)], BILLING
    )
    got = {r.invoice_id: r.total_amount for r in conform.billing_clean(raw).collect()}
    assert got == {"I1": 2.0, "I2": 3.0}


def test_ties_fall_to_a_total_order(spark):
    versions = [invoice(total=t) for t in (5.0, 3.0, 4.0)]
    picks = set()
    for order in (versions, versions[::-1], versions[1:] + versions[:1]):
        raw = spark.createDataFrame(order, BILLING).repartition(3)
        picks.add(conform.billing_clean(raw).first().total_amount)
    assert picks == {3.0}


def test_record_hash_breaks_ties_when_present(spark):
    df = spark.createDataFrame([("a", NOW, "x", "2"), ("a", NOW, "y", "1")], "k string, _ingestion_timestamp timestamp, v string, _record_hash string")
    assert conform.latest(df, ["k"]).first().v == "y"


def test_invalid_newest_version_removes_the_entity(spark):
    raw = spark.createDataFrame([invoice(at=OLD), invoice(total=-1.0)], BILLING)
    assert conform.billing_clean(raw).count() == 0
    accepted, quarantined = quality.split(conform.billing_candidates(raw), conform.billing_rules())
    assert accepted.count() == 0
    assert quarantined.first().broken_rules == ["total_amount_not_negative"]


def test_null_operand_rejects_the_row(spark):
    raw = spark.createDataFrame([invoice(discount=None), invoice("I2", discount=0.0)], BILLING)
    assert [r.invoice_id for r in conform.billing_clean(raw).collect()] == ["I2"]


@pytest.mark.parametrize(
    "status, flags", [("PAID ", (1, 0, 0)), ("late", (0, 1, 0)), ("Unpaid", (0, 0, 1)), ("other", (0, 0, 0)), (None, (0, 0, 0))]
)
def test_status_flags(spark, status, flags):
    row = conform.billing_clean(spark.createDataFrame([invoice(status=status)], BILLING)).first()
    assert (row.is_paid, row.is_late, row.is_unpaid) == flags


def test_complaint_limits(spark):
    schema = (
        "complaint_id string, customerID string, opened_at timestamp, category string, priority string, status string,"
        "channel string, resolution_hours double, satisfaction_score int, _ingestion_timestamp timestamp"
    )
    data = [(f"X{i}", "C", NOW, "Billing", "Critical", "Escalated", "Web", h, s, NOW) for i, (h, s) in enumerate(
        [(1.0, 0), (1.0, 1), (1.0, 5), (1.0, 6), (1.0, None), (None, 3), (-1.0, 3), (0.0, 3)]
    )]
    out = conform.complaints_clean(spark.createDataFrame(data, schema))
    assert sorted(r.complaint_id for r in out.collect()) == ["X1", "X2", "X7"]
    row = out.first()
    assert (row.is_critical, row.is_escalated, row.is_unresolved) == (1, 1, 1)


def test_network_limits_and_mixed_case(spark):
    schema = (
        "event_id string, customerID string, event_timestamp timestamp, event_type string, region string, tower_id string,"
        "latency_ms double, packet_loss_pct double, download_speed_mbps double, outage_minutes int, _ingestion_timestamp timestamp"
    )
    data = [(f"E{i}", "C", NOW, kind, "Cairo", "T", 1.0, loss, 1.0, 0, NOW) for i, (kind, loss) in enumerate(
        [("Normal", -1.0), ("normal", 0.0), ("OUTAGE", 100.0), ("High Latency ", 101.0), ("Packet Loss", 50.0)]
    )]
    got = {r.event_id: (r.event_type, r.is_outage, r.is_degraded) for r in conform.network_events_clean(spark.createDataFrame(data, schema)).collect()}
    assert got == {"E1": ("normal", 0, 0), "E2": ("outage", 1, 1), "E4": ("packet loss", 0, 1)}


def test_missing_total_charges_are_derived(spark):
    df = spark.createDataFrame([(10.0, 3, None), (10.0, 3, 7.0)], "monthly_charges double, tenure_months int, total_charges double")
    assert sorted(r.total_charges for r in conform.fill_total_charges(df).collect()) == [7.0, 30.0]


def test_record_hash_treats_null_and_empty_alike(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "b")], "x string, y string")
    hashes = [r.h for r in df.select(C.record_hash(["x", "y"]).alias("h")).collect()]
    assert hashes[0] == hashes[1] != hashes[2]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(0, 9)), max_size=20))
def test_latest_keeps_one_row_per_key(spark, data):
    df = spark.createDataFrame(data, "k string, v int, x int")
    got = {r.k: (r.v, r.x) for r in conform.latest(df, ["k"], ["v"]).collect()}
    want = {}
    for k, v, x in data:
        if k not in want or (v, -x) > (want[k][0], -want[k][1]):
            want[k] = (v, x)
    assert got == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**12, 10**12), min_size=1, max_size=30))
def test_exact_sum_is_order_free(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double")
    got = {df.repartition(n).agg(C.total("x").alias("t")).first().t for n in (1, 5)}
    assert got == {sum(cents) / 100}


def test_exact_sum_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    row = df.agg(C.total("x").alias("t"), C.mean("x").alias("m")).first()
    assert row.t is None and row.m is None


def test_reports_count_violations_not_nulls(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", -1.0, "Paid"), ("b", None, "odd")], "invoice_id string, total_amount double, payment_status string").withColumn("customerID", F.lit("c"))
    row = quality.raw_billing(df).first()
    assert (row.total_transactions, row.unique_invoices, row.negative_amounts, row.invalid_payment_status) == (3, 2, 1, 1)
