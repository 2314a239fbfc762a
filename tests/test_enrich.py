import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from subscope.operators import enrich, invoices, kpi
from subscope.sources import calendars, lookups

EVENTS = (
    "event_id string, customer_id string, customer_key long, event_type string, region string, latency_ms double,"
    "packet_loss_pct double, download_speed_mbps double, outage_minutes int, is_outage int, is_degraded int"
)


def dim(spark):
    return spark.createDataFrame([(1, "DSL"), (2, " fiber "), (3, "No Internet Service"), (4, None)], "customer_key long, internet_service string")


def events(spark):
    data = [(f"E{k}", f"C{k}", k, "Normal" if k == 1 else "Outage", r, 10.0, 99.0, 50.0, 10, int(k != 1), int(k != 1)) for k, r in [(1, "Cairo"), (2, "Giza"), (3, "Cairo"), (4, "Giza"), (9, "Cairo"), (2, "Mars")]]
    return spark.createDataFrame(data, EVENTS)


def test_only_fixed_access_gets_a_cabinet(spark):
    out = enrich.with_cabinets(events(spark), dim(spark))
    got = {(r.customer_id, r.region): (r.access_technology, r.cabinet_id[:8], r.cabinet_type) for r in out.collect()}
    assert got == {
        ("C1", "Cairo"): ("DSL", "CAB-DSL-", "DSL Cabinet"),
        ("C2", "Giza"): ("Fiber Optic", "CAB-FBR-", "Fiber Cabinet"),
        ("C2", "Mars"): ("Fiber Optic", "CAB-FBR-", "Fiber Cabinet"),
    }
    assert all(r.cabinet_id.split("-")[2] in ("CAI", "GIZ", "UNK") and len(r.cabinet_id) == 15 for r in out.collect())


def test_enriching_twice_changes_nothing(spark):
    once = enrich.with_cabinets(events(spark), dim(spark))
    twice = enrich.with_cabinets(once, dim(spark))
    assert once.columns == twice.columns and once.exceptAll(twice).count() == 0
    cities = enrich.with_cities(spark, events(spark), dim(spark))
    assert enrich.with_cities(spark, cities, dim(spark)).columns == cities.columns


@pytest.mark.parametrize(
    "region, bucket, key",
    [("Los Angeles Metro", 0, 101), ("Los Angeles Metro", 37, 101), ("Los Angeles Metro", 38, 102), ("Los Angeles Metro", 59, 102),
     ("Los Angeles Metro", 60, 103), ("Los Angeles Metro", 79, 103), ("Los Angeles Metro", 80, 104), ("Los Angeles Metro", 99, 104),
     ("Bay Area", 34, 201), ("Bay Area", 35, 202), ("Bay Area", 75, 203), ("San Diego County", 74, 301), ("San Diego County", 75, 302),
     ("Central Valley", 33, 401), ("Central Valley", 34, 402), ("Central Valley", 67, 403), ("Sacramento / North", 75, 502), ("Mars", 1, None), (None, 1, None)],
)
def test_bucket_thresholds(spark, region, bucket, key):
    df = spark.createDataFrame([(region, bucket)], "region string, b int")
    out = enrich.assign_weighted(df, F.col("b"), lookups.location_thresholds(spark)).collect()
    assert [r.location_key for r in out] == [key]


def test_thresholds_cover_every_bucket_once(spark):
    cells = lookups.location_thresholds(spark).select("region", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("b"))
    counts = cells.groupBy("region").agg(F.count("b").alias("n"), F.count_distinct("b").alias("d")).collect()
    assert len(counts) == 5 and all(r.n == r.d == 100 for r in counts)


def test_scaling_clamps(spark):
    df = spark.createDataFrame([(100.0, 99.0, 0.05, 11, 1.22), (100.0, 50.0, 10.0, 5, None)],
        "latency_ms double, packet_loss_pct double, download_speed_mbps double, outage_minutes int, quality_factor double")
    a, b = enrich.scaled_by_quality(df).collect()
    assert (a.latency_ms, a.packet_loss_pct, a.download_speed_mbps, a.outage_minutes) == (122.0, 100.0, 0.1, 13)
    # a missing factor leaves the clamp values, as least and greatest skip NULL
    assert (b.latency_ms, b.packet_loss_pct, b.download_speed_mbps, b.outage_minutes) == (None, 100.0, 0.1, None)


def test_incidents_ignore_letter_case(spark):
    df = events(spark).unionByName(events(spark).withColumn("event_type", F.lower("event_type")))
    region = {r.region: r.affected_customers for r in kpi.by_region_weighted(df).collect()}
    assert region == {"Cairo": 2, "Giza": 2, "Mars": 1}


def test_worst_cabinets_need_enough_events(spark):
    df = spark.createDataFrame([("a", 20, 10, 50.0), ("b", 19, 19, 100.0), ("c", 40, 20, 50.0)], "cabinet_id string, network_events int, network_incidents int, incident_rate_pct double")
    assert [r.cabinet_id for r in kpi.worst_cabinets(df).collect()] == ["c", "a"]


def test_invoice_amounts(spark):
    df = spark.createDataFrame([(10.0, 5.0, 0.0), (1.0, 0.0, 5.0), (0.25, 0.0, 0.0)], "monthly_charges double, usage_charges double, discount_amount double")
    got = [(r.tax_amount, r.total_amount) for r in invoices.with_amounts(df).collect()]
    assert got == [(2.1, 17.1), (0.0, 0.0), (0.04, 0.29)]


def test_unpaid_invoices_have_no_payment_date(spark):
    df = spark.createDataFrame([("Paid",), ("Unpaid ",)], "s string")
    out = df.select(invoices.payment_date(F.col("s"), F.lit(dt.date(2026, 1, 2))).alias("d")).collect()
    assert [r.d for r in out] == [dt.date(2026, 1, 2), None]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(0, 10**6), min_size=1, max_size=60))
def test_ids_are_gap_free(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    ids = sorted(r.i for r in invoices.sequential_ids(df, ["k"], "N-%04d", "i", slots=7).collect())
    assert ids == [f"N-{n:04d}" for n in range(1, len(keys) + 1)]


def test_calendar_covers_whole_years_and_leap_days(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 29, 23, 59),), (None,)], "t timestamp")
    out = calendars.calendar_for(df, "t")
    assert out.count() == 366
    row = out.filter(F.col("date") == dt.date(2024, 2, 29)).first()
    assert (row.month, row.quarter, row.day) == ("February", "Qtr 1", 29)


def test_date_dimension_attributes(spark):
    out = {r.full_date: r for r in calendars.date_dimension(calendars.spine(spark, "2025-01-01", "2026-12-31")).collect()}
    assert len(out) == 730
    sunday = out[dt.date(2025, 1, 5)]
    assert (sunday.date_key, sunday.day_name, sunday.is_weekend, sunday.day_of_week_number, sunday.week_number) == (20250105, "Sunday", 1, 7, 1)
    assert out[dt.date(2025, 12, 29)].week_number == 1


def test_empty_facts_give_an_empty_calendar(spark):
    df = spark.createDataFrame([], "t timestamp")
    assert calendars.calendar_for(df, "t").count() == 0
