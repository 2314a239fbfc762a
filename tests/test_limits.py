"""Values, calendars and labels beyond any size that the operators were tried on."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from subscope.functions import columns as C
from subscope.operators import conform, invoices, stats
from subscope.sources import calendars


def sums(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double").repartition(5).agg(C.total("v").alias("t"), C.mean("v").alias("m")).head()


def test_sums_keep_small_decimals(spark):
    assert sums(spark, [4e-7] * 1000)["t"] == pytest.approx(4e-4, rel=1e-9)


def test_sums_take_large_values(spark):
    assert sums(spark, [1e13, 1e13, 0.25])["t"] == 2e13 + 0.25
    assert sums(spark, [1e300, 1.0])["t"] == 1e300


def test_sums_are_exact_in_any_order(spark):
    values = [0.1, 0.2, 0.3, 1e9, -1e9, 123456.789012, 8.9e12] * 50
    assert sums(spark, values)["t"] == math.fsum(values) == sums(spark, values[::-1])["t"]


def test_sums_of_nan_infinity_and_nothing(spark):
    assert math.isnan(sums(spark, [1.0, float("nan")])["t"])
    assert sums(spark, [1.0, float("inf")])["t"] == float("inf")
    assert sums(spark, [None, None])["t"] is None and sums(spark, [None, None])["m"] is None
    assert sums(spark, [None, 2.5])["t"] == 2.5


def test_partial_sums_add_up(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), (F.col("id") * 1e10 + 0.01).alias("v"))
    parts = df.groupBy("k").agg(C.total("v").alias("v"))
    exact = math.fsum(r["v"] for r in df.collect())
    assert parts.agg(C.total("v").alias("t")).head()["t"] == pytest.approx(exact, rel=1e-15)


def test_one_odd_date_does_not_stop_a_calendar(spark):
    days = spark.createDataFrame([(dt.date(1, 1, 1),), (dt.date(9999, 12, 31),)], "d date")
    assert calendars.spine_over([(days, "d")]).count() == 3_652_059


def test_many_labels(spark):
    df = spark.range(6000).select((F.col("id") % 1500).cast("string").alias("label"), "id")
    weights = stats.balanced_weight(df, "label")
    assert weights.count() == 6000 and weights.agg(F.count_distinct("label")).head()[0] == 1500


def test_blank_references_stay_and_blank_customers_go(spark):
    rows = spark.createDataFrame([("I1", " "), ("I2", None), ("I3", "C")], "invoice_id string, customerID string")
    assert {r[0] for r in conform.valid_keys(rows, ["invoice_id", "customerID"], blank=["customerID"]).collect()} == {"I1", "I3"}
    assert {r[0] for r in conform.valid_keys(rows, ["customerID"]).collect()} == {"I3"}


def test_ids_have_no_gaps_without_a_fixed_number_of_slots(spark, monkeypatch):
    monkeypatch.setattr(invoices, "ROWS_PER_SLOT", 100)
    df = spark.range(950).select(F.format_string("k%05d", "id").alias("k"))
    ids = sorted(r.i for r in invoices.sequential_ids(df, ["k"], "N-%04d", "i").collect())
    assert ids == [f"N-{n:04d}" for n in range(1, 951)]
