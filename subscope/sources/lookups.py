"""Small lookup tables of fixed size. They are safe to broadcast whatever the fact size is."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values ---------------------------------------------------------------------------

REGION_CODES = {
    "Cairo": "CAI",
    "Giza": "GIZ",
    "Alexandria": "ALX",
    "Delta": "DLT",
    "Upper Egypt": "UPR",
}
UNKNOWN_REGION_CODE = "UNK"

REGION_REMAP = {
    "Cairo": "Los Angeles Metro",
    "Giza": "Bay Area",
    "Alexandria": "San Diego County",
    "Delta": "Central Valley",
    "Upper Egypt": "Sacramento / North",
}

CITY_BUCKET_SALT = "california_city_v1"

# location_key, city, region, latitude, longitude, quality_factor
LOCATIONS = [
    (101, "Los Angeles", "Los Angeles Metro", 34.0522, -118.2437, 1.00),
    (102, "Long Beach", "Los Angeles Metro", 33.7701, -118.1937, 1.08),
    (103, "Anaheim", "Los Angeles Metro", 33.8366, -117.9143, 0.92),
    (104, "Riverside", "Los Angeles Metro", 33.9806, -117.3755, 1.15),
    (201, "San Francisco", "Bay Area", 37.7749, -122.4194, 0.88),
    (202, "San Jose", "Bay Area", 37.3382, -121.8863, 0.82),
    (203, "Oakland", "Bay Area", 37.8044, -122.2712, 1.08),
    (301, "San Diego", "San Diego County", 32.7157, -117.1611, 0.90),
    (302, "Chula Vista", "San Diego County", 32.6401, -117.0842, 1.05),
    (401, "Fresno", "Central Valley", 36.7378, -119.7871, 1.05),
    (402, "Bakersfield", "Central Valley", 35.3733, -119.0187, 1.18),
    (403, "Stockton", "Central Valley", 37.9577, -121.2908, 1.12),
    (501, "Sacramento", "Sacramento / North", 38.5816, -121.4944, 1.00),
    (502, "Redding", "Sacramento / North", 40.5865, -122.3917, 1.22),
]
STATE = "California"
COUNTRY = "United States"

# Upper bucket limit (exclusive, out of 100) of each location inside its region.
LOCATION_LIMITS = {
    101: 38, 102: 60, 103: 80, 104: 100,
    201: 35, 202: 75, 203: 100,
    301: 75, 302: 100,
    401: 34, 402: 67, 403: 100,
    501: 75, 502: 100,
}

PRIORITY_ORDER = [("critical", 1), ("high", 2), ("medium", 3), ("low", 4)]
FUNNEL_STAGES = [("Total Invoices", 1), ("Collected Invoices", 2), ("On-Time Invoices", 3)]
CONTRACT_ORDER = {"Month-to-month": 1, "One year": 2, "Two year": 3}
CONTRACT_ORDER_OTHER = 99

# ----------------------------------------------------------------------------------------


def _table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """Literal rows as a local relation: part of the plan, with a known size."""
    return spark.createDataFrame(pa.table([pa.array(c) for c in zip(*rows)], names))


def locations(spark: SparkSession) -> DataFrame:
    """The location dimension (S8): one row per city with its label."""
    names = ["location_key", "city", "region", "latitude", "longitude", "quality_factor"]
    return _table(spark, LOCATIONS, names).withColumns(
        {
            "state": F.lit(STATE),
            "country": F.lit(COUNTRY),
            "location_label": F.concat_ws(", ", "city", F.lit(STATE), F.lit(COUNTRY)),
        }
    )


def location_thresholds(spark: SparkSession) -> DataFrame:
    """Half-open bucket range ``[lo, hi)`` of every location within its region."""
    rows, last_region, lo = [], None, 0
    for key, _, region, *_ in LOCATIONS:
        lo = lo if region == last_region else 0
        rows.append((region, lo, LOCATION_LIMITS[key], key))
        last_region, lo = region, LOCATION_LIMITS[key]
    return _table(spark, rows, ["region", "lo", "hi", "location_key"])


def priorities(spark: SparkSession) -> DataFrame:
    """Display order of the complaint priorities."""
    return _table(spark, PRIORITY_ORDER, ["priority", "priority_sort"])


def funnel_stages(spark: SparkSession) -> DataFrame:
    """Stages of the invoice funnel."""
    return _table(spark, FUNNEL_STAGES, ["stage", "stage_order"])
