"""Network fact enrichment: access technology, cabinets, new regions, cities, quality factors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.functions import columns as C
from subscope.sources import lookups
from subscope.store import Sink

FIBER = ("fiber optic", "fiber", "fiber-optic")
# Customers up to which their services may be sent to every task, if Spark finds them small.
FEW = 100_000


def access_technology(service: str | Column) -> Column:
    """DSL, Fiber Optic, or NULL for customers without fixed access."""
    s = F.lower(F.trim(C.col(service)))
    return F.when(s == "dsl", "DSL").when(s.isin(*FIBER), "Fiber Optic")


def has_fixed_access(service: str | Column) -> Column:
    return F.lower(F.trim(C.col(service))).isin("dsl", *FIBER)


def region_code(region: str | Column) -> Column:
    """Three-letter code of a region, UNK when unknown."""
    return C.remap(region, lookups.REGION_CODES, lookups.UNKNOWN_REGION_CODE)


def new_region(region: str | Column) -> Column:
    """Renamed region; others stay as they are."""
    return C.remap(region, lookups.REGION_REMAP)


def with_service(events: DataFrame, dim: DataFrame) -> DataFrame:
    """Left lookup of the customer's internet service by surrogate key (J3), which is unique.

    Customers are counted first: packed files make them look small, and more than ``FEW`` are not sent."""
    service = dim.select("customer_key", "internet_service")
    return events.join(service if service.count() <= FEW else service.hint("merge"), "customer_key", "left")


CABINET = ["access_technology", "cabinet_id", "cabinet_type"]


def cabinet_columns(df: DataFrame, bucket_method: str) -> DataFrame:
    """Access technology and cabinet of events with their customer's service; NULL without fixed access."""
    dsl = F.col("access_technology") == "DSL"
    number = C.hash_bucket(["customer_id", "region", "access_technology"], 100, bucket_method) + 1
    name = F.concat(
        F.lit("CAB-"),
        F.when(dsl, "DSL").otherwise("FBR"),
        F.lit("-"),
        region_code("region"),
        F.lit("-"),
        F.lpad(number.cast("string"), 3, "0"),
    )
    fixed = F.col("access_technology").isNotNull()
    return df.withColumn("access_technology", access_technology("internet_service")).withColumns(
        {
            "cabinet_id": F.when(fixed, name),
            "cabinet_type": F.when(fixed, F.when(dsl, "DSL Cabinet").otherwise("Fiber Cabinet")),
        }
    )


def with_cabinets(events: DataFrame, dim: DataFrame, bucket_method: str = "xxhash64") -> DataFrame:
    """Keep fixed-access events and assign each a cabinet.

    The result has the input's columns plus three; running it on its own result is safe.
    """
    kept = [c for c in events.columns if c not in CABINET]
    placed = cabinet_columns(with_service(events.select(*kept), dim), bucket_method)
    return placed.filter(F.col("access_technology").isNotNull()).select(*kept, *CABINET)


def assign_weighted(df: DataFrame, bucket: Column, thresholds: DataFrame, region: str = "region") -> DataFrame:
    """Left range lookup (P28): the location whose ``[lo, hi)`` holds the bucket of the region.

    Buckets are whole percents, so the range table is unrolled to one row per (region, bucket),
    at most 100 per region, and becomes a plain equality join. The number of regions is the
    caller's, so the table's size, not a hint, decides whether it is broadcast.
    """
    cells = thresholds.select(
        F.col("region").alias("_region"),
        "location_key",
        F.explode(F.sequence("lo", F.col("hi") - 1)).alias("_cell"),
    )
    return (
        df.withColumn("_bucket", bucket.cast("int"))
        .join(
            cells,
            (F.col(region) == F.col("_region")) & (F.col("_bucket") == F.col("_cell")),
            "left",
        )
        .drop("_region", "_cell", "_bucket")
    )


def quality_scaled(factor: str = "quality_factor") -> dict[str, Column]:
    """The network measurements scaled by a quality factor, with clamps."""
    f = F.col(factor)
    return {
        "latency_ms": F.round(F.col("latency_ms") * f, 2),
        "packet_loss_pct": F.round(F.least(F.lit(100.0), F.col("packet_loss_pct") * f), 2),
        "download_speed_mbps": F.round(F.greatest(F.lit(0.1), F.col("download_speed_mbps") / f), 2),
        "outage_minutes": F.round(F.col("outage_minutes") * f).cast("long"),
    }


def scaled_by_quality(df: DataFrame, factor: str = "quality_factor") -> DataFrame:
    return df.withColumns(quality_scaled(factor))


def city_columns(spark: SparkSession, df: DataFrame, bucket_method: str, region: str = "region") -> DataFrame:
    """The city's location and quality factor of events whose renamed region is ``region``."""
    bucket = C.hash_bucket(["customer_id", F.lit(lookups.CITY_BUCKET_SALT)], 100, bucket_method)
    placed = assign_weighted(df, bucket, lookups.location_thresholds(spark), region)
    # fourteen fixed rows
    factors = lookups.locations(spark).select("location_key", "quality_factor")
    return placed.join(F.broadcast(factors), "location_key", "left")


def with_cities(
    spark: SparkSession, events: DataFrame, dim: DataFrame, bucket_method: str = "xxhash64"
) -> DataFrame:
    """Rename regions, keep fixed access, place customers in cities, scale by city."""
    kept = [c for c in events.columns if c != "location_key"]
    served = with_service(events.withColumn("region", new_region("region")).select(*kept), dim)
    placed = city_columns(spark, served.filter(has_fixed_access("internet_service")), bucket_method)
    return scaled_by_quality(placed).select(*kept, "location_key")


def placed(
    spark: SparkSession, events: DataFrame, dim: DataFrame, bucket_method: str = "xxhash64"
) -> tuple[DataFrame, dict[str, Sink]]:
    """All events with cabinet and city columns from one lookup of the service (P21-P29, J3), and
    the three facts that read them: the events move once, however many facts there are."""
    own = list(events.columns)
    scaled = quality_scaled()
    served = cabinet_columns(with_service(events, dim), bucket_method).withColumn("_city_region", new_region("region"))
    df = city_columns(spark, served, bucket_method, "_city_region")
    city = {"region": "_city_region"} | {c: f"_city_{c}" for c in scaled}
    df = df.withColumns({f"_city_{c}": value for c, value in scaled.items()})
    df = df.select(*own, *CABINET, *city.values(), "location_key")
    fixed = "access_technology IS NOT NULL"
    return df, {
        "fact_network_events": Sink(own, "true"),
        "fact_network_cabinets": Sink([*own, *CABINET], fixed),
        "fact_network_cities": Sink([*(f"{city[c]} AS {c}" if c in city else c for c in own), "location_key"], fixed),
    }
