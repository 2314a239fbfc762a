"""Batch readers of the raw text sources (S1-S3) and the CRM preparation step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.functions import columns as C
from subscope.operators import stats
from subscope.sources import schemas


def read_csv(spark: SparkSession, path, schema, **options) -> DataFrame:
    """CSV with a header and a given schema; unparsable cells become NULL, no row is lost."""
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    return reader.options(**options).csv(path)


def read_json_lines(spark: SparkSession, path, schema, **options) -> DataFrame:
    """JSON Lines with a given schema; a broken line becomes an all-NULL row."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").options(**options).json(path)


def customers(spark: SparkSession, path) -> DataFrame:
    return read_csv(spark, path, schemas.CUSTOMERS)


def billing(spark: SparkSession, path) -> DataFrame:
    return read_json_lines(spark, path, schemas.BILLING)


def complaints(spark: SparkSession, path) -> DataFrame:
    return read_csv(spark, path, schemas.COMPLAINTS, timestampFormat="yyyy-MM-dd HH:mm:ss")


def require_columns(df: DataFrame, required) -> DataFrame:
    """Fail before any job runs if the source lacks a required column."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"source is missing columns: {missing}")
    return df


def prepare_crm(
    df: DataFrame, charge="MonthlyCharges", label="Churn", required=None
) -> DataFrame:
    """Check columns, coerce the charge to a number, fill gaps by the median, flag churn.

    The median is exact and comes in as a scalar subquery, so no row leaves the executors.
    """
    require_columns(df, required or ("customerID", charge, "PaymentMethod", label))
    coerced = df.withColumn(charge, F.col(charge).cast("string").try_cast("double"))
    median = stats.median(coerced, charge).scalar()
    return coerced.withColumn(charge, F.coalesce(F.col(charge), median)).withColumn(
        "churn_flag", C.flag(C.clean(label, "lower") == "yes")
    )
