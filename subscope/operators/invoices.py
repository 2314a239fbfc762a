"""Invoice generation per customer and month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from subscope.functions import columns as C

TAX_RATE = 0.14


def monthly(df: DataFrame, start: Column, months: int) -> DataFrame:
    """One row per input row and month, as a generated sequence rather than a join."""
    last = F.add_months(start, months - 1)
    spine = F.sequence(start, last, F.expr("interval 1 month"))
    return df.withColumn("billing_month", F.explode(spine))


def with_amounts(df: DataFrame, charge="monthly_charges", usage="usage_charges", discount="discount_amount") -> DataFrame:
    """Taxable amount (not below 0), tax and total (P37). Ties round to even, as in numpy."""
    taxable = F.greatest(F.col(charge) + F.col(usage) - F.col(discount), F.lit(0.0))
    return (
        df.withColumn("_taxable", taxable)
        .withColumn("tax_amount", F.bround(F.col("_taxable") * TAX_RATE, 2))
        .withColumn("total_amount", F.bround(F.col("_taxable") + F.col("tax_amount"), 2))
        .drop("_taxable")
    )


def payment_date(status: Column, paid_on: Column) -> Column:
    """No payment date on unpaid invoices."""
    return F.when(F.lower(F.trim(status)) != "unpaid", paid_on)


ROWS_PER_SLOT = 200_000


def sequential_ids(
    df: DataFrame,
    order: Sequence[str],
    pattern: str,
    name: str,
    slots: int | None = None,
    bucket_method: str = "xxhash64",
) -> DataFrame:
    """Gap-free ids 1..n in key order, formatted by ``pattern``.

    Rows are ranked inside hash slots of the unique key and shifted by the slot's offset, so
    no single task numbers the whole table. Numbers follow slot, then key, order. Without
    ``slots`` there is one for each ``ROWS_PER_SLOT`` rows, so a task's share does not grow.
    """
    if slots is None:
        slots = max(1, -(-df.count() // ROWS_PER_SLOT))
    placed = df.withColumn("_slot", C.hash_bucket(list(order), slots, bucket_method))
    sizes = placed.groupBy("_slot").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_slot", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    rank = F.row_number().over(W.partitionBy("_slot").orderBy(*order))
    return (
        placed.withColumn("_rank", rank)
        .join(offsets, "_slot")
        .withColumn(name, F.format_string(pattern, F.col("_offset") + F.col("_rank")))
        .drop("_slot", "_rank", "_offset")
    )
