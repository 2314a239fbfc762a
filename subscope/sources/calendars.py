"""Date spines, calendars and the date dimension."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.functions import columns as C


def _days(bounds: DataFrame) -> DataFrame:
    """One row per day of the single ``(start, end)`` row, however far apart: all dates that can be
    written are 3.7 million days."""
    return bounds.filter(F.col("start").isNotNull() & F.col("end").isNotNull()).select(
        F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("full_date")
    )


def spine(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Every date from start to end, both included."""
    return _days(
        spark.range(1).select(
            F.lit(str(start)).cast("date").alias("start"), F.lit(str(end)).cast("date").alias("end")
        )
    )


def span(frames: list[tuple[DataFrame, str]]) -> DataFrame:
    """One row with the first and last date found in any of the given date columns."""
    bounds = None
    for df, c in frames:
        part = df.agg(
            F.min(F.to_date(c)).alias("first_date"), F.max(F.to_date(c)).alias("last_date")
        )
        bounds = part if bounds is None else bounds.unionByName(part)
    return bounds.agg(F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))


def spine_over(frames: list[tuple[DataFrame, str]]) -> DataFrame:
    """Every date between the first and the last date of the given columns."""
    return _days(
        span(frames).select(F.col("first_date").alias("start"), F.col("last_date").alias("end"))
    )


def fact_days(facts: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """The days on which each fact has rows: bounded by the calendar, however large the facts."""
    parts = [
        df.groupBy(F.to_date(c).alias("day"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("fact"), "day", "rows")
        for name, (df, c) in facts.items()
    ]
    return reduce(DataFrame.unionByName, parts).filter(F.col("day").isNotNull())


def calendar_for(df: DataFrame, date_column: str) -> DataFrame:
    """Whole-year calendar around one date column, with its drill hierarchy."""
    years = span([(df, date_column)])
    days = _days(
        years.select(
            F.make_date(F.year("first_date"), F.lit(1), F.lit(1)).alias("start"),
            F.make_date(F.year("last_date"), F.lit(12), F.lit(31)).alias("end"),
        )
    )
    return days.select(
        F.col("full_date").alias("date"), *[c.alias(n) for n, c in hierarchy("full_date").items()]
    )


def hierarchy(d: str | Column) -> dict[str, Column]:
    """Year, quarter, month and day levels of a date, for ``rollup`` drill-down."""
    d = C.col(d)
    quarter = F.floor((F.month(d) + 2) / 3).cast("int")
    return {
        "year": F.year(d),
        "month_no": F.month(d),
        "month": F.date_format(d, "MMMM"),
        "quarter_no": quarter,
        "quarter": F.concat(F.lit("Qtr "), quarter.cast("string")),
        "day": F.dayofmonth(d),
    }


def attributes(d: str | Column) -> dict[str, Column]:
    """Attributes of the date dimension, with the two ordinal sort keys."""
    d = C.col(d)
    return {
        "date_key": C.date_key(d),
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month_number": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "year_month": F.date_format(d, "yyyy-MM"),
        "week_number": F.weekofyear(d),
        "day_of_month": F.dayofmonth(d),
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": C.flag(F.dayofweek(d).isin(1, 7)),
        "year_month_sort": C.month_key(d),
        "day_of_week_number": F.weekday(d) + 1,
    }


def date_dimension(days: DataFrame) -> DataFrame:
    """The date dimension over a spine: one row per ``full_date``."""
    parts = attributes("full_date")
    return days.select(
        parts.pop("date_key").alias("date_key"),
        "full_date",
        *[c.alias(name) for name, c in parts.items()],
    )
