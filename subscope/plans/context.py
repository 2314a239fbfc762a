"""Star model, filter context and time windows that measures are evaluated in."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscope.functions import columns as C
from subscope.operators import scoring
from subscope.sources import calendars

# Columns are named "table.column" with these table names.
CUSTOMER_TABLES = ("dim_customer", "predictions", "retention")
FACT_DATES = {"billing": "billing_month", "complaints": "opened_at", "network": "event_timestamp"}
# Further dates of a fact, by role; each is a relationship to the calendar that a context can activate.
DATE_ROLES = {("billing", "payment"): "payment_date"}
# Tables whose selections reach each measure table. Facts never filter dimensions.
REACH = {
    "customers": CUSTOMER_TABLES,
    "billing": ("billing", "dim_date", *CUSTOMER_TABLES),
    "complaints": ("complaints", "dim_date", *CUSTOMER_TABLES),
    "network": ("network", "dim_date", "dim_network_location", *CUSTOMER_TABLES),
    "dates": ("dim_date",),
}


def table_of(ref: str) -> str:
    return ref.split(".", 1)[0]


def column_of(ref: str) -> str:
    return ref.split(".", 1)[1]


def flat(ref: str) -> str:
    return ref.replace(".", "__")


@dataclass(frozen=True)
class FilterContext:
    """What the user has selected: a date range and allowed values per dimension column.

    ``date_roles`` names the date by which a fact is seen where it is not its first one
    (``{"billing": "payment"}``). Rows without that date belong to no day.

    ``anchor`` says which day is "today" for month and year windows: the last selected day of
    the calendar, or the last day on which the fact has data.
    """

    date_from: str | None = None
    date_to: str | None = None
    filters: Mapping[str, Sequence[object]] = field(default_factory=dict)
    anchor: str = "last_data"
    date_roles: Mapping[str, str] = field(default_factory=dict)

    def in_range(self, d: Column) -> Column:
        conditions = []
        if self.date_from:
            conditions.append(d >= F.lit(self.date_from).cast("date"))
        if self.date_to:
            conditions.append(d <= F.lit(self.date_to).cast("date"))
        return C.all_of(conditions)


def date_column(fact: str, ctx: FilterContext) -> str:
    """The column that relates a fact to the calendar in a context."""
    role = ctx.date_roles.get(fact)
    if role is None:
        return FACT_DATES[fact]
    if (fact, role) not in DATE_ROLES:
        raise ValueError(f"{fact} has no date role {role!r}")
    return DATE_ROLES[fact, role]


def allowed(c: Column, values: Sequence[object]) -> Column:
    plain = [v for v in values if v is not None]
    keep = c.isin(*plain) if plain else F.lit(False)
    return keep | c.isNull() if None in values else keep


@dataclass(frozen=True)
class StarModel:
    """The gold tables the measures read, by name, each looked up when it is needed."""

    table: Callable[[str], DataFrame]
    #: The days of one fact or date role, where they can be had without the other facts.
    days: Callable[[str], DataFrame] | None = None

    @staticmethod
    def of(warehouse) -> "StarModel":
        names = {
            "predictions": "customer_churn_predictions",
            "retention": "high_risk_customers",
            "billing": "fact_billing",
            "complaints": "fact_complaints",
            "network": "fact_network_cities",
        }
        return StarModel(lambda name: warehouse.gold(names.get(name, name)), warehouse.days)

    def fact(self, name: str, ctx: FilterContext = FilterContext()) -> DataFrame:
        return self.table(name).withColumn("_day", F.to_date(date_column(name, ctx)))

    def dates(self, ctx: FilterContext) -> DataFrame:
        return self.table("dim_date").filter(ctx.in_range(F.col("full_date")))

    def customers(self, refs: Sequence[str]) -> DataFrame:
        """One row per customer with the referenced columns, named ``table__column``.

        The customer tables are one to one, so a selection on any of them restricts all.
        """
        out = None
        for table in CUSTOMER_TABLES:
            wanted = sorted({column_of(r) for r in refs if table_of(r) == table} - {"customer_id"})
            if not wanted and table not in {table_of(r) for r in refs}:
                continue
            df = self.table(table)
            if table == "predictions" and "prediction_outcome" in wanted:
                df = scoring.with_outcome(df)
            part = df.select(
                "customer_id",
                F.col("customer_id").alias(f"{table}__customer_id"),
                *[F.col(c).alias(f"{table}__{c}") for c in wanted],
            )
            out = part if out is None else out.join(part, "customer_id", "full")
        return out

    def anchor_day(self, ctx: FilterContext, fact: str) -> dt.date | None:
        """The anchor date. It is looked up in tables no longer than the calendar and becomes a
        literal of the query, so that the facts' partitions are pruned while planning."""
        if ctx.anchor == "calendar":
            days = self.dates(ctx).select(F.col("full_date").alias("day"))
        elif ctx.anchor == "last_data":
            role = ctx.date_roles.get(fact, fact)
            days = self.days(role) if self.days else self.table("fact_days").filter(F.col("fact") == role)
            days = days.filter(ctx.in_range(F.col("day")))
        else:
            raise ValueError(f"unknown anchor {ctx.anchor!r}")
        return days.agg(F.max("day").alias("day")).first()["day"]


def month_windows(day: dt.date) -> dict[str, tuple[dt.date, dt.date]]:
    """First and last day of each time window around an anchor day."""
    first = day.replace(day=1)
    before = lambda d: (d - dt.timedelta(days=1)).replace(day=1)
    after = (first + dt.timedelta(days=31)).replace(day=1)
    last, previous = after - dt.timedelta(days=1), before(first)
    return {
        "latest": (first, last),
        "previous": (previous, first - dt.timedelta(days=1)),
        "rolling3": (before(previous), last),
        "ytd": (day.replace(month=1, day=1), day),
    }


def date_attribute(name: str) -> Column:
    """A date-dimension column as a function of the day, so that no join is needed."""
    if name == "full_date":
        return F.col("_day")
    return calendars.attributes("_day")[name]
