"""Builds the bronze, silver and gold layers, each table once, when it is first needed.

Every consumer reads written tables: the large sources are conformed once per refresh rather
than once per question, questions scan partitioned columnar facts, and a lost executor costs
a re-read instead of the whole lineage.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.operators import conform, enrich, ingest, kpi, quality, rollup, scoring, star
from subscope.plans import churn
from subscope.session import work_dir
from subscope.sources import calendars, lookups, tables
from subscope.store import LayerStore, Sink


# When a table was processed, in the column its readers know. Summaries carry no stamp, so that
# joining them to a stamped table leaves one stamp.
_SILVER, _GOLD = "_silver_processed_at", "_gold_created_at"
STAMPS = {
    "customers_clean": _SILVER,
    "billing_judged": _SILVER,
    "complaints_judged": _SILVER,
    "network_events_judged": _SILVER,
    "customer_360": "_customer_360_created_at",
    "dim_customer": _GOLD,
    "fact_billing": _GOLD,
    "fact_complaints": _GOLD,
    "network_placed": _GOLD,
    "customer_churn_analytics": _GOLD,
    "customer_churn_predictions": "prediction_timestamp",
    "high_risk_customers": _GOLD,
    "customer_ml_features": "_feature_created_at",
    "executive_kpis": _GOLD,
    "revenue_risk_by_segment": _GOLD,
    "network_performance_by_region": _GOLD,
    "network_performance_by_cabinet": _GOLD,
}


# Clean source and date column of every fact and date role that the calendar spans.
DAYS = {
    "billing": ("billing_clean", "billing_month"),
    "payment": ("billing_clean", "payment_date"),
    "complaints": ("complaints_clean", "opened_at"),
    "network": ("network_events_clean", "event_timestamp"),
}
NETWORK_FACTS = ("fact_network_events", "fact_network_cabinets", "fact_network_cities")


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        raw: Mapping[str, Callable[[], DataFrame]],
        store: LayerStore,
        bucket_method: str = "xxhash64",
    ):
        self.spark, self.raw_sources, self.store = spark, raw, store.create_layers()
        self.bucket_method = bucket_method
        self._built: set[tuple[str, str]] = set()
        self._runs: list[dict] = []
        self._encoded: churn.Prepared | None = None

    def raw(self, name: str) -> DataFrame:
        """A raw source as it arrives, not copied."""
        return self.raw_sources[name]()

    def _table(self, layer, name, build, partition_by=(), **how):
        if (layer, name) not in self._built:
            df = build()
            if name in STAMPS:
                df = ingest.stamped(df, STAMPS[name])
            self.store.write(df, layer, name, partition_by, **how)
            self._built.add((layer, name))
        return self.store.read(layer, name)

    def _pass(self, layer, table, sinks, name, build, **how) -> DataFrame:
        """A logical table that one write fills together with others."""
        if (layer, table) not in self._built:
            df, views = build()
            stamp = STAMPS[table]
            views = {n: v._replace(columns=[*v.columns, stamp]) for n, v in views.items()}
            assert set(views) == set(sinks)
            self.store.write(ingest.stamped(df, stamp), layer, table, sinks=views, **how)
            self._built.add((layer, table))
        return self.store.read(layer, name)

    def _judged(self, source: str) -> tuple[DataFrame, dict[str, Sink]]:
        """Candidates of a source and the two tables they go to."""
        raw, candidates, rules, flags = conform.JUDGED[source]
        placed = raw.replace("_raw", "_placed")
        df = candidates(self.raw(placed if placed in self.raw_sources else raw))
        own = df.columns
        df = quality.judged(conform.with_flags(df, flags()), rules())
        return df, {
            f"{source}_clean": Sink([*own, *flags()], f"outcome = '{quality.ACCEPTED}'"),
            f"{source}_quarantine": Sink([*own, "broken_rules"], f"outcome = '{quality.QUARANTINED}'"),
        }

    def silver(self, name: str) -> DataFrame:
        for source in conform.JUDGED:
            sinks = (f"{source}_clean", f"{source}_quarantine")
            if name in sinks:
                return self._pass("silver", f"{source}_judged", sinks, name, lambda: self._judged(source), partition_by=("outcome",), rebalance=False)
        builders = {
            "customers_clean": lambda: conform.customers_clean(self.raw("customers_raw")),
            "customer_billing_summary": lambda: rollup.billing_summary(self.silver("billing_clean")),
            "customer_complaints_summary": lambda: rollup.complaints_summary(
                self.silver("complaints_clean")
            ),
            "customer_network_summary": lambda: rollup.network_summary(
                self.silver("network_events_clean")
            ),
            "customer_360": lambda: rollup.customer_360(
                self.silver("customers_clean"),
                self.silver("customer_billing_summary"),
                self.silver("customer_complaints_summary"),
                self.silver("customer_network_summary"),
            ),
        }
        return self._table("silver", name, builders[name])

    def _placed(self) -> tuple[DataFrame, dict[str, Sink]]:
        dim = self.gold("dim_customer")
        events = star.fact_network_events(self.silver("network_events_clean"), dim)
        return enrich.placed(self.spark, events, dim, self.bucket_method)

    def gold(self, name: str) -> DataFrame:
        monthly = ("month_key",)
        if name in NETWORK_FACTS:
            return self._pass("gold", "network_placed", NETWORK_FACTS, name, self._placed, partition_by=monthly)
        builders = {
            "dim_customer": (lambda: star.dim_customer(self.silver("customers_clean")), ()),
            "dim_network_location": (lambda: lookups.locations(self.spark), ()),
            "fact_days": (self._fact_days, ()),
            "dim_date": (self._dim_date, ()),
            "fact_billing": (
                lambda: star.fact_billing(
                    self.silver("billing_clean"), self.gold("dim_customer"), by_month=True
                ),
                monthly,
            ),
            "fact_complaints": (
                lambda: star.fact_complaints(
                    self.silver("complaints_clean"), self.gold("dim_customer"), by_month=True
                ),
                monthly,
            ),
            "customer_churn_analytics": (
                lambda: scoring.churn_analytics(self.silver("customer_360")),
                (),
            ),
            "customer_churn_predictions": (
                lambda: scoring.rule_based_predictions(self.gold("customer_churn_analytics")),
                (),
            ),
            "high_risk_customers": (
                lambda: scoring.retention_list(
                    self.gold("customer_churn_analytics"), self.gold("customer_churn_predictions")
                ),
                (),
            ),
            "customer_ml_features": (
                lambda: rollup.ml_features(self.gold("customer_churn_analytics")),
                (),
            ),
            "executive_kpis": (
                lambda: kpi.executive(self.gold("customer_churn_analytics")).withColumn(
                    "snapshot_date", F.current_date()
                ),
                (),
            ),
            "revenue_risk_by_segment": (
                lambda: kpi.by_segment(self.gold("customer_churn_analytics")),
                (),
            ),
            "network_performance_by_region": (
                lambda: kpi.by_region_weighted(self.gold("fact_network_cities")),
                (),
            ),
            "network_performance_by_cabinet": (
                lambda: kpi.by_cabinet(self.gold("fact_network_cabinets")),
                (),
            ),
        }
        build, partition_by = builders[name]
        # both facts are laid out by month before they get their keys
        return self._table("gold", name, build, partition_by, rebalance=False)

    def encoded(self) -> churn.Prepared:
        """The split and encoding that all models share."""
        if self._encoded is None:
            self._encoded = churn.prepare(self.gold("customer_ml_features"), work_dir(self.spark, "models"))
        return self._encoded

    def models(self, trees: int = 300, depth: int = 12, max_iter: int = 1000) -> dict[str, DataFrame]:
        """Train the churn models once and return the published tables, read back."""
        published = {
            "ml_runs": lambda: churn.run_table(self.spark, self._runs),
            "ml_model_performance": lambda: churn.performance(self.spark, self._runs),
            "ml_predictions": lambda: churn.publish(churn.best(self._runs)),
            "ml_feature_importance": lambda: churn.importance(self.spark, churn.best(self._runs)),
        }
        if not self._runs:
            self._runs = churn.fits(self.encoded(), trees, depth, max_iter)
        return {n: self._table("gold", n, build) for n, build in published.items()}

    def days(self, fact: str) -> DataFrame:
        """The days of one fact or date role. A fact has the rows and dates of its clean source, which
        is read instead, so that an anchor or the calendar lays out no fact by month."""
        source, column = DAYS[fact]
        build = lambda: calendars.fact_days({fact: (self.silver(source), column)})
        return self._table("gold", f"fact_days_{fact}", build)

    def _fact_days(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.days(fact) for fact in DAYS])

    def _dim_date(self) -> DataFrame:
        return calendars.date_dimension(calendars.spine_over([(self.gold("fact_days"), "day")]))


_open: dict[tuple[str, str], Warehouse] = {}


def of(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse over a folder of tables; one per application and folder."""
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    if key not in _open:
        prefix = f"subscope_{zlib.crc32(repr(key).encode()):08x}"
        store = LayerStore(spark, work_dir(spark, "layers"), prefix)
        # the sha2 buckets can be recomputed by any SQL engine, which the checks rely on
        _open[key] = Warehouse(spark, tables.raw_frames(spark, folder), store, "sha2")
    return _open[key]
