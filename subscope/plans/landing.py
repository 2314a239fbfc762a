"""Files to bronze: four raw feeds into lineage-stamped tables that a warehouse builds on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from subscope.operators import ingest, quality
from subscope.plans.warehouse import Warehouse
from subscope.sources import files, schemas
from subscope.store import LayerStore
from subscope.streaming import ingest as streams

# feed -> (file or folder, source system, reader)
BATCH_FEEDS: dict[str, tuple[str, str, Callable[[SparkSession, str], DataFrame]]] = {
    "customers_raw": ("customers", "CRM", files.customers),
    "billing_raw": ("billing", "Billing System", files.billing),
    "complaints_raw": ("complaints", "Complaints System", files.complaints),
}
STREAM_FEED = ("network_events_raw", "network_events")


class Landing:
    """Ingests a landing folder: full refresh of the batch feeds, incremental network events."""

    def __init__(self, spark: SparkSession, folder: str, store: LayerStore):
        self.spark, self.folder, self.store = spark, folder.rstrip("/"), store.create_layers()
        self._events = f"{store.root}/bronze_stream/{STREAM_FEED[0]}"

    def ingest(self) -> "Landing":
        """One run. All batch feeds share a batch id; network files are read once ever."""
        batch_id = ingest.new_batch_id()
        for table, (name, system, read) in BATCH_FEEDS.items():
            rows = read(self.spark, f"{self.folder}/{name}")
            self.store.write(ingest.add_metadata(rows, system, batch_id), "bronze", table)
        streams.ingest_network_events(
            self.spark,
            f"{self.folder}/{STREAM_FEED[1]}",
            self._events,
            f"{self._events}_checkpoint",
            schemas.NETWORK_EVENTS,
        )
        return self

    def bronze(self, table: str) -> DataFrame:
        if table == STREAM_FEED[0]:
            return self.spark.read.parquet(self._events)
        return self.store.read("bronze", table)

    def quality_reports(self) -> dict[str, DataFrame]:
        """The quality report of every raw table."""
        return {
            "customers_raw": quality.raw_customers(self.bronze("customers_raw")),
            "billing_raw": quality.raw_billing(self.bronze("billing_raw")),
            "complaints_raw": quality.raw_complaints(self.bronze("complaints_raw")),
            "network_events_raw": quality.raw_network(self.bronze("network_events_raw")),
        }

    def warehouse(self, bucket_method: str = "xxhash64") -> Warehouse:
        """Silver and gold over the bronze tables as they are now."""
        names = [*BATCH_FEEDS, STREAM_FEED[0]]
        sources = {n: (lambda n=n: self.bronze(n)) for n in names}
        return Warehouse(self.spark, sources, self.store, bucket_method)
