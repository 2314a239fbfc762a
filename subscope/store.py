"""Layered table store over the session catalog (K1-K7).

A logical table ``gold.x`` is a view over its newest version ``gold.x__v<n>``. Replacing a
table writes a new version and repoints the view, so a table can be rebuilt from itself, a
reader never sees a half-written table, and the previous version is a ready backup.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.operators import quality

LAYERS = {
    "bronze": "Raw records with lineage",
    "silver": "Conformed records and per-customer summaries",
    "gold": "Star schema, scores and KPIs",
}
#: How written tables are compressed: record hashes are long and written as digits.
CODEC = "zstd"


class Sink(NamedTuple):
    """A logical table over the rows of another that meet a condition: SQL columns and condition.
    The condition is true or false for every row, never NULL."""

    columns: Sequence[str]
    condition: str


class LayerStore:
    def __init__(self, spark: SparkSession, root: str, prefix: str, fmt: str = "parquet"):
        self.spark, self.root, self.prefix, self.fmt = spark, root.rstrip("/"), prefix, fmt
        self.written: dict[str, int] = {}

    def database(self, layer: str) -> str:
        return f"{self.prefix}_{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.database(layer)}.{table}"

    def create_layers(self) -> "LayerStore":
        """One database per layer, if absent (K6)."""
        for layer, comment in LAYERS.items():
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {self.database(layer)} "
                f"COMMENT '{comment}' LOCATION '{self.root}/{layer}'"
            )
        return self

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def versions(self, layer: str, table: str) -> list[int]:
        """Version numbers of a table, oldest first."""
        pattern = re.compile(re.escape(table) + r"__v(\d+)$")
        found = (pattern.match(t.name) for t in self.spark.catalog.listTables(self.database(layer)))
        return sorted(int(m.group(1)) for m in found if m)

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def read_version(self, layer: str, table: str, version: int) -> DataFrame:
        return self.spark.table(f"{self.name(layer, table)}__v{version}")

    def write(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        partition_by: Sequence[str] = (),
        rebalance: bool = True,
        sinks: Mapping[str, Sink] | None = None,
    ) -> DataFrame:
        """Full refresh with schema replacement (K1, K4); returns the written table.

        Rows are counted by the write itself (K8). A partitioned table is rebalanced on its
        partition columns first: AQE splits a hot partition over several tasks and packs small
        ones, so files are neither tiny nor written by one task. A few partitions that every task
        has rows of need no ``rebalance``. ``sinks`` are logical tables over the same rows, so that
        one pass fills all of them; each is counted by the same write.
        """
        version = max(self.versions(layer, table), default=0) + 1
        target = f"{self.name(layer, table)}__v{version}"
        if partition_by and rebalance:
            df = df.hint("rebalance", *partition_by)
        sinks = dict(sinks or {})
        counts = [F.count_if(F.expr(sink.condition)).alias(f"rows_{k}") for k, sink in enumerate(sinks.values())]
        df, seen = quality.audited(df, f"{table}_v{version}", counts)
        writer = df.write.mode("overwrite").format(self.fmt).option("compression", CODEC)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(target)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(layer, table)} AS SELECT * FROM {target}")
        self.written[self.name(layer, table)] = int(seen.get["record_count"])
        for k, (name, sink) in enumerate(sinks.items()):
            columns = ", ".join(sink.columns)
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(layer, name)} AS SELECT {columns} FROM {target} WHERE {sink.condition}")
            self.written[self.name(layer, name)] = int(seen.get[f"rows_{k}"] or 0)
        return self.read(layer, table)

    def append(self, df: DataFrame, layer: str, table: str) -> DataFrame:
        """Add rows to the newest version."""
        versions = self.versions(layer, table)
        if not versions:
            return self.write(df, layer, table)
        target = f"{self.name(layer, table)}__v{versions[-1]}"
        df.write.mode("append").format(self.fmt).option("compression", CODEC).saveAsTable(target)
        return self.read(layer, table)

    def backup_if_absent(self, layer: str, table: str, label: str, renew: bool = False) -> DataFrame:
        """Keep the current state under ``<table>_<label>`` unless it is kept already (K3).

        A kept state stays, because the live table may have been enriched since. ``renew`` keeps
        the current state as a new version; earlier versions can still be read by their number.
        """
        name = f"{table}_{label}"
        if self.exists(layer, name) and not renew:
            return self.read(layer, name)
        return self.write(self.read(layer, table), layer, name)

    def first_existing(self, layer: str, tables: Sequence[str]) -> DataFrame:
        """The first of the tables that exists (K5): a clean backup before the live table."""
        for table in tables:
            if self.exists(layer, table):
                return self.read(layer, table)
        raise LookupError(f"none of {list(tables)} exists in {self.database(layer)}")

    def drop_old_versions(self, layer: str, table: str, keep: int = 2) -> list[int]:
        """Drop all but the newest versions of one table."""
        old = self.versions(layer, table)[:-keep] if keep else self.versions(layer, table)
        for version in old:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, table)}__v{version}")
        return old

    def listing(self) -> DataFrame:
        """Layer and table name of every logical table (K7)."""
        rows = [
            (layer, t.name)
            for layer in LAYERS
            for t in self.spark.catalog.listTables(self.database(layer))
            if t.tableType == "VIEW"
        ]
        return self.spark.createDataFrame(rows, "layer string, table_name string")


def preview(df: DataFrame, n: int = 10, order: Sequence[str] = ()) -> DataFrame:
    """First rows for a look (K9), the same ones each time if an order is named."""
    return (df.orderBy(*order) if order else df.select(F.expr("*"))).limit(n)
