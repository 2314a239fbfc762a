"""Numbers scaled and categories encoded for the churn models, fitted by exact statistics.

The fit is two small tables, (column, median, mean, deviation) and (column, value, slot). Numbers
get the median for a missing value, then mean 0 and deviation 1 by the divisor n; a constant column
is only centred. Categories get the most frequent value for a missing one (the smallest on ties) and
one slot for each value, in the order of the values; values that the fit has not seen get no slot.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from subscope.operators import stats

#: Entries of the dictionary that are sent to every task at most; a larger one is joined.
SENT = 1_000_000
MISSING = "missing"


class Encoding(NamedTuple):
    """A fit, read from its folder; the driver holds a few figures for each column."""

    numeric: dict[str, tuple[float, float, float]]
    fill: dict[str, str]
    sizes: dict[str, int]
    dictionary: DataFrame

    def scaled(self, df: DataFrame, name: str = "{}") -> DataFrame:
        """``df`` with the numbers imputed and standardised, under ``name``."""
        out = {}
        for c, (median, mean, deviation) in self.numeric.items():
            v = F.coalesce(stats.present(c), F.lit(median))
            out[name.format(c)] = (v - F.lit(mean)) / F.lit(deviation or 1.0)
        return df.withColumns(out)

    def encode(self, df: DataFrame) -> DataFrame:
        """``df`` with the vector ``features``."""
        own = df.columns
        slots = {c: f"_{c}_slot" for c in self.fill}
        hots = {c: f"_{c}_hot" for c in self.fill}
        df = self.scaled(df, "_{}_scaled")
        few = sum(self.sizes.values()) <= SENT
        for c, slot in slots.items():
            part = self.dictionary.filter(F.col("column") == c).select(F.col("value").alias("_value"), F.col("slot").cast("double").alias(slot))
            df = df.join(F.broadcast(part) if few else part, F.coalesce(F.col(c), F.lit(self.fill[c])) == F.col("_value"), "left").drop("_value")
            # the slot after the last one, which the encoder leaves out
            df = df.withColumn(slot, F.coalesce(slot, F.lit(float(self.sizes[c]))))
        # the encoder takes the number of slots from the rows it is fitted on
        last = df.sparkSession.createDataFrame([tuple(float(n) for n in self.sizes.values())], ", ".join(f"`{slots[c]}` double" for c in self.sizes))
        hot = OneHotEncoder(inputCols=list(slots.values()), outputCols=list(hots.values()), dropLast=True).fit(last)
        numbers = [f"_{c}_scaled" for c in self.numeric]
        return VectorAssembler(inputCols=[*numbers, *hots.values()], outputCol="features").transform(hot.transform(df)).select(*own, "features")

    def names(self) -> DataFrame:
        """(place, feature_name) of every element of the vector."""
        spark = self.dictionary.sparkSession
        numbers = spark.createDataFrame([(k, f"numeric__{c}") for k, c in enumerate(self.numeric)], "place long, feature_name string")
        starts, at = [], len(self.numeric)
        for c, n in self.sizes.items():
            starts.append((c, at))
            at += n
        places = self.dictionary.join(F.broadcast(spark.createDataFrame(starts, "column string, first long")), "column")
        return numbers.unionByName(
            places.select((F.col("first") + F.col("slot")).alias("place"), F.concat_ws("_", F.concat(F.lit("categorical__"), "column"), "value").alias("feature_name"))
        )


def numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, median, mean, deviation of the numbers after imputation (L3)."""
    spark = df.sparkSession
    # one figure for each column
    median = {r["column"]: r["median"] for r in stats.medians(df, columns).collect()}
    filled = {c: F.coalesce(stats.present(c), F.lit(float(median.get(c) or 0.0))) for c in columns}
    row = df.agg(*[F.avg(v).alias(f"{c}__mean") for c, v in filled.items()], *[F.stddev_pop(v).alias(f"{c}__deviation") for c, v in filled.items()]).first()
    rows = [(c, float(median.get(c) or 0.0), float(row[f"{c}__mean"] or 0.0), float(row[f"{c}__deviation"] or 0.0)) for c in columns]
    return spark.createDataFrame(rows, "column string, median double, mean double, deviation double")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, value, count of several columns from one scan."""
    cell = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")
    return df.select(cell).groupBy("x.column", "x.value").agg(F.count(F.lit(1)).alias("count"))


def modes(counts: DataFrame) -> DataFrame:
    """column, mode: the most frequent value, the smallest on ties (L4)."""
    best = F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("count")).alias("n"), "value")))["value"]
    return counts.groupBy("column").agg(F.coalesce(best, F.lit(MISSING)).alias("mode"))


def dictionary(counts: DataFrame) -> DataFrame:
    """column, value, slot: the values of every column, counted through in their order."""
    nothing = counts.groupBy("column").agg(F.count("value").alias("n")).filter("n = 0").select("column", F.lit(MISSING).alias("value"))
    values = counts.filter(F.col("value").isNotNull()).select("column", "value").unionByName(nothing)
    return values.withColumn("slot", (F.row_number().over(W.partitionBy("column").orderBy("value")) - 1).cast("long"))


def fit(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], folder: str) -> Encoding:
    """Fits, writes and reads back an encoding."""
    numbers(train, numeric).write.parquet(f"{folder}/numbers")
    value_counts(train, categorical).write.parquet(f"{folder}/values")
    counts = train.sparkSession.read.parquet(f"{folder}/values")
    modes(counts).write.parquet(f"{folder}/modes")
    dictionary(counts).write.parquet(f"{folder}/dictionary")
    return load(train.sparkSession, folder, numeric, categorical)


def load(spark: SparkSession, folder: str, numeric: Sequence[str], categorical: Sequence[str]) -> Encoding:
    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    figures = {r["column"]: (r["median"], r["mean"], r["deviation"]) for r in read("numbers").collect()}
    fill = {r["column"]: r["mode"] for r in read("modes").collect()}
    sizes = {r["column"]: r["count"] for r in read("dictionary").groupBy("column").count().collect()}
    return Encoding({c: figures[c] for c in numeric}, {c: fill.get(c, MISSING) for c in categorical}, {c: sizes.get(c, 0) for c in categorical}, read("dictionary"))
