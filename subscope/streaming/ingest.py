"""Incremental file ingestion: new files in, an append-only table out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from subscope.functions import columns as C
from subscope.operators import ingest

RESCUED = "_rescued_data"


def rescued(raw: Column, typed: Column, schema: T.StructType) -> Column:
    """JSON of what the schema could not take: unknown fields and values of another type.

    NULL when the record fits. A line that is not JSON at all is kept whole under its text.
    """
    fields = F.from_json(raw, "map<string,string>")
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    null_fields = F.array_compact(
        F.array(*[F.when(typed[f.name].isNull(), F.lit(f.name)) for f in schema.fields])
    )
    misfit = F.map_filter(
        fields,
        lambda k, v: ~F.array_contains(known, k)
        | (F.array_contains(null_fields, k) & v.isNotNull()),
    )
    broken = fields.isNull() & raw.isNotNull() & (F.trim(raw) != "")
    return F.when(broken, F.to_json(F.struct(raw.alias("_corrupt_record")))).when(
        F.size(misfit) > 0, F.to_json(misfit)
    )


def _parsed(lines: DataFrame, schema: T.StructType, rescue: bool) -> DataFrame:
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    typed = lines.withColumn("_typed", F.from_json("value", nullable))
    extra = [rescued(F.col("value"), F.col("_typed"), nullable).alias(RESCUED)] if rescue else []
    return typed.select("_typed.*", *extra, "_source_file")


def json_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    rescue: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """JSON Lines files as they arrive. Which files were read is kept by the checkpoint."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(folder).select("value", F.col("_metadata.file_path").alias("_source_file"))
    return _parsed(lines, schema, rescue)


def json_batch(spark: SparkSession, path, schema: T.StructType, rescue: bool = True) -> DataFrame:
    """The same records from a batch read."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_source_file"))
    return _parsed(lines, schema, rescue)


def with_metadata(stream: DataFrame, source_system: str, batch_id: str) -> DataFrame:
    """Lineage columns on a stream; the arrival time is that of the micro-batch."""
    business = [c for c in stream.columns if c not in ("_source_file", RESCUED)]
    return stream.withColumns(
        {
            "_source_system": F.lit(source_system),
            ingest.VERSION: F.current_timestamp(),
            "_batch_id": F.lit(batch_id),
            "_record_hash": C.record_hash(business),
        }
    )


def drain(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append everything that has arrived to the table at ``path`` and stop (K2).

    The checkpoint makes a restart exactly-once: a second run reads only new files.
    """
    query = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return query


def ingest_network_events(
    spark: SparkSession, folder: str, path: str, checkpoint: str, schema: T.StructType
) -> DataFrame:
    """One run of the network feed: read new files, add lineage, append, return the table."""
    stream = json_stream(spark, folder, schema)
    drain(
        with_metadata(stream, "Network Monitoring System", ingest.new_batch_id()), path, checkpoint
    )
    return spark.read.parquet(path)
