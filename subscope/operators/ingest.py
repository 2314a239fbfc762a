"""Record-level lineage of ingested rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.functions import columns as C

# Name under which a row sorts as newer; written once per batch, per micro-batch in a stream.
VERSION = "_ingestion_timestamp"
# What the rows of one key have in common, for a source whose rows lie together by it already.
PLACE = "_place"
METADATA = (PLACE, "_source_system", "_source_file", VERSION, "_batch_id", "_record_hash")


def new_batch_id() -> str:
    return str(uuid.uuid4())


def add_metadata(
    df: DataFrame, source_system: str, batch_id: str, columns=None, source_file: bool = True
) -> DataFrame:
    """Add source system, source file, arrival time, batch id and record hash.

    The hash covers the business columns in order, so equal records are recognisable across
    batches. ``source_file`` needs a file source; leave it off for tables built in memory.
    """
    origin = F.col("_metadata.file_path") if source_file else F.lit(None).cast("string")
    return df.withColumns(
        {
            "_source_system": F.lit(source_system),
            "_source_file": origin,
            VERSION: F.current_timestamp(),
            "_batch_id": F.lit(batch_id),
            "_record_hash": C.record_hash(columns or df.columns),
        }
    )


def stamped(df: DataFrame, name: str) -> DataFrame:
    """Processing time of the batch (P7); replaces an earlier stamp of the same name."""
    return df.withColumn(name, F.current_timestamp())
