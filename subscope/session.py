"""Session settings the operators are designed for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Row-level joins lean on AQE to split a hot key at run time; aggregations pre-combine on
# the map side and windows are limited before their shuffle, so neither needs it.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # stack traces per column expression cost more than planning a wide measure query
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def session(master: str | None = None, app: str = "subscope", **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for written tables and stream checkpoints.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Only a local master may
    fall back to a folder of this machine, because only there every task can see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="subscope-")
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex[:12]}"
