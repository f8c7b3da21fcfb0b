"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Runtime re-planning, skew handling and Arrow batches. Partition counts are left
# to the cluster: adaptive execution coalesces small ones and splits skewed ones.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
}


def build_session(app: str = "parley", **conf: str) -> SparkSession:
    """A session with the settings above; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the cluster names, under ``name``.

    A local session without that setting, as in tests, gets a folder of its own;
    on a cluster that is an error, as executors would not see each other's files.
    """
    context = spark.sparkContext
    base = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local["):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="parley-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/parley/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder as parquet and read it back.

    Cuts the lineage, survives lost executors, and lets later passes read only
    the columns they need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
