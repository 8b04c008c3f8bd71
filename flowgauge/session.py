"""Session settings and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

#: Settings every job of this library expects.  Sizes are left to the cluster:
#: AQE coalesces shuffle partitions, so a deployment only raises
#: ``spark.sql.shuffle.partitions`` (a few per core) and keeps the rest.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # One daily run compiles more than the default 100 pieces of code.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # Recording the Python call site of every column expression costs more than
    # planning the query does; errors still name the column.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "flowgauge", master: str | None = None, **settings: str) -> SparkSession:
    """Session with UTC time and adaptive execution; ``settings`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints, which must be shared by all executors.

    The cluster's own ``spark.checkpoint.dir`` always wins.  A temporary folder
    is used only where nothing is set and the session is a local one; on a
    cluster that folder would be lost with its machine, so that is an error.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="flowgauge-checkpoint-")
    context.setCheckpointDir(configured)
    return configured
