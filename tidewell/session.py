"""Session settings the reports are written for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# AQE re-plans joins from measured sizes, splits skewed partitions and merges small ones, so
# no report sets a partition count or a broadcast hint on data that can grow.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "tidewell", master: str | None = None, **extra: str) -> SparkSession:
    """A session with :data:`SETTINGS`; on a cluster leave ``master`` to the launcher.

    ``extra`` takes further settings with ``__`` for the dots
    (``spark__sql__shuffle__partitions="8"``).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def on_one_machine(spark: SparkSession) -> bool:
    """Whether driver and executors are one process, so that any folder is shared."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: what the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, the session's checkpoint folder; where there is none either and the
    session runs in one process (tests, a laptop), a new temporary one. On a cluster without
    the setting this raises: a folder of one machine would lose the other executors' files.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not on_one_machine(spark):
            raise ValueError("spark.checkpoint.dir is not set; name a folder all executors share")
        named = tempfile.mkdtemp(prefix="checkpoints-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")
