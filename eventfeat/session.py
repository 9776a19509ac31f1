"""Session defaults and lineage-cutting helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Defaults applied only by build_session(); library code never overrides a
# cluster's own configuration.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "eventfeat", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local/test session builder.  On a cluster, pass an existing session instead."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    return d or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the configured checkpoint dir; only when none is set (tests, local runs)
    create a private scratch folder so ``DataFrame.checkpoint`` works."""
    d = checkpoint_dir(spark)
    if d:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
        return d
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) on a cluster")
    d = tempfile.mkdtemp(prefix="eventfeat-ckpt-", dir=os.environ.get("EVENTFEAT_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(d)
    spark.conf.set("spark.checkpoint.dir", d)
    return d


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss).

    The plan is persisted while it is checkpointed: an eager checkpoint runs one job
    to count and one to write, and without the persist the upstream plan would be
    computed twice."""
    from pyspark import StorageLevel

    ensure_checkpoint_dir(df.sparkSession)
    if not eager:
        return df.checkpoint(eager=False)
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return held.checkpoint(eager=True)
    finally:
        held.unpersist()
