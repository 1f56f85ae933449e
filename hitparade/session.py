"""Session helpers that do not pick a master or a deployment.

Scratch data (tables written by a job and read back, streaming checkpoints)
goes under the shared folder the cluster names in ``spark.checkpoint.dir`` —
never a machine-local temporary folder. Only a local-mode session without
one (a test) gets a temporary folder, registered on the session so every later
call agrees; a cluster session without one is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint folder; set a local one only when unset."""
    conf = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if conf:
        return conf.rstrip("/")
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return str(jdir.get()).rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set: point it at a folder shared by the cluster "
            "(a driver-local temporary folder is not visible to executors)"
        )
    local = tempfile.mkdtemp(prefix="hitparade-checkpoints-")
    spark.sparkContext.setCheckpointDir(local)
    return str(spark.sparkContext._jsc.sc().getCheckpointDir().get()).rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder ``<checkpoint root>/hitparade/<name>-<uuid>``."""
    return f"{checkpoint_root(spark)}/hitparade/{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(shuffle_partitions: int = 20_000, advisory_partition_mb: int = 256) -> dict[str, str]:
    """Settings for a large cluster, to pass to ``SparkSession.builder.config``.

    Start with many shuffle partitions and let AQE coalesce them to
    ``advisory_partition_mb`` (so no reducer spills at 100 TB, and small
    stages do not run thousands of empty tasks); split file scans at the same
    size; split skewed join partitions and skewed rebalance partitions; and
    let a join whose keys extend a bucket key use the buckets (the bucketed
    curated layout).
    """
    size = f"{advisory_partition_mb}m"
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
