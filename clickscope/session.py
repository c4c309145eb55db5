"""Session and shared-folder helpers.

Library code never builds its own session; callers pass one in.  These
helpers are for tests, the bench and command-line runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "clickscope") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UTC, no UI)."""
    parts = shuffle_partitions or cores
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state."
                "RocksDBStateStoreProvider")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared, fault-tolerant folder and is
    used as is; if it is unset there, this fails rather than fall back to a
    machine-local folder.  Only in local mode (tests) a fresh folder is made
    and registered when the setting is unset.
    """
    conf = spark.sparkContext.getConf()
    local = spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster")
    root = conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not local:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...): "
                               "a machine-local folder is not visible to the other executors")
        root = tempfile.mkdtemp(prefix="clickscope-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def scale_settings(input_bytes: int, cores: int, *, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a job reading ``input_bytes`` on ``cores``.

    The initial shuffle partition count aims at ``partition_bytes`` of input
    per partition (at least two per core); AQE then merges small partitions
    towards the same advisory size and splits skewed join partitions, so a
    partition fits in an executor's execution memory without spilling much.
    """
    parts = max(2 * cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(min(partition_bytes, 512 << 20)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
