"""Spark session defaults and the shared scratch location.

The engine never writes to a machine-local folder on a cluster: every table it
stages, backs up or cuts lineage with lives under ``spark.checkpoint.dir``,
which a cluster points at shared storage.  Only when that setting is absent
(local runs, tests) is a private folder under the system temp dir used.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # no Python call-site capture for every Column built (plan building is 4x faster)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # files of checkpoint() go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "voltaic", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    ``master`` is only set when given, so a cluster submit keeps its own.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only when the session has none and runs in local mode (tests) is a private temp
    folder used, the same for the whole application; on a cluster a missing setting
    is an error, since a machine-local folder is not visible to the executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Connect session has no SparkContext
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or an "
                               "object store): staging, backups and checkpoints are written there")
        if sc is None:  # a local Connect session can't be told a folder
            raise RuntimeError("set spark.checkpoint.dir: this session has no SparkContext")
        root = tempfile.mkdtemp(prefix="voltaic-ckpt-")
        sc.setCheckpointDir(root)  # getCheckpointDir() names it from now on
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, run-unique path under the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle sizing for a cluster run: enough initial shuffle partitions that
    each holds about ``target_partition_bytes`` of the input (AQE coalesces the
    small ones and splits skewed join partitions at run time), and scan splits
    of 256 MB.  Apply with ``get_session(extra=scale_conf(n))``."""
    parts = max(200, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
