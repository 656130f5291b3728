"""SparkSession construction and the shared working folder.

Everything the library writes between stages (staging tables, checkpoints,
reject sinks) goes below the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent *and* the
session runs in local mode (tests, laptops) do we pick a folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Parquet timestamps written without a zone stay TIMESTAMP_NTZ.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def build_session(master: str | None = None, app: str = "runway",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Return a session with the library's defaults (AQE on, UTC, no UI)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = dict(DEFAULT_CONF)
    if shuffle_partitions:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update(conf or {})
    for k, v in merged.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staging tables.

    Read from ``spark.checkpoint.dir``; set our own only where it is unset
    and the session is local.  On a cluster an unset value is an error,
    because a machine-local folder would not survive a lost executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        # SparkContext appends a per-application uuid; the shared root is its parent.
        return current.rsplit("/", 1)[0]
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="runway-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return configured


def shared_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A path below the shared folder, fresh per call when ``unique``."""
    root = ensure_checkpoint_dir(spark)
    if root.startswith("file:"):
        root = root[len("file:"):]
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    return os.path.join(root, "runway", leaf)
