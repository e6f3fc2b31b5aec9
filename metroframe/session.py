"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for sessions started by this repository's own tools (tests, bench,
# scripts). Library functions take any session; a cluster deployment keeps
# its own configuration. The small minimum partition size keeps AQE from
# merging a small but CPU-heavy shuffle (the radius join) into one task; it
# changes nothing for large inputs.
LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(
    app: str = "metroframe",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(LOCAL_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session has none and runs in local mode is a folder made here
    and registered as the checkpoint directory, so later calls agree on it; on a
    cluster a machine-local folder would be lost to the other machines, so the
    setting is required there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not configured and sc is not None:
        current = sc.getCheckpointDir()
        if current:
            configured = os.path.dirname(current.rstrip("/"))
    if not configured:
        if sc is None or not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="metroframe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext, or None under Spark Connect (no driver-side context)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect raises its own "not supported" error
        return None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location below the shared folder."""
    return f"{shared_dir(spark)}/metroframe/{name}-{uuid.uuid4().hex[:12]}"


def unique_name(prefix: str) -> str:
    """A catalog-safe unique table name."""
    return f"{prefix}_{uuid.uuid4().hex[:10]}"
