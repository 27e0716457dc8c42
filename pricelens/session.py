"""Session construction and shared-storage helpers."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC instants, AQE re-planning (partition
# coalescing + skew-join splitting), and Arrow for the few pandas paths.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "pricelens",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``shuffle_partitions`` should be sized so one shuffle partition holds
    ~128-256 MB at the target scale; AQE coalesces it down for small inputs.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_utc(spark: SparkSession) -> SparkSession:
    """All instants in this library are UTC; pin the session zone."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory under the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is read from the session.
    Where it is unset, a local master gets a private folder under the system
    temp dir, removed when Python ends; on a cluster, whose executors would
    not see such a folder, this raises.  Each call returns a new
    sub-directory, so runs never collide.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="pricelens-ckpt-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df, spark: SparkSession | None = None):
    """Reliable checkpoint into the shared checkpoint folder (survives
    executor loss, unlike a local checkpoint)."""
    spark = spark or df.sparkSession
    scratch_dir(spark, "ckpt")  # makes sure a checkpoint dir is configured
    return df.checkpoint(eager=True)


def store(df, name: str):
    """Write to the shared checkpoint folder and read back: one fixed copy for
    several consumers that survives executor loss."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
