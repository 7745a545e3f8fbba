"""Session construction and the shared scratch location.

Settings are the ones the plans rely on: UTC session time zone (DATE/TIMESTAMP
results must not depend on the machine), AQE with partition coalescing and skew
join splitting, and no web UI.  ``spark.sql.shuffle.partitions`` is a run
setting: ~cores locally; on a cluster size it so one shuffle partition is
roughly 128-256 MB at the target scale, AQE coalesces the rest.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(master: str | None = None, app_name: str = "ledgerline", conf: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def choose_root(current: str | None, configured: str | None, master: str) -> str | None:
    """Which shared folder to use: the context's checkpoint dir, else the
    configured ``spark.checkpoint.dir``; ``None`` means "make a private one",
    allowed only in local mode (a temp folder would be machine-local on a cluster)."""
    if current:
        return current
    if configured:
        return configured
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return None


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder for lineage cuts and intermediate tables.

    Read from ``spark.checkpoint.dir`` (or a checkpoint dir already set on the
    context).  Only when nothing is configured *and* Spark runs in local mode is
    a private temporary folder created; on a cluster that would be
    machine-local, so it is an error instead.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    root = choose_root(current, configured, sc.master)
    if root == current and current:
        return current
    sc.setCheckpointDir(root or tempfile.mkdtemp(prefix="ledgerline-ckpt-"))
    return sc.getCheckpointDir()


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of each query that runs inside go when it ends.  Otherwise they
    stay until the driver happens to collect its garbage, and the disk holds those of
    all steps of a job at once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path under the shared root (not created)."""
    return os.path.join(shared_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")
