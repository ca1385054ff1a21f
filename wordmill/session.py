"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults every job of this package expects; callers may override them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # P8/P9 read timestamps; pin the zone so results do not depend on the host.
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Remove checkpoint files (O1/O3 numbering) once their frame is gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app_name: str = "wordmill",
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir``. Only a local-mode session without it
    (tests) gets a fresh scratch folder; a cluster must name a shared one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:
        # A Spark Connect client has no SparkContext; the server's setting applies.
        if configured:
            return configured
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
    scratch = tempfile.mkdtemp(prefix="wordmill-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint folder, deleted when the
    application's JVM ends (Hadoop's ``deleteOnExit``)."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    sc = spark.sparkContext
    hadoop_path = sc._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop_path.getFileSystem(sc._jsc.hadoopConfiguration())
    store.mkdirs(hadoop_path)
    store.deleteOnExit(hadoop_path)
    return path
