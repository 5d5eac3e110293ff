"""Spark session settings the pipeline relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every plan in this package assumes.
RUNTIME_CONF = {
    # Timestamps without a zone are read and printed in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A rerun replaces only the partitions it writes.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Keep partition values as written ("01" stays "01").
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(app: str = "daybook", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session. On a cluster leave ``master`` unset."""
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return configure(spark)


# Shuffle sizing: about this many input bytes per shuffle partition, so the
# largest aggregation's partitions fit in task memory without spilling. AQE then
# coalesces partitions that turn out small; it cannot split ones that are too big.
BYTES_PER_SHUFFLE_PARTITION = 256 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, configured: int) -> int:
    """Partitions for a job reading ``input_bytes``: never fewer than configured."""
    return max(configured, -(-int(input_bytes) // BYTES_PER_SHUFFLE_PARTITION))


def session_sized_for(spark: SparkSession, input_bytes: int) -> SparkSession:
    """A session of its own for one run, with shuffle partitions for its input.

    It shares the context, catalog and settings of ``spark``; what it sets is seen by no
    other query, so runs of several threads need not wait for each other.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and session.conf.isModifiable(key):
            session.conf.set(key, value)
    key = "spark.sql.shuffle.partitions"
    session.conf.set(key, str(shuffle_partitions_for(input_bytes, int(spark.conf.get(key)))))
    return session


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when it is unset and the master is local (a test run) a fresh local folder is
    taken and registered, so later calls and ``DataFrame.checkpoint`` use the same place.
    On a cluster, whose executors have disks of their own, it must be set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="daybook-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # a core setting may be fixed for the running session
            pass
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str = "run") -> str:
    """A fresh, never reused directory below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/daybook/{label}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for the few places that need an OS path."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


__all__ = ["RUNTIME_CONF", "configure", "get_session", "checkpoint_root", "scratch_dir",
           "local_path", "shuffle_partitions_for", "session_sized_for"]
