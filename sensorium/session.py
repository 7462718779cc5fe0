"""Session construction and shared scratch locations.

Scratch output (stream checkpoints, incremental-view logs, materialised
intermediate tables) always goes under the cluster's shared
``spark.checkpoint.dir``.  We only pick a directory ourselves when the session
has none, which is the situation in local tests.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Timestamps in written tables that scans can prune by (the default, INT96, has no statistics).
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "sensorium", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the library defaults.

    On a cluster the session usually exists already (spark-submit); then only
    the SQL settings that are safe to change at runtime are applied.
    """
    active = SparkSession.getActiveSession()
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    if active is not None:
        for k, v in conf.items():
            if k.startswith("spark.sql."):
                active.conf.set(k, v)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint directory named by the session.  Where none is set, a
    local session gets one of its own; on a cluster that is an error, since a
    folder of the driver's machine is not seen by the executors."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="sensorium-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint root (made by whoever
    writes to it).  It lasts until ``release_scratch`` or the end of the driver."""
    path = f"{checkpoint_root(spark)}/sensorium/{name}-{uuid.uuid4().hex[:12]}"
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        atexit.register(release_scratch, spark)
    _SCRATCH.setdefault(app, []).append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of any file system that Spark knows."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release_scratch(spark: SparkSession) -> None:
    """Remove every scratch folder of this session; results read from them are gone."""
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    for path in _SCRATCH.pop(context.applicationId, []):
        remove_path(spark, path)
