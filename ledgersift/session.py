"""Session helper for local runs, tests and scripts, and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


_ROOTS: set[str] = set()


def get_session(app: str = "ledgersift", cores: str = "*", shuffle_partitions: int = 8,
                driver_memory: str = "8g") -> SparkSession:
    """A local session. On a cluster, pass the session the cluster gives you instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: `spark.checkpoint.dir`, or a folder in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, for one stage table, model or stream.

    All of an application's work lies in one folder, which goes when the application ends.
    """
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _ROOTS.add(root)
    return f"{root}/{name}-{uuid.uuid4().hex}"
