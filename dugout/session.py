"""Session settings and the shared folder for data that must outlive a task."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from dugout.errors import InvalidParameter

CHECKPOINT_KEY = "spark.checkpoint.dir"

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "dugout", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the library is tested with."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set, because executors on other machines have to
    reach it. Only a ``local`` master, where every task runs on this machine,
    gets a folder of its own when nothing is configured.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise InvalidParameter(f"{CHECKPOINT_KEY} must name a folder all executors can reach.")
    folder = tempfile.mkdtemp(prefix="dugout-")
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


class Folder:
    """A folder on whatever file system its path belongs to."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        self.system = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self.system.exists(self.path)

    def subfolders(self) -> list[str]:
        """Names of the folders directly below, from one listing."""
        entries = self.system.listStatus(self.path) if self.exists() else []
        return [entry.getPath().getName() for entry in entries if entry.isDirectory()]

    def delete(self) -> None:
        self.system.delete(self.path, True)


def folder(spark: SparkSession, path: str) -> Folder:
    return Folder(spark, path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
