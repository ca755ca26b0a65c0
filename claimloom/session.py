"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings: safe to set on a session somebody else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Stream state on disk instead of on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings (UTC dates, adaptive execution) to ``spark``."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cores: int | str = "*", app: str = "claimloom", shared: str | None = None, **conf: str
) -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own.

    ``shared`` is the scratch folder, a new temporary one by default: here one machine runs all tasks.
    """
    conf.setdefault("spark.checkpoint.dir", shared or tempfile.mkdtemp(prefix="claimloom-"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("set spark.checkpoint.dir, before the session starts, to a folder that all executors share")
    return configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created or removed here."""
    return f"{shared_dir(spark).rstrip('/')}/claimloom/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    """A path of shared storage and the file system that Spark uses for it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def remove_folder(spark: SparkSession, path: str) -> None:
    folder, files = _file_system(spark, path)
    files.delete(folder, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder, files = _file_system(spark, path)
    return files.exists(folder)


def folders(spark: SparkSession, path: str) -> dict[str, float]:
    """The folders right below a path, by name, with the time (seconds) each was last changed; none if there is no such path."""
    folder, files = _file_system(spark, path)
    if not files.exists(folder):
        return {}
    return {f.getPath().getName(): f.getModificationTime() / 1000 for f in files.listStatus(folder) if f.isDirectory()}
