"""Session settings for local runs, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # The Python side of stateful streams then talks through a socket file.
    "spark.python.unix.domain.socket.enabled": "true",
}


def local_session(cores: int | str = 8, memory: str = "8g", **settings: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores).replace("*", "8"))
    )
    for name, value in {**LOCAL_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path that all executors can reach.

    It lies below `spark.checkpoint.dir`.  Only a local session may go without
    that setting; it then uses a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        master = spark.conf.get("spark.master", None)
        if master is None or not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tidemark-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def path_exists(spark: SparkSession, path: str) -> bool:
    files, found = _file_system(spark, path)
    return files.exists(found)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none where it does not exist."""
    files, found = _file_system(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(found)] if files.exists(found) else []


def remove_path(spark: SparkSession, path: str) -> None:
    """Removes a file or folder that this library has written, if it is there."""
    files, found = _file_system(spark, path)
    files.delete(found, True)
