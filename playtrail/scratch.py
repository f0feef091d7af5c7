"""Where intermediate tables go."""

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    A temporary folder stands in only for a local master, where driver and executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="playtrail-")
    return _LOCAL_FOLDERS[context.applicationId]


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that `new_folder` has named, wherever it is; nothing happens if it isn't there."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def names_below(spark: SparkSession, path: str) -> list[str]:
    """The files and folders directly below a folder, wherever it is; none if it isn't there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [entry.getPath().getName() for entry in system.listStatus(folder)] if system.exists(folder) else []


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created until Spark writes there."""
    return f"{shared_folder(spark)}/playtrail/{label}-{uuid.uuid4().hex}"
