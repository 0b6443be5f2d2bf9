"""The few things that need a file system instead of a table: names, claims, removal."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _opened(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, folder: str) -> None:
    path, files = _opened(spark, folder)
    files.delete(path, True)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what a folder holds, sorted; none if there is no such folder."""
    path, files = _opened(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []


def claim(spark: SparkSession, file: str) -> bool:
    """Create an empty file; False if there is one, also when two processes try at once."""
    path, files = _opened(spark, file)
    try:
        files.create(path, False).close()
    except Py4JJavaError as err:
        if "FileAlreadyExists" in err.java_exception.getClass().getName() or files.exists(path):
            return False
        raise
    return True
