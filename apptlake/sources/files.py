"""Folder lookups on whatever file system a path lives on. Only names reach the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


def size_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path; zero if it is missing."""
    fs, hadoop_path = _fs(spark, path)
    return fs.getContentSummary(hadoop_path).getLength() if fs.exists(hadoop_path) else 0


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, not recursive; none if the folder is missing."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.delete(hadoop_path, True)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder when the application ends.

    ``deleteOnExit`` records only paths that exist, hence the folder is made first.
    """
    fs, hadoop_path = _fs(spark, path)
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
