"""Driver-side folder operations through Spark's own Hadoop file systems (local, HDFS, object stores)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.delete(p, True)


def children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def usage(spark: SparkSession, path: str) -> tuple[int, int]:
    """(bytes, files) below a folder."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return 0, 0
    summary = fs.getContentSummary(p)
    return summary.getLength(), summary.getFileCount()
