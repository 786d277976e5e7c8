"""Folders of any file system Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder or file; nothing happens if it is not there."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
