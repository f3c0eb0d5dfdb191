"""Small file operations that Spark's readers and writers do not offer, on any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders inside a folder; none if it does not exist."""
    files, place = _located(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """A file, or a folder with everything in it; nothing happens if there is none."""
    files, place = _located(spark, path)
    files.delete(place, True)
