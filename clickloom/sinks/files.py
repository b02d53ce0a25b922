"""Folders through Hadoop's file system interface, whatever the storage."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _on(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _on(spark, path)
    return system.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder or file with all below; nothing happens if there is none."""
    system, place = _on(spark, path)
    system.delete(place, True)
