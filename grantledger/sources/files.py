"""Listing and deleting folders through Spark's own file systems, so any store Spark reads will do."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where it does not exist."""
    system, place = _at(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def delete(spark: SparkSession, path: str) -> None:
    system, place = _at(spark, path)
    system.delete(place, True)
