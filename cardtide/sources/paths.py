"""Folders of stored tables, through whatever file system their path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if there is no such folder."""
    files, place = _at(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or a folder with all it holds; False if it was not there."""
    files, place = _at(spark, path)
    return files.delete(place, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark names it in ``inputFiles``."""
    files, place = _at(spark, path)
    return files.makeQualified(place).toString()
