"""What only the file system can tell: which directories a path has, and dropping them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def directories(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories right below a path: one listing. A path that is not there is
    an error, so a lost or misspelt table is not taken for an empty one."""
    system, place = _at(spark, path)
    found = system.listStatus(place)
    return sorted(entry.getPath().getName() for entry in found if entry.isDirectory())


def drop_directory(spark: SparkSession, path: str) -> None:
    system, place = _at(spark, path)
    system.delete(place, True)


def extent(spark: SparkSession, pattern: str) -> tuple[int, int]:
    """Number and total bytes of the files under the paths that a pattern names."""
    system, place = _at(spark, pattern)
    summaries = [system.getContentSummary(e.getPath()) for e in system.globStatus(place) or []]
    return sum(s.getFileCount() for s in summaries), sum(s.getLength() for s in summaries)
