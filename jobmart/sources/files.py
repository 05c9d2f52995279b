"""Directory listings through Hadoop's file system, for any store that Spark can read."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def children(spark: SparkSession, path: str, directories: bool = False) -> list[str]:
    """Names directly under ``path``, or of its directories only; one level is listed, nothing is
    read. A path that isn't there has none."""
    where, store = _at(spark, path)
    if not store.exists(where):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(where) if s.isDirectory() or not directories)
