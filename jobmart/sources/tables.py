"""Parquet tables: reading, appending, overwriting, previewing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from jobmart import schemas


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    """Adverts with the declared schema; absent columns read as NULL."""
    return spark.read.schema(schemas.POSTING).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: str | StructType,
                  table: str | None = None) -> DataFrame:
    """The table at ``path``, or an empty one when nothing was written there yet.

    For a single partition directory ``table`` names the whole table, so that the partition
    column is there but only this directory is listed. Only a missing path is forgiven; any other
    failure is raised.
    """
    reader = spark.read.option("basePath", table) if table else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}:
            raise
        return spark.createDataFrame([], schema)


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                         rebalance: bool = False) -> None:
    """Replace only the partitions present in ``df``; other days stay.

    One run usually writes one day, and then every task writes one file and no shuffle is needed.
    With many days at once, ``rebalance`` gathers each day into few files of even size.
    """
    rows = df.hint("rebalance", *partition_by) if rebalance else df
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def preview(df: DataFrame, columns: Sequence[str], order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a fixed order, ready for ``show``."""
    return df.select(*columns).orderBy(*order).limit(n)
