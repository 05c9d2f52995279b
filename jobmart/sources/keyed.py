"""Parquet tables bucketed by key, so that joins on the key need no shuffle of them.

A table lies in ``<path>/buckets-<n>``: the number of buckets belongs to the data and is found
again by listing one directory, whatever catalog the session has. Files of finished tasks stay if
a job fails later (the committer moves each task's files when the task ends).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from jobmart.sources.catalog import _name, _text
from jobmart.sources.files import children

BUCKETS = 64
_PREFIX = "buckets-"


def buckets(spark: SparkSession, path: str) -> int | None:
    """The bucket count of the table at ``path``; None before anything was written."""
    found = [c for c in children(spark, path, directories=True) if c.startswith(_PREFIX)]
    return int(found[0][len(_PREFIX):]) if found else None


def table(spark: SparkSession, path: str, schema: StructType, key: str,
          wanted: int = BUCKETS) -> str:
    """Name of the table at ``path`` in this session's catalog, made if needed; an existing one keeps its own bucket count."""
    n = buckets(spark, path) or wanted
    location = f"{path}/{_PREFIX}{n}"
    name = "keyed_" + hashlib.sha256(location.encode()).hexdigest()[:24]
    columns = ", ".join(f"{_name(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"OPTIONS ('mapreduce.fileoutputcommitter.algorithm.version' '2') "
              f"CLUSTERED BY ({_name(key)}) INTO {n} BUCKETS LOCATION {_text(location)}")
    spark.catalog.refreshTable(name)
    return name


def files(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of the table at ``path`` read as plain files: a task reads a piece of a file, not a whole bucket."""
    n = buckets(spark, path)
    return spark.read.schema(schema).parquet(f"{path}/{_PREFIX}{n}") if n else spark.createDataFrame([], schema)


def gather(df: DataFrame, key: str, n: int, tasks: int = 0) -> DataFrame:
    """Rows dealt so that a task writes one bucket; with more ``tasks`` than buckets several share one evenly."""
    parts = max(1, -(-tasks // n))
    salt = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    return df.repartitionById(n * parts, F.pmod(F.hash(key), F.lit(n)) + F.lit(n) * salt)


def append(df: DataFrame, name: str) -> None:
    """Add rows to the table ``name``."""
    df.select(*df.sparkSession.table(name).columns).write.insertInto(name)
