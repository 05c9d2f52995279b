"""Databases and external Parquet tables; DDL is generated from the data's own schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _name(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, database: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(database)} LOCATION {_text(location)}")


def register(spark: SparkSession, database: str, table: str, location: str,
             partition_by: Sequence[str] = (), find: bool = True) -> DataFrame:
    """(Re)create an external table over Parquet files and, unless told otherwise, find its partitions.

    Dropping an external table removes metadata only, the files stay.
    """
    name = _name(database, table)
    schema = spark.read.parquet(location).schema
    columns = ", ".join(f"{_name(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    parts = ", ".join(_name(p) for p in partition_by)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet"
        + (f" PARTITIONED BY ({parts})" if parts else "")
        + f" LOCATION {_text(location)}")
    if parts and find:
        repair(spark, database, table)
    return spark.table(name)


def repair(spark: SparkSession, database: str, table: str) -> None:
    """Make partitions written directly to storage visible."""
    spark.sql(f"MSCK REPAIR TABLE {_name(database, table)}")


def add_partitions(spark: SparkSession, database: str, table: str, written: DataFrame,
                   partition_by: Sequence[str], most: int = 10_000) -> int:
    """Make the partitions that ``written`` went to visible, without listing the table.

    One row per partition reaches the driver; where there are more than ``most`` the whole table
    is listed instead. Returns the number of partitions written.
    """
    values = written.select(*partition_by).distinct().limit(most + 1).collect()
    if len(values) > most:
        repair(spark, database, table)
    elif values:
        specs = " ".join("PARTITION (" + ", ".join(
            f"{_name(c)} = " + ("NULL" if row[c] is None else _text(str(row[c]))) for c in partition_by) + ")" for row in values)
        spark.sql(f"ALTER TABLE {_name(database, table)} ADD IF NOT EXISTS {specs}")
    return len(values)


def partitions(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {_name(database, table)}")


def row_count(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.sql(f"SELECT count(*) AS total_jobs FROM {_name(database, table)}")
