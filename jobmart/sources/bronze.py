"""Raw adverts: JSON run directories and keyed messages."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobmart import schemas
from jobmart.sources.files import children

# --- fixed value: name of a run directory, date_time -----------------------------------------
RUN_ID = r"[0-9]{8}_[0-9]{6}"


def latest_run(spark: SparkSession, base: str) -> str | None:
    """Newest run directory under ``base``; files lying beside the runs are not runs.

    One level is listed by the store itself, whatever number of files the runs hold.
    """
    runs = [c for c in children(spark, base, directories=True) if re.fullmatch(RUN_ID, c)]
    return f"{base}/{max(runs)}" if runs else None


def read_run(spark: SparkSession, path: str) -> DataFrame:
    """Adverts of one run; every file is a JSON array, absent keys are NULL."""
    return (spark.read.schema(schemas.POSTING).option("multiLine", True)
            .option("recursiveFileLookup", True).json(path))


def to_messages(postings: DataFrame) -> DataFrame:
    """One message per advert: ``key`` is the job id, ``value`` the whole record as JSON."""
    return postings.select(F.col("job_id").alias("key"), F.to_json(F.struct("*")).alias("value"))


def decode(value: Column) -> Column:
    """Message value to an advert struct; unreadable messages give NULL fields."""
    return F.from_json(value.cast("string"), schemas.POSTING)


def from_messages(messages: DataFrame) -> DataFrame:
    return messages.select(decode(F.col("value")).alias("data")).select("data.*")
