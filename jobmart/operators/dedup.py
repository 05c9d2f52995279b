"""First record per key, in batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def first_per_key(df: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """Keep the earliest row per key; NULL counts as one key.

    Written as an aggregate rather than a window: replays of a hot key are merged inside every
    map task, so what reaches the shuffle is at most one row per key and task. Ties are settled
    by the remaining columns, which makes the result repeatable.
    """
    ordering = [F.col(c) if isinstance(c, str) else c for c in order]
    row = F.struct(*[F.col(c) for c in df.columns])
    first = F.min_by(row, F.struct(*ordering, F.xxhash64(*_hashable(df))))
    return df.groupBy(F.col(key).alias("_key")).agg(first.alias("_row")).select("_row.*")


def first_stored(table: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """``first_per_key`` of a table just read from files, whatever types its columns have.

    The aggregate holds key, order and the place of a row (file and row number) only; the rows that
    were chosen are then read whole by a semi join on the place. Ties go to the first place.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    ordering = [F.col(c) if isinstance(c, str) else c for c in order]
    narrow = table.select(F.col(key).alias("_key"), place.alias("_place"), F.struct(*ordering, F.lit(0)).alias("_order"))
    chosen = narrow.groupBy("_key").agg(F.min(F.struct("_order", "_place")).alias("_first")).select(
        F.col("_first._place.file").alias("_file"), F.col("_first._place.row").alias("_row"))
    located = table.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return located.join(chosen, ["_file", "_row"], "left_semi").select(*table.columns)


def _hashable(df: DataFrame) -> list[Column]:
    return [F.col(f.name) for f in df.schema.fields if f.dataType.typeName() != "map"]
