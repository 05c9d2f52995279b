"""What the operators share: text columns through Arrow, and tables in the shared folder."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words of the result contracts are `[^\x20\x09-\x0D]+`; `bytes.split()` cuts at the same bytes.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


#: Rows of an Arrow batch that are worked on together; bounds a worker's memory.
ROWS = 512


def pieces(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows. At the end of the task its memory goes back to the system, as
    Python workers outlive tasks and stages."""
    try:
        for b in batches:
            for i in range(0, b.num_rows, rows):
                yield b.slice(i, rows)
    finally:
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; a null text has none."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; on a local master a temporary folder if unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: cuts the lineage for good."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def add_columns(df: DataFrame, text: str | Column, fields: T.StructType,
                make: Callable[[], Callable[[pa.Array], list[pa.Array]]]) -> DataFrame:
    """Append columns computed from whole texts in Arrow batches, without a shuffle.

    ``make`` is called once per task and returns a function from a batch of texts to one array per
    field. A column of ``df`` that has the name of a new one (in any case) is replaced by it.
    """
    new = {f.name.lower() for f in fields}
    keep = [c for c in df.columns if c.lower() not in new]
    own = isinstance(text, str) and text in keep and df.schema[text].dataType == T.StringType()
    source = F.col(text) if isinstance(text, str) else text
    extra = [] if own else [source.cast("string").alias("text to map")]  # a text already among the columns goes over once
    rows = df.select(*[F.col(f"`{c}`") for c in keep], *extra)
    schema = T.StructType([rows.schema[i] for i in range(len(keep))] + fields.fields)
    names, at, width = schema.names, keep.index(text) if own else len(keep), len(keep)

    def apply(batches):
        fn = make()
        for b in pieces(batches):
            yield pa.RecordBatch.from_arrays(b.columns[:width] + fn(b.column(at)), names)

    return rows.mapInArrow(apply, schema)
