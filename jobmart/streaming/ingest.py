"""Incremental ingestion: message stream to a table of distinct adverts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from jobmart import schemas
from jobmart.operators.dedup import first_per_key
from jobmart.operators.enrich import LEDGER, Scorer, ask_again, enricher, pending, to_enrich
from jobmart.sources.bronze import decode
from jobmart.sources.tables import append, read_or_empty


def topic(spark: SparkSession, servers: str, name: str, **options: str) -> DataFrame:
    """Messages of a Kafka topic from the earliest offset. Needs Spark's Kafka connector."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", name).option("startingOffsets", "earliest")
            .options(**options).load())


def message_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Messages dropped as Parquet files, a stand-in for a topic.

    ``offset`` is the row's number within its file, as a topic numbers its messages.
    """
    reader = spark.readStream.schema(schemas.MESSAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).select(
        "key", "value", F.col("_metadata.row_index").alias("offset"))


def distinct_forever(stream: DataFrame, key: str = "job_id", spread: int = 0,
                     spread_by: Sequence[str] = (), remember: str = "1 hour") -> DataFrame:
    """First arrival per key wins for ever; NULL counts as one key.

    The state lives in the query's checkpoint and grows with the number of keys; run it on the
    RocksDB state store (see ``session``). With ``spread`` a first pass removes duplicates per
    key and salt, so replays of a hot key are thinned on ``spread`` tasks before they meet on
    one. ``spread_by`` names the columns the salt is taken from; they must differ between copies
    and stay the same when a batch is run again. The first pass forgets a key after it has been in
    the state for ``remember`` of arrival time; only the second, one row per key, remembers for ever.
    """
    if not spread:
        return stream.dropDuplicates([key])
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in spread_by]), F.lit(spread))
    thinned = (stream.withColumns({"_salt": salt, "_arrived": F.current_timestamp()})
               .withWatermark("_arrived", remember)
               .dropDuplicatesWithinWatermark([key, "_salt"]))
    return thinned.drop("_salt", "_arrived").dropDuplicates([key])


def distinct_within(stream: DataFrame, event_time: str, delay: str,
                    key: str = "job_id") -> DataFrame:
    """Bounded state: duplicates are recognised only within ``delay`` of event time."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def to_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process everything available, then stop. Progress and output are exactly-once."""
    return (stream.writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def ingest(messages: DataFrame, path: str, checkpoint: str, spread: int = 16,
           remember: str = "1 hour") -> StreamingQuery:
    """Messages to distinct adverts in Parquet.

    Copies of one advert, and unreadable messages, which all share the NULL key, may make up a
    large part of a batch; they are spread by message offset. With ``spread=0`` one shuffle and
    one state store are saved where that cannot happen. Returns the finished query.
    """
    rows = messages.select(decode(F.col("value")).alias("data"), "offset").select(
        "data.*", F.col("offset").alias("_offset"))
    distinct = distinct_forever(rows, spread=spread, spread_by=["_offset"], remember=remember)
    query = to_parquet(distinct.drop("_offset"), path, checkpoint)
    query.awaitTermination()
    return query


def enrich_new(spark: SparkSession, stage: str, ledger: str, checkpoint: str, scorer: Scorer,
               files_per_batch: int = 64, partitions: int | None = None, **options) -> None:
    """Enrich clean adverts incrementally, a few files per committed step.

    The checkpoint remembers finished files. Every step takes one row per key and leaves out the
    keys that the ledger has an answer for by then, so neither copies in several files nor a step
    that is run again call the model twice. Of the ledger only key and flag are read. Rows the
    model failed on stand in it with ``answered`` false; every start asks for them again first.
    """
    schema = spark.read.parquet(stage).schema
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
              .parquet(stage))
    score = enricher(scorer, partitions, **options)
    ask_again(spark, ledger, scorer, schema.names, partitions, **options)

    def step(rows: DataFrame, number: int) -> None:
        done = read_or_empty(rows.sparkSession, ledger, LEDGER)
        # Answered adverts leave before the copies of a key meet, whole rows of which are shuffled.
        append(score(first_per_key(pending(to_enrich(rows), done), "job_id", [])), ledger)

    (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
