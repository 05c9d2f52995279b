"""Routing, model scoring and resumable enrichment.

The model is a function handed in by the caller. Everything around it (prompt, reply decoding,
level, provenance, resume) is column code; only the prompt text crosses into Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from jobmart import vocab
from jobmart.functions.fields import it_decision, provenance
from jobmart.functions.labels import mart_place, skills, title_level, with_domains
from jobmart.functions.matching import all_labels
from jobmart.functions.prompt import decode_reply, prompt
from jobmart.functions.skills import canonical_skills
from jobmart.operators.dedup import first_per_key
from jobmart.operators.quality import clean_tests, counters
from jobmart.plans.clean import clean
from jobmart.sources import keyed
from jobmart.sources.tables import append, read_or_empty

# prompt text, timeout in seconds -> reply text. Raises TimeoutError when the model is too slow.
Scorer = Callable[[str, float], str]
FAILED = "{}"
#: Prompts of an Arrow batch that are unpacked together; a prompt may hold a very long text.
ROWS = 64
LEDGER = "job_id string, answered boolean"


def route(clean: DataFrame) -> DataFrame:
    """Add ``route``: ``no_content``, ``non_it`` or ``enrich``."""
    verdict = F.col("is_it_preliminary")
    return clean.withColumn(
        "route",
        F.when(~F.col("has_content"), "no_content").when(verdict == "false", "non_it")
        .when(verdict != "false", "enrich"))


def route_all(postings: DataFrame, path: str) -> dict[str, int]:
    """Clean all adverts and write them to one table partitioned by ``route``, in one pass.

    Nothing is lost: adverts without content and those of other trades are partitions like the
    adverts to be enriched. Returns the counters of ``quality.clean_report`` and ``null_keys``, the
    raw adverts without a ``job_id``; the writing job itself has counted them.
    """
    raw, typed = Observation(), Observation()
    keyless = F.count_if(F.col("job_id").isNull()).alias("null_keys")
    rows = clean(postings.observe(raw, keyless)).observe(typed, *counters(clean_tests()))
    (route(rows).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("route").parquet(path))
    return typed.get | raw.get


def to_enrich(clean: DataFrame) -> DataFrame:
    """Adverts worth a model call.

    Meant for the stored clean stage: on an unstored one the filter would clean texts twice.
    """
    return clean.filter(F.col("has_content") & (F.col("is_it_preliminary") != "false"))


def asked(scorer: Scorer, timeout: float = 20.0, attempts: int = 2,
          in_flight: int = 4) -> Callable[[Column], Column]:
    """A column function sending prompts to ``scorer``.

    A timeout is retried, any other failure gives NULL, so one bad row never fails a task. ``in_flight`` calls overlap per task, since they mostly wait. The function is marked
    nondeterministic so that the optimizer never calls the model twice for a row. Of an Arrow batch only
    ``ROWS`` prompts at a time become Python strings, and a task's memory goes back when it ends.
    """

    def one(text: str) -> str | None:
        for _ in range(attempts):
            try:
                return scorer(text, timeout)
            except TimeoutError:
                continue
            except Exception:  # noqa: BLE001 - the model is foreign code
                return None
        return None

    def batches(prompts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(in_flight) as pool:
            for batch in prompts:
                parts = [list(pool.map(one, batch.slice(i, ROWS).to_pylist())) for i in range(0, len(batch), ROWS)]
                yield pa.array([reply for part in parts for reply in part], pa.string())
        pa.default_memory_pool().release_unused()

    return F.arrow_udf(batches, "string").asNondeterministic()


def _finisher() -> Callable[[DataFrame], DataFrame]:
    """Turns ``_answer`` into columns and adds level and provenance."""
    level = title_level(F.col("title"), F.col("exp_min")).alias("job_level")
    origin = provenance(F.col("is_it_preliminary")).alias("classification_source")
    return lambda answered: answered.select("*", "_answer.*", level, origin).drop(
        "_answer", "_reply")


def enricher(scorer: Scorer, partitions: int | None = None,
             **options) -> Callable[[DataFrame], DataFrame]:
    """``enrich`` with its columns built once, for use on many frames."""
    reply = asked(scorer, **options)(prompt())
    answer = decode_reply(F.coalesce("_reply", F.lit(FAILED)), F.col("is_it_preliminary"))
    finish = _finisher()

    def run(todo: DataFrame) -> DataFrame:
        spread = todo.repartition(partitions) if partitions else todo
        replied = spread.withColumn("_reply", reply).withColumn("answered", F.col("_reply").isNotNull())
        return finish(replied.withColumn("_answer", answer))

    return run


def enrich(todo: DataFrame, scorer: Scorer, partitions: int | None = None, **options) -> DataFrame:
    """Score every row with the model and add its answer as typed columns.

    ``answered`` is false where the model gave no reply; such rows hold the defaults.

    ``partitions`` spreads the calls; model time, not data size, sets the task length here.
    """
    return enricher(scorer, partitions, **options)(todo)


def enrich_by_rules(todo: DataFrame, dictionary=vocab.SKILLS) -> DataFrame:
    """Same columns as ``enrich`` without any model: dictionaries answer instead.

    ``locations`` names every province found in the location text, spelt the way the location mart
    looks for it, or the one label for other places; no location text counts as nationwide.
    """
    text = F.concat_ws(" | ", "title", "mo_ta_text", "yeu_cau_text")
    found = (todo.withColumn("_text", text).transform(lambda df: with_domains(df, "_text"))
             .withColumnRenamed("domain", "_domains"))
    domain = F.get("_domains", F.lit(0))
    places = F.transform(all_labels(F.lower("location_raw"), vocab.LOCATIONS), mart_place)
    answer = F.struct(
        domain.alias("domain"),
        canonical_skills(skills(F.col("_text"), F.col("_domains"), dictionary)).alias("technical_skills"),
        it_decision(F.col("is_it_preliminary"), domain).alias("is_it_job"),
        F.lit(-1.0).cast("float").alias("exp_max"),
        F.when(F.size(places) > 0, places)
        .when(F.coalesce("location_raw", F.lit("")) == "", F.array(F.lit(vocab.MART_CITIES[-1])))
        .otherwise(F.array(F.lit(vocab.OTHER_CITY))).alias("locations"),
        F.lit(-1).alias("max_salary_verified"),
    )
    rows = found.withColumn("answered", F.lit(True)).withColumn("_answer", answer)
    return _finisher()(rows.drop("_text", "_domains"))


def answered(ledger: DataFrame) -> DataFrame:
    """Ledger rows with a reply; a ledger without the column has no others."""
    return ledger.filter("answered") if "answered" in ledger.columns else ledger


def settled(ledger: DataFrame, key: str = "job_id") -> DataFrame:
    """One row per key: its answer, or the defaults as long as the model has failed on it."""
    if "answered" not in ledger.columns:
        return ledger
    done = answered(ledger)
    failed = ledger.filter(~F.col("answered")).join(done.select(key), key, "left_anti")
    return done.unionByName(failed.dropDuplicates([key]))


def pending(todo: DataFrame, ledger: DataFrame, key: str = "job_id") -> DataFrame:
    """Rows of ``todo`` whose key has no answer in the ledger yet."""
    return todo.join(answered(ledger).select(key), key, "left_anti")


def plan_batches(todo: DataFrame, path: str, batches: int) -> None:
    """Write ``todo`` partitioned into ``batches`` by a hash of the key.

    A row's batch depends on its key alone, so a restart finds every row where it was. The
    rebalance hint lets adaptive execution split large batches over several tasks and files.
    """
    number = F.pmod(F.xxhash64("job_id"), F.lit(batches)).cast("int")
    (todo.withColumn("_batch_id", number).hint("rebalance", "_batch_id")
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_batch_id").parquet(path))


def run_batches(spark: SparkSession, planned: str, ledger: str, scorer: Scorer, batches: int,
                partitions: int | None = None, **options) -> None:
    """Enrich the planned batches one after the other, each committed on its own.

    Rows answered in the ledger are left out by key, whatever batch they were answered in, so an
    interrupted or newly planned run continues where it stopped. Rows the model failed on are
    written with ``answered`` false and asked again by the next run.
    """
    schema = spark.read.parquet(planned).schema
    run = enricher(scorer, partitions, **options)
    for number in range(batches):
        mine = f"_batch_id={number}"
        todo = read_or_empty(spark, f"{planned}/{mine}", schema, planned)
        done = read_or_empty(spark, ledger, LEDGER)
        append(run(pending(todo, done)), ledger, partition_by=["_batch_id"])


def plan_keyed(todo: DataFrame, path: str, buckets: int = keyed.BUCKETS) -> None:
    """Add ``todo`` to the planned table at ``path``, one row per key, bucketed by key.

    As many tasks write as the session has shuffle partitions, several to a bucket where there are fewer buckets.
    """
    spark = todo.sparkSession
    name = keyed.table(spark, path, todo.schema, "job_id", buckets)
    n = keyed.buckets(spark, path) or buckets
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed.append(keyed.gather(first_per_key(todo, "job_id", []), "job_id", n, tasks), name)


def run_pending(spark: SparkSession, planned: str, ledger: str, scorer: Scorer,
                buckets: int = keyed.BUCKETS, rows_per_task: int = 5000, **options) -> None:
    """Enrich all planned adverts without an answer, in one job.

    ``planned`` and ``ledger`` are bucketed tables; with equal bucket counts the adverts still
    pending are found without a shuffle, else only ``planned`` is dealt anew. Where a bucket holds more than a
    task's share, the adverts are read by pieces of files in place of whole buckets. The ledger keeps the
    bucket count it was made with. Each task asks for at most about ``rows_per_task`` adverts and its
    answers are stored when it ends, so a job that is stopped loses its unfinished tasks only and
    the next run goes on. A key is asked once per run; rows the model failed on are asked again by the next.
    """
    done_schema = spark.read.parquet(f"{planned}/*").schema
    todo = spark.table(keyed.table(spark, planned, done_schema, "job_id", buckets))
    run = enricher(scorer, **options)
    name = keyed.table(spark, ledger, run(todo).schema, "job_id", buckets)
    n = keyed.buckets(spark, ledger) or buckets
    left = pending(todo, spark.table(name))
    waiting = left.select("job_id").count()
    if waiting:
        tasks = -(-waiting // rows_per_task)
        if keyed.buckets(spark, planned) == n and tasks <= n:
            once = left
        else:
            rows = keyed.files(spark, planned, done_schema)
            done = keyed.files(spark, ledger, spark.table(name).schema)
            once = keyed.gather(pending(rows, done), "job_id", n, tasks)
        keyed.append(run(once), name)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a bucketed ledger."""
    schema = spark.read.parquet(f"{path}/*").schema
    return spark.table(keyed.table(spark, path, schema, "job_id"))


def ask_again(spark: SparkSession, ledger: str, scorer: Scorer, columns: list[str],
              partitions: int | None = None, **options) -> None:
    """Ask once more for the rows of a plain ledger the model has failed on; ``columns`` are those
    of the clean stage, which the ledger still has."""
    rows = read_or_empty(spark, ledger, LEDGER)
    if set(columns) <= set(rows.columns):
        left = settled(rows).filter(~F.col("answered")).select(*columns)
        append(enricher(scorer, partitions, **options)(left), ledger)


def final_table(ledger: DataFrame, as_of: Column | None = None, source: str = "jobs") -> DataFrame:
    """IT adverts of the ledger, one row each, with ingestion date and source tag."""
    day = F.current_date() if as_of is None else as_of
    return (settled(ledger).drop("_batch_id", "answered").filter("is_it_job")
            .withColumns({"ingestion_date": day, "source": F.lit(source)}))
