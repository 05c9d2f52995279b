"""Sources, sinks, deduplication and the message stream."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from jobmart import schemas, vocab
from jobmart.operators.dedup import first_per_key, first_stored
from jobmart.sources import bronze, catalog, tables
from jobmart.streaming import ingest


def messages(spark, rows):
    return spark.createDataFrame([(k, v) for k, v in rows], schemas.MESSAGE)


def advert(i, **more):
    return json.dumps({"job_id": str(i), "title": f"t{i}", "tags": ["a"], **more})


def test_batch_dedup_keeps_the_first(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "hot", "hot", str(rng.randint(0, 20))]), rng.randint(0, 50), i)
            for i in range(600)]
    df = spark.createDataFrame(rows, "job_id string, ts int, n int").repartition(4)
    got = {r.job_id: (r.ts, r.n) for r in first_per_key(df, "job_id", ["ts", "n"]).collect()}
    assert got == {k: min((t, n) for k2, t, n in rows if k2 == k) for k, _, _ in rows}


def test_batch_dedup_is_idempotent(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "job_id string, ts int")
    once = first_per_key(df, "job_id", ["ts"])
    twice = first_per_key(once.unionByName(once), "job_id", ["ts"])
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


@pytest.mark.parametrize("options", [{}, {"spread": 0}])
def test_stream_dedup_survives_replays(spark, tmp_path, options):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    first = [("k", advert(i % 7, url=f"u{i}")) for i in range(40)] + [(None, "broken {")] * 3
    tables.overwrite(messages(spark, first), source)
    ingest.ingest(ingest.message_files(spark, source, 1), out, progress, **options)
    tables.append(messages(spark, first[:10] + [("k", advert(99))]), source)
    ingest.ingest(ingest.message_files(spark, source, 1), out, progress, **options)
    ids = [r.job_id for r in spark.read.parquet(out).collect()]
    assert sorted(ids, key=str) == sorted([*map(str, range(7)), "99", None], key=str)


def test_stream_dedup_with_bounded_state(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    rows = [("a", "2026-01-01 00:00:00"), ("a", "2026-01-01 00:05:00"), ("b", "2026-01-01 00:06:00")]
    df = spark.createDataFrame(rows, "job_id string, at string")
    tables.overwrite(df.withColumn("at", F.to_timestamp("at")), source)
    stream = spark.readStream.schema("job_id string, at timestamp").parquet(source)
    ingest.to_parquet(ingest.distinct_within(stream, "at", "1 hour"), out,
                      progress).awaitTermination()
    assert sorted(r.job_id for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_message_round_trip(spark):
    row = {"job_id": "1", "title": 'q"\n', "tags": ["a", "é"], "deadline": None}
    df = spark.createDataFrame([row], schemas.POSTING)
    sent = bronze.to_messages(df)
    assert sent.first().key == "1"
    assert bronze.from_messages(sent).collect() == df.collect()


def test_latest_run_ignores_files_beside_the_runs(spark, tmp_path):
    for run, title in (("20260101_080000", "old"), ("20260315_101010", "new")):
        (tmp_path / run).mkdir()
        (tmp_path / run / "page_001.json").write_text(
            json.dumps([{"job_id": "1", "title": title}, {"job_id": "2", "tags": ["x"]}], indent=2))
    (tmp_path / "zz_merged.json").write_text("[]")
    run = bronze.latest_run(spark, str(tmp_path))
    assert run.endswith("20260315_101010")
    rows = bronze.read_run(spark, run).orderBy("job_id").collect()
    assert [(r.job_id, r.title, r.tags, r.deadline) for r in rows] == [
        ("1", "new", None, None), ("2", None, ["x"], None)]


def test_missing_path_reads_as_empty(spark, tmp_path):
    df = tables.read_or_empty(spark, str(tmp_path / "none"), "job_id string")
    assert df.columns == ["job_id"] and df.count() == 0


def test_other_read_errors_are_raised(spark, tmp_path):
    (tmp_path / "bad.parquet").write_text("not parquet")
    with pytest.raises(Exception) as error:
        tables.read_or_empty(spark, str(tmp_path / "bad.parquet"), "job_id string").count()
    assert not isinstance(error.value, AnalysisException) or "PATH_NOT_FOUND" not in str(error.value)


def test_declared_but_absent_columns_read_as_null(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark.createDataFrame([("1",)], "job_id string"), path)
    row = tables.read_postings(spark, path).first()
    assert row.job_id == "1" and row.deadline is None and len(row) == 14


def test_partition_overwrite_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    day = lambda n, d: spark.range(n).withColumn("day", F.lit(d).cast("date"))
    tables.overwrite_partitions(day(5, "2026-01-01"), path, ["day"])
    tables.overwrite_partitions(day(3, "2026-01-02"), path, ["day"])
    tables.overwrite_partitions(day(2, "2026-01-02"), path, ["day"])
    assert spark.read.parquet(path).count() == 7


def test_catalog(spark, tmp_path):
    path = str(tmp_path / "final")
    df = spark.range(6).select("id", F.array(F.lit("x")).alias("skills"),
                               F.date_add(F.lit("2026-01-01").cast("date"),
                                          (F.col("id") % 2).cast("int")).alias("day"))
    tables.overwrite_partitions(df, path, ["day"])
    for _ in range(2):
        catalog.create_database(spark, "jobs_test", str(tmp_path))
        table = catalog.register(spark, "jobs_test", "silver", path, ["day"])
    assert table.filter("day = DATE'2026-01-01'").count() == 3
    assert catalog.row_count(spark, "jobs_test", "silver").first().total_jobs == 6
    assert [r[0] for r in catalog.partitions(spark, "jobs_test", "silver").collect()] == [
        "day=2026-01-01", "day=2026-01-02"]
    spark.sql("DROP TABLE jobs_test.silver")
    assert spark.read.parquet(path).count() == 6


def test_vocabulary_table(spark, tmp_path):
    path = str(tmp_path / "v")
    tables.overwrite(spark.createDataFrame([("B", "y"), ("A", "x"), ("A", "w")],
                                           "label string, keyword string"), path)
    assert vocab.read_vocabulary(spark, path) == {"A": ["w", "x"], "B": ["y"]}
    assert vocab.merge({"A": ["q"], "C": ["z"]}, {"A": ["x"]}) == {"A": ["x"], "C": ["z"]}


def test_preview(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "n int, s string")
    assert [r.s for r in tables.preview(df, ["n", "s"], ["n"], 2).collect()] == ["a", "b"]


def test_salted_state_is_forgotten_and_the_keys_are_not(spark, tmp_path):
    import time

    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for i in range(3):  # the same 20 keys, and copies of one, in each start
        tables.append(messages(spark, [("k", advert(k)) for k in [*range(20), *[0] * 30]]), source)
        query = ingest.ingest(ingest.message_files(spark, source), out, progress, remember="1 second")
        time.sleep(2)
    assert spark.read.parquet(out).count() == 20
    tables.append(messages(spark, [("k", advert(99))]), source)
    query = ingest.ingest(ingest.message_files(spark, source), out, progress, remember="1 second")
    rows = {o.operatorName: o.numRowsTotal for p in query.recentProgress for o in p.stateOperators}
    assert rows["dedupe"] == 21  # one for each key
    assert rows["dedupeWithinWatermark"] < 20  # those of earlier starts are gone
    assert spark.read.parquet(out).count() == 21


def test_first_stored_reads_whole_rows_by_place(spark, tmp_path):
    rows = [(k, ts, {"a": {"x": ts}}, [({"m": k},)]) for k, ts in [("b", 3), ("a", 2), ("b", 1), (None, 5), ("a", 2), (None, 4)]]
    df = spark.createDataFrame(rows, "job_id string, ts int, m map<string,map<string,int>>, s array<struct<n:map<string,string>>>")
    df.repartition(3).write.parquet(str(tmp_path / "t"))
    kept = first_stored(spark.read.parquet(str(tmp_path / "t")), "job_id", ["ts"])
    assert sorted(((r.job_id, r.ts, r.m["a"]["x"]) for r in kept.collect()), key=str) == [("a", 2, 2), ("b", 1, 1), (None, 4, 4)]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    aggregate = next(line for line in plan.splitlines() if "Aggregate [" in line)
    assert "m#" not in aggregate and "s#" not in aggregate


def test_written_partitions_are_added_by_name(spark, tmp_path):
    base = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a'b"), (2, None), (3, "c")], "n int, day string")
    database = "added_" + tmp_path.name.replace("-", "_").lower()
    catalog.create_database(spark, database, str(tmp_path / "db"))
    df.write.partitionBy("day").parquet(base)
    catalog.register(spark, database, "t", base, ["day"], find=False)
    assert spark.table(f"{database}.t").count() == 0
    assert catalog.add_partitions(spark, database, "t", df.where("n < 3"), ["day"]) == 2
    assert sorted(r.n for r in spark.table(f"{database}.t").collect()) == [1, 2]
    assert catalog.add_partitions(spark, database, "t", df, ["day"], most=1) == 2  # lists the table
    assert spark.table(f"{database}.t").count() == 3
    assert catalog.add_partitions(spark, database, "t", df.where("false"), ["day"]) == 0
