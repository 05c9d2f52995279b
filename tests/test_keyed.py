"""Keyed ledgers, one-job enrichment, routing in one pass, run directories."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from jobmart.operators import enrich
from jobmart.operators.quality import clean_report
from jobmart.plans.clean import clean
from jobmart.session import scratch
from jobmart.sources import bronze, files, keyed, tables

REPLY = '{"domain": "DevOps", "technical_skills": ["Docker"]}'
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stage(spark):
    from checks.inputs import varied

    path = f"{scratch(spark, 'stage')}/stage"
    tables.overwrite(clean(varied(spark, SF)), path)
    return spark.read.parquet(path)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ledger_side_is_not_shuffled(spark, stage):
    base = scratch(spark, "keyed")
    todo = enrich.to_enrich(stage)
    enrich.plan_keyed(todo, f"{base}/planned", 4)
    enrich.run_pending(spark, f"{base}/planned", f"{base}/ledger", lambda p, t: REPLY, buckets=4)
    ledger = enrich.read_ledger(spark, f"{base}/ledger")
    assert ledger.count() == todo.count() and ledger.filter("not answered").count() == 0
    other = enrich.pending(todo, ledger)  # a plain table against the ledger
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sides = plan_of(other).split("SortMergeJoin")[1]
        assert sides.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in sides
        both = enrich.pending(spark.table(keyed.table(spark, f"{base}/planned", todo.schema, "job_id")), ledger)
        assert "Exchange" not in plan_of(both) and both.count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucket_count_belongs_to_the_data(spark):
    path = scratch(spark, "count")
    df = spark.createDataFrame([("a", 1), (None, 2)], "job_id string, n int")
    keyed.append(df, keyed.table(spark, path, df.schema, "job_id", 3))
    keyed.append(df, keyed.table(spark, path, df.schema, "job_id", 8))
    assert keyed.buckets(spark, path) == 3
    assert spark.table(keyed.table(spark, path, df.schema, "job_id", 5)).count() == 4
    assert keyed.buckets(spark, f"{path}/absent") is None


def test_a_stopped_job_keeps_what_is_done_and_asks_each_advert_once(spark, stage, tmp_path):
    base = scratch(spark, "stopped")
    todo = enrich.to_enrich(stage)
    enrich.plan_keyed(todo.unionByName(todo), f"{base}/planned", 4)
    asked = tmp_path / "asked"
    asked.mkdir()

    def scorer(text, timeout):
        import os
        import time
        with open(asked / str(os.getpid()), "a") as f:
            f.write(text.split("\n")[0] + "\n")
        return REPLY

    def dying(text, timeout):
        from pyspark import TaskContext
        if TaskContext.get().partitionId() == 3:
            import time
            time.sleep(5)
            raise SystemExit("lost")
        return REPLY

    with pytest.raises(Exception):
        enrich.run_pending(spark, f"{base}/planned", f"{base}/ledger", dying, buckets=4, in_flight=1)
    done = enrich.read_ledger(spark, f"{base}/ledger").select("job_id").collect()
    assert 0 < len(done) < todo.count()
    enrich.run_pending(spark, f"{base}/planned", f"{base}/ledger", scorer, buckets=4)
    ledger = enrich.read_ledger(spark, f"{base}/ledger")
    assert ledger.count() == ledger.select("job_id").distinct().count() == todo.count()
    assert sum(len(f.read_text().splitlines()) for f in asked.iterdir()) >= todo.count() - len(done)


def test_small_tasks_and_rows_that_failed(spark, stage):
    base = scratch(spark, "waves")
    todo = enrich.to_enrich(stage)
    enrich.plan_keyed(todo, f"{base}/planned", 2)

    def down(text, timeout):
        raise ConnectionError

    enrich.run_pending(spark, f"{base}/planned", f"{base}/ledger", down, buckets=2, rows_per_task=10)
    enrich.run_pending(spark, f"{base}/planned", f"{base}/ledger", lambda p, t: REPLY, buckets=2, rows_per_task=10)
    ledger = enrich.read_ledger(spark, f"{base}/ledger")
    assert ledger.filter("answered").count() == ledger.filter("not answered").count() == todo.count()
    assert enrich.settled(ledger).count() == todo.count()
    enrich.run_pending(spark, f"{base}/planned", f"{base}/ledger", down, buckets=2)  # nothing left
    assert enrich.read_ledger(spark, f"{base}/ledger").count() == 2 * todo.count()


def test_route_all_counts_in_the_writing_job(spark):
    from checks.inputs import varied

    path = f"{scratch(spark, 'routes')}/stage"
    counted = enrich.route_all(varied(spark, SF), path)
    report = {r.metric: r.value for r in clean_report(clean(varied(spark, SF))).collect()}
    assert {k: v for k, v in counted.items() if k != "null_keys"} == report
    assert counted["null_keys"] > 0
    routes = {r.route: r["count"] for r in spark.read.parquet(path).groupBy("route").count().collect()}
    assert set(routes) == {"no_content", "non_it", "enrich"} and sum(routes.values()) == counted["total"]
    none = enrich.route_all(varied(spark, SF).where("false"), f"{path}-none")
    assert none["total"] == none["null_keys"] == 0


def test_newest_run_among_directories(spark, tmp_path):
    base = tmp_path / "runs"
    assert bronze.latest_run(spark, str(base)) is None
    for name in ("20260101_080000", "20260315_101010", "notes", "20260315_1010101"):
        (base / name).mkdir(parents=True)
    (base / "20270101_000000").write_text("a file")
    assert bronze.latest_run(spark, str(base)) == f"{base}/20260315_101010"
    assert "20270101_000000" in files.children(spark, str(base))


def test_buckets_are_written_and_read_by_several_tasks(spark, stage):
    base = scratch(spark, "keyed")
    todo = enrich.to_enrich(stage)
    enrich.plan_keyed(todo, f"{base}/planned", 1)
    rows = keyed.files(spark, f"{base}/planned", todo.schema)
    assert rows.count() == todo.select("job_id").distinct().count()
    assert rows.select(F.input_file_name()).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    for _ in range(2):  # the second run finds all of them answered
        enrich.run_pending(spark, f"{base}/planned", f"{base}/ledger", lambda p, t: REPLY, buckets=1, rows_per_task=20)
        assert enrich.read_ledger(spark, f"{base}/ledger").count() == rows.count()
