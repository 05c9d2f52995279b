"""Routing, scoring and resuming."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from jobmart import schemas
from jobmart.operators import enrich
from jobmart.plans.clean import COLUMNS, clean
from jobmart.sources import tables
from jobmart.streaming import ingest

LONG = "<p>" + "Mô tả công việc chi tiết " * 5 + "</p>"


def postings(spark, n=12):
    rows = []
    for i in range(n):
        rows.append({"job_id": str(i), "title": "Senior Java" if i % 2 else "Kế toán",
                     "mo_ta_cong_viec_html": LONG if i % 4 else "x", "experience": "2 năm",
                     "tags_specialization": [["Backend Developer"], ["Sales"], ["?"]][i % 3]})
    return spark.createDataFrame(rows + [{"job_id": None, "title": "no id"}], schemas.POSTING)


def counting_scorer(folder: str, fail_on: str | None = None):
    """Writes one file per call, so that calls on any worker can be counted."""
    def answer(text: str, timeout: float) -> str:
        import uuid
        from pathlib import Path

        Path(folder, uuid.uuid4().hex).write_text(str(timeout))
        if fail_on and fail_on in text:
            raise SystemError("model crashed")
        return '{"domain": "DevOps", "technical_skills": ["Docker"]}'
    return answer


@pytest.fixture
def calls(tmp_path):
    folder = tmp_path / "calls"
    folder.mkdir()
    return folder


def test_clean_columns(spark):
    df = clean(postings(spark))
    assert df.columns == COLUMNS
    assert df.count() == 12
    types = dict(df.dtypes)
    assert (types["exp_min"], types["min_salary"], types["deadline_date"], types["has_content"],
            types["is_it_preliminary"]) == ("float", "int", "date", "boolean", "string")


def test_routes_are_disjoint_and_complete(spark):
    df = enrich.route(clean(postings(spark)))
    got = {r.job_id: r.route for r in df.collect()}
    assert got == {str(i): "no_content" if i % 4 == 0 else "non_it" if i % 3 == 1 else "enrich"
                   for i in range(12)}
    todo = {r.job_id for r in enrich.to_enrich(clean(postings(spark))).collect()}
    assert todo == {k for k, v in got.items() if v == "enrich"}


def test_model_is_asked_once_per_row(spark, calls):
    todo = enrich.to_enrich(clean(postings(spark)))
    done = enrich.enrich(todo, counting_scorer(str(calls)))
    rows = done.filter("is_it_job").select("job_id", "domain", "technical_skills").collect()
    assert len(rows) == todo.count() == len(list(calls.iterdir()))
    assert {p.read_text() for p in calls.iterdir()} == {"20.0"}


def test_timeouts_are_retried_and_errors_default(spark, calls):
    def slow(text: str, timeout: float) -> str:
        from pathlib import Path
        import uuid

        Path(str(calls), uuid.uuid4().hex).write_text("x")
        raise TimeoutError

    todo = enrich.to_enrich(clean(postings(spark)))
    n = todo.count()
    rows = enrich.enrich(todo, slow).collect()
    assert {r.domain for r in rows} == {"Other"} and len(list(calls.iterdir())) == 2 * n
    broken = enrich.enrich(todo, counting_scorer(str(calls), "Senior Java")).collect()
    assert {(r.title, r.domain) for r in broken} <= {("Senior Java", "Other"), ("Kế toán", "DevOps")}
    assert len(list(calls.iterdir())) == 3 * n


def test_rule_verdict_beats_the_model(spark, calls):
    todo = enrich.to_enrich(clean(postings(spark)))
    rows = enrich.enrich(todo, lambda text, timeout: "{}").collect()
    assert all(r.is_it_job == (r.is_it_preliminary == "true") for r in rows)
    assert all((r.classification_source == "llm") == (r.is_it_preliminary == "none") for r in rows)


def test_interrupted_batches_resume_by_key(spark, tmp_path, calls):
    planned, ledger = str(tmp_path / "planned"), str(tmp_path / "ledger")
    todo = enrich.to_enrich(clean(postings(spark, 40)))
    wanted = {r.job_id for r in todo.collect()}
    enrich.plan_batches(todo, planned, 3)
    assert spark.read.parquet(planned).select("_batch_id").distinct().count() == 3
    scorer = counting_scorer(str(calls))
    enrich.run_batches(spark, planned, ledger, scorer, 1)
    first = len(list(calls.iterdir()))
    assert 0 < first < len(wanted)
    enrich.run_batches(spark, planned, ledger, scorer, 3)
    enrich.run_batches(spark, planned, ledger, scorer, 3)
    got = [r.job_id for r in spark.read.parquet(ledger).collect()]
    assert sorted(got) == sorted(wanted)
    assert len(list(calls.iterdir())) == len(wanted)


def test_rows_of_an_outage_are_asked_again(spark, tmp_path, calls):
    planned, ledger = str(tmp_path / "planned"), str(tmp_path / "ledger")
    todo = enrich.to_enrich(clean(postings(spark, 40)))
    wanted = sorted(r.job_id for r in todo.collect())
    enrich.plan_batches(todo, planned, 2)
    enrich.run_batches(spark, planned, ledger, counting_scorer(str(calls), "Senior Java"), 2)
    down = spark.read.parquet(ledger).filter("not answered").count()
    assert 0 < down < len(wanted)
    for _ in range(2):
        enrich.run_batches(spark, planned, ledger, counting_scorer(str(calls)), 2)
    rows = spark.read.parquet(ledger)
    assert sorted(r.job_id for r in enrich.answered(rows).collect()) == wanted
    assert len(list(calls.iterdir())) == len(wanted) + down
    final = enrich.final_table(rows)
    assert "answered" not in final.columns and sorted(r.job_id for r in final.collect()) == wanted


def test_more_batches_than_rows(spark, tmp_path, calls):
    planned, ledger = str(tmp_path / "planned"), str(tmp_path / "ledger")
    todo = enrich.to_enrich(clean(postings(spark, 4)))
    enrich.plan_batches(todo, planned, 12)
    enrich.run_batches(spark, planned, ledger, counting_scorer(str(calls)), 12)
    assert spark.read.parquet(ledger).count() == todo.count() == len(list(calls.iterdir()))


def test_incremental_enrichment_asks_only_for_new_rows(spark, tmp_path, calls):
    stage, ledger, progress = (str(tmp_path / n) for n in ("stage", "ledger", "progress"))
    tables.overwrite(clean(postings(spark, 12)), stage)
    scorer = counting_scorer(str(calls))
    ingest.enrich_new(spark, stage, ledger, progress, scorer)
    ingest.enrich_new(spark, stage, ledger, progress, scorer)
    before = len(list(calls.iterdir()))
    tables.overwrite(clean(postings(spark, 24)), stage)      # same rows again, plus new ones
    ingest.enrich_new(spark, stage, ledger, progress, scorer)
    ids = [r.job_id for r in spark.read.parquet(ledger).collect()]
    wanted = {r.job_id for r in enrich.to_enrich(spark.read.parquet(stage)).collect()}
    assert sorted(ids) == sorted(wanted)
    assert before < len(list(calls.iterdir())) == len(wanted)


def test_final_table(spark):
    ledger = spark.createDataFrame([("1", True, 0), ("2", False, 0)],
                                   "job_id string, is_it_job boolean, _batch_id int")
    (row,) = enrich.final_table(ledger, F.lit("2026-03-15").cast("date"), "site").collect()
    assert (row.job_id, str(row.ingestion_date), row.source) == ("1", "2026-03-15", "site")
    assert "_batch_id" not in row.asDict()


def test_enrichment_without_a_model(spark):
    rows = enrich.enrich_by_rules(enrich.to_enrich(clean(postings(spark)))).collect()
    assert rows and all(r.locations == ["Toàn quốc"] and r.job_level for r in rows)


def test_few_prompts_are_unpacked_at_a_time(spark):
    import pyarrow as pa

    class Batch:
        def __init__(self, values):
            self.values, self.asked = pa.array(values), []

        def __len__(self):
            return len(self.values)

        def slice(self, i, n):
            self.asked.append(n)
            return self.values.slice(i, n)

    batch = Batch(["x" * i for i in range(1, 1001)])
    run = enrich.asked(lambda text, timeout: str(len(text)) if len(text) % 2 else None).func
    got, = run(iter([batch]))
    assert got.to_pylist() == [str(i) if i % 2 else None for i in range(1, 1001)]
    assert max(batch.asked) <= 64 and sum(batch.asked) >= 1000


def test_answered_copies_leave_before_keys_meet(spark, tmp_path, monkeypatch):
    rows = clean(postings(spark))
    met, first = [], ingest.first_per_key

    def counted(df, key, order):
        met.append(df.count())
        return first(df, key, order)

    monkeypatch.setattr(ingest, "first_per_key", counted)
    for n in range(2):
        tables.append(rows.coalesce(1), f"{tmp_path}/stage")
        ingest.enrich_new(spark, f"{tmp_path}/stage", f"{tmp_path}/ledger", f"{tmp_path}/checkpoint", lambda p, t: "{}", files_per_batch=1)
    assert met[0] > 0 and met[-1] == 0
