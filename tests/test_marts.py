from __future__ import annotations

import random
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from jobmart.functions.labels import mart_city
from jobmart.operators import marts, quality

SCHEMA = ("job_id string, technical_skills array<string>, locations array<string>, "
          "job_level string, exp_min float, min_salary int, max_salary int")
PLACES = ["Hà Nội", "Hồ Chí Minh", "TP Đà Nẵng", "Toàn quốc", "Huế", "Hải Phòng", ""]


def jobs(n=400, seed=5):
    rng = random.Random(seed)
    names = [f"s{i}" for i in range(30)] + ["x" * 40, "y" * 41, ""]
    out = []
    for i in range(n):
        # One skill and one city hold a large share of all rows.
        skills = None if rng.random() < 0.1 else rng.choices(names, k=rng.randint(0, 6)) + ["hot"]
        places = None if rng.random() < 0.1 else rng.choices(PLACES, k=rng.randint(0, 2)) + ["Hà Nội"]
        top = rng.choice([-1, -1, 0, *range(5, 60)])
        out.append((str(i), skills, places,
                    rng.choice(["Senior", "Junior", "Unknown", None]),
                    rng.choice([-1.0, 0.0, 1.9, 2.5, 7.0]), rng.choice([-1, 5, 10]), top))
    return out


def rounded(x: Decimal, digits: int) -> float:
    return float(x.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def average(values):
    return rounded(Decimal(sum(values)) / len(values), 1) if values else None


def bucket(place):
    for name in ("Hà Nội", "Hồ Chí Minh", "Đà Nẵng", "Toàn quốc"):
        if name in place:
            return name
    return "Khác"


def test_skill_demand(spark):
    rows = jobs()
    got = {r.skill_name: (r.job_count, r.percentage, r.avg_salary)
           for r in marts.skill_demand(spark.createDataFrame(rows, SCHEMA)).collect()}
    salaries = defaultdict(list)
    for r in rows:
        for s in r[1] or []:
            if s and len(s) <= 40:
                salaries[s].append(r[6])
    assert got == {
        s: (len(v), rounded(Decimal(len(v) * 100) / len(rows), 2), average([x for x in v if x > 0]))
        for s, v in salaries.items()}


def test_order_of_the_skill_mart(spark):
    got = marts.skill_demand(spark.createDataFrame(jobs(), SCHEMA)).collect()
    assert got == sorted(got, key=lambda r: (-r.job_count, r.skill_name))
    assert got[0].skill_name == "hot"
    top = marts.top_skills(marts.skill_demand(spark.createDataFrame(jobs(), SCHEMA)), 3).collect()
    assert [r.skill_name for r in top] == [r.skill_name for r in got[:3]]


def test_salary_benchmark_counts_the_sentinel_years(spark):
    rows = jobs()
    got = {r.job_level: (r.job_count, r.avg_salary, r.min_salary, r.max_salary,
                         r.years_of_experience)
           for r in marts.salary_benchmark(spark.createDataFrame(rows, SCHEMA)).collect()}
    groups = defaultdict(list)
    for r in rows:
        if r[5] > 0 and r[6] > 0 and r[3] not in (None, "Unknown"):
            groups[r[3]].append(r)
    assert got == {
        level: (len(g), average([r[6] for r in g]), float(min(r[5] for r in g)),
                float(max(r[6] for r in g)), average([int(r[4]) for r in g]))
        for level, g in groups.items()}
    assert any(r[4] == -1.0 for g in groups.values() for r in g)


def test_location_trend(spark):
    rows = jobs()
    got = {r.city: (r.job_count, r.percentage, r.avg_salary, r.top_skills)
           for r in marts.location_trend(spark.createDataFrame(rows, SCHEMA)).collect()}
    pay, skills = defaultdict(list), defaultdict(Counter)
    for r in rows:
        for p in r[2] or []:
            if p:
                pay[bucket(p)].append(r[6])
                skills[bucket(p)].update(s for s in r[1] or [] if len(s) <= 40)

    def top(counter):
        keep = [(s, c) for s, c in counter.items()
                if sum(o > c for o in counter.values()) < 5]
        return ", ".join(s for s, _ in sorted(keep, key=lambda p: (-p[1], p[0])))

    assert got == {
        c: (len(v), rounded(Decimal(len(v) * 100) / len(rows), 2),
            average([x for x in v if x > 0]), top(skills[c]))
        for c, v in pay.items()}


def test_ties_may_exceed_five(spark):
    rows = [(str(i), [f"s{i}"], ["Hà Nội"], "Senior", 1.0, 5, 10) for i in range(7)]
    (row,) = marts.location_trend(spark.createDataFrame(rows, SCHEMA)).collect()
    assert row.top_skills == ", ".join(f"s{i}" for i in range(7))


def test_city_without_skills_stays(spark):
    rows = [("1", None, ["Huế"], "Senior", 1.0, 5, -1)]
    (row,) = marts.location_trend(spark.createDataFrame(rows, SCHEMA)).collect()
    assert (row.city, row.job_count, row.avg_salary, row.top_skills) == ("Khác", 1, None, None)


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for mart in (marts.skill_demand, marts.salary_benchmark, marts.location_trend):
        assert mart(empty).collect() == []
    report = quality.final_report(empty.withColumns({
        "classification_source": F.lit("rule"), "domain": F.lit("x")})).collect()
    assert {r.value for r in report} == {0} and not any(r.breached for r in report)


def test_final_report_warns_above_the_limit(spark):
    rows = [(str(i), ["a"] if i % 5 else [], [], "Unknown" if i < 4 else "Senior", 1.0,
             -1 if i < 3 else 5, 9) for i in range(10)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({
        "classification_source": F.when(F.col("job_id") < "4", "llm").otherwise("rule"),
        "domain": F.when(F.col("job_id") == "0", "Other").otherwise("DevOps")})
    got = {r.metric: (r.value, r.ratio, r.breached) for r in quality.final_report(df).collect()}
    assert got == {
        "total": (10, 1.0, False), "level_unknown": (4, 0.4, True), "skills_empty": (2, 0.2, False),
        "salary_unknown": (3, 0.3, False), "source_rule": (6, 0.6, False),
        "source_llm": (4, 0.4, False), "domain_other": (1, 0.1, False)}


def test_distribution_is_sorted(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "v string")
    assert [tuple(r) for r in quality.distribution(df, "v").collect()] == [
        ("b", 2), (None, 1), ("a", 1)]
    assert [r[0] for r in quality.distinct_values(df, "v").collect()] == [None, "a", "b"]


def test_mart_city_is_case_sensitive(spark):
    df = spark.createDataFrame([("hà nội",), ("Hà Nội mới",)], "s string")
    assert [r[0] for r in df.select(mart_city(F.col("s"))).collect()] == ["Khác", "Hà Nội"]


def test_location_trend_reads_its_input_once(spark):
    from checks.inputs import part_jobs

    jobs = part_jobs(spark, "/root/testdata/sf0.001").withColumn("locations", F.array(F.lit("Hà Nội"), F.lit(""), F.lit(None)))
    plan = marts.location_trend(jobs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and "WindowGroupLimit" in plan


def test_many_tied_skills_stay_rows(spark):
    jobs = spark.range(3000).select(
        F.col("id").cast("string").alias("job_id"), F.array(F.lit("Huế")).alias("locations"), F.lit(5).alias("max_salary"),
        F.array(F.concat(F.lit("s"), F.lpad(F.col("id").cast("string"), 5, "0"))).alias("technical_skills"))
    (row,) = marts.location_trend(jobs).collect()
    assert row.top_skills.split(", ") == [f"s{i:05d}" for i in range(marts.NAMED_SKILLS)]
    assert marts.top_skills_per_city(jobs).count() == 3000 and row.percentage == 100


def test_skill_losses(spark):
    jobs = spark.createDataFrame([(["a", "", None, "x" * 41],), (None,), ([],)], "technical_skills array<string>")
    assert {r.metric: r.value for r in marts.skill_losses(jobs).collect()} == {"listed": 4, "blank": 2, "too_long": 1}
    none = marts.skill_losses(jobs, longest=None).collect()
    assert {r.metric: r.value for r in none}["too_long"] == 0
