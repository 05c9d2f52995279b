"""The three aggregate marts.

Input is the enriched table: ``job_id, technical_skills, locations, job_level, exp_min,
min_salary, max_salary``. Every aggregate combines on the map side, so a skill or a city holding
a large share of all rows reaches the shuffle as one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobmart import vocab
from jobmart.functions.labels import mart_city

#: Default bound on a skill's characters; longer ones are sentences. None keeps all.
MAX_SKILL_LENGTH = 40
TOP_SKILLS = 5
#: Tied skills that ``location_trend`` names in one text at most.
NAMED_SKILLS = 1000


def _day(as_of: Column | None) -> Column:
    return F.current_date() if as_of is None else as_of


def _paid_average(salary: str) -> Column:
    """Average over the rows whose salary is known, in the same pass as the counts."""
    value = F.col(salary).cast("double")
    return F.round(F.avg(F.when(value > 0, value)), 1)


def _share(count: str, df: DataFrame) -> Column:
    """Percentage of all rows of ``df``; the total is a scalar subquery over no columns."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return F.round(F.try_divide(F.col(count), total) * 100, 2)


def _short(skill: str | Column, longest: int | None) -> Column:
    return F.lit(True) if longest is None else F.length(skill) <= longest


def skill_demand(jobs: DataFrame, as_of: Column | None = None,
                 longest: int | None = MAX_SKILL_LENGTH) -> DataFrame:
    """Per skill of at most ``longest`` characters: adverts, share of all adverts, average top salary."""
    listed = jobs.select("job_id", "max_salary", F.explode("technical_skills").alias("skill_name"))
    usable = (F.col("skill_name") != "") & _short("skill_name", longest)
    return (
        listed.filter(usable).groupBy("skill_name")
        .agg(F.count("job_id").alias("job_count"), _paid_average("max_salary").alias("avg_salary"))
        .select("skill_name", "job_count", _share("job_count", jobs).alias("percentage"),
                "avg_salary", _day(as_of).alias("updated_date"))
        .orderBy(F.desc("job_count"), "skill_name"))


def skill_losses(jobs: DataFrame, longest: int | None = MAX_SKILL_LENGTH) -> DataFrame:
    """``metric, value``: listed skills, and those that ``skill_demand`` leaves out by reason."""
    skill = F.col("skill_name")
    blank = F.coalesce(skill, F.lit("")) == ""
    counts = jobs.select(F.explode("technical_skills").alias("skill_name")).agg(
        F.count(F.lit(1)).alias("listed"), F.count_if(blank).alias("blank"),
        F.count_if(~blank & ~_short(skill, longest)).alias("too_long"))
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in counts.columns])))


def top_skills(mart: DataFrame, n: int = 10) -> DataFrame:
    """Most demanded skills."""
    return (mart.select("skill_name", "job_count")
            .orderBy(F.desc("job_count"), "skill_name").limit(n))


def salary_benchmark(jobs: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Per known level, over adverts with a known salary: count, salaries, years.

    Years are truncated before averaging and the -1 of unknown experience takes part.
    """
    known = jobs.filter((F.col("min_salary") > 0) & (F.col("max_salary") > 0)
                        & (F.col("job_level") != "Unknown"))
    return (
        known.groupBy("job_level")
        .agg(F.count("job_id").alias("job_count"),
             F.round(F.avg(F.col("max_salary").cast("double")), 1).alias("avg_salary"),
             F.round(F.min("min_salary").cast("double"), 1).alias("min_salary"),
             F.round(F.max("max_salary").cast("double"), 1).alias("max_salary"),
             F.round(F.avg(F.col("exp_min").cast("int")), 1).alias("years_of_experience"))
        .withColumn("updated_date", _day(as_of))
        .orderBy("avg_salary", "job_level"))


_ALL, _CITY, _SKILL = 0, 1, 2


def _leading(jobs: DataFrame, n: int, longest: int | None) -> DataFrame:
    """From one evaluation of ``jobs``, per city bucket: a row for all adverts (every bucket has
    it), one for the city's adverts, and one for each skill ranked 1..``n``, ties included.

    Each advert is exploded into its marks, which one aggregate counts; the rank limit is applied per
    task before the window's shuffle, so a city's whole skill list never travels to one task. The
    other two kinds of rows are alone in theirs and have rank 1.
    """
    buckets = [*vocab.MART_CITIES, vocab.OTHER_CITY]

    def mark(city: Column, kind: int, skill: Column) -> Column:
        return F.struct(city.alias("city"), F.lit(kind).alias("kind"), skill.cast("string").alias("skill"))

    none, empty = F.lit(None), F.array().cast("array<string>")
    cities = F.transform(F.filter(F.coalesce("locations", empty), lambda c: c != ""), mart_city)
    listed = F.filter(F.coalesce("technical_skills", empty), lambda s: _short(s, longest) & s.isNotNull())
    marks = F.concat(
        F.array(*[mark(F.lit(b), _ALL, none) for b in buckets]),
        F.transform("_cities", lambda c: mark(c, _CITY, none)),
        F.flatten(F.transform("_cities", lambda c: F.transform("_skills", lambda s: mark(c, _SKILL, s)))))
    salary = F.col("max_salary").cast("double")
    counted = (
        jobs.select("job_id", "max_salary", cities.alias("_cities"), listed.alias("_skills"))
        .select("job_id", "max_salary", F.inline(marks)).groupBy("city", "kind", "skill")
        .agg(F.count(F.lit(1)).alias("cnt"), F.count("job_id").alias("jobs"),
             F.avg(F.when(salary > 0, salary)).alias("paid")))
    by_count = Window.partitionBy("city", "kind").orderBy(F.desc("cnt"))
    return counted.withColumn("rnk", F.rank().over(by_count)).filter(F.col("rnk") <= n)


def top_skills_per_city(jobs: DataFrame, n: int = TOP_SKILLS,
                        longest: int | None = MAX_SKILL_LENGTH) -> DataFrame:
    """``city, skill, cnt, rnk``: the skills ranked 1..n by adverts, ties included, as rows."""
    found = _leading(jobs, n, longest).filter(F.col("kind") == _SKILL)
    return found.select("city", "skill", "cnt", "rnk")


def location_trend(jobs: DataFrame, as_of: Column | None = None,
                   longest: int | None = MAX_SKILL_LENGTH, named: int = NAMED_SKILLS) -> DataFrame:
    """Per city bucket: adverts, share, average top salary, leading skills.

    ``jobs`` is read once. ``top_skills`` names the first ``named`` of the leading skills at most;
    ``top_skills_per_city`` has all of them where more are tied.
    """
    place = F.row_number().over(Window.partitionBy("city", "kind").orderBy(F.desc("cnt"), "skill"))
    rows = _leading(jobs, TOP_SKILLS, longest).withColumn("place", place).filter(F.col("place") <= named)

    def of(kind: int, column: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col(column)))

    skill = F.when(F.col("kind") == _SKILL, F.struct("place", "skill"))
    names = F.array_join(F.transform(F.array_sort(F.collect_list(skill)), lambda s: s["skill"]), ", ")
    return (
        rows.groupBy("city").agg(
            of(_CITY, "jobs").alias("job_count"), of(_ALL, "cnt").alias("total"),
            F.round(of(_CITY, "paid"), 1).alias("avg_salary"), F.nullif(names, F.lit("")).alias("top_skills"))
        .filter("job_count IS NOT NULL")
        .select("city", "job_count", F.round(F.try_divide("job_count", "total") * 100, 2).alias("percentage"),
                "avg_salary", "top_skills", _day(as_of).alias("updated_date"))
        .orderBy(F.desc("job_count"), "city"))
