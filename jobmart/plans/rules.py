"""Rule-only path: domain, IT filter and all other fields from dictionaries, no model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from jobmart import vocab
from jobmart.functions.experience import with_rules_experience
from jobmart.functions.fields import is_it_domain
from jobmart.functions.labels import city, posting_text, rules_level, skills, with_domains
from jobmart.functions.salary import with_rules_salary
from jobmart.functions.text import collapse_spaces

Vocabulary = Mapping[str, Sequence[str]]


def tagged(postings: DataFrame, vocabulary: Vocabulary = vocab.DOMAINS) -> DataFrame:
    """Add ``domain`` (array) and ``is_it``, keeping the pooled text for the skill matcher."""
    pooled = postings.withColumn("_text", posting_text())
    found = with_domains(pooled, "_text", vocabulary)
    return found.withColumn("is_it", is_it_domain(F.col("domain")))


def rule_fields(rows: DataFrame, dictionary: Vocabulary = vocab.SKILLS) -> DataFrame:
    """Company, salary, city, years, level and skills of rows from ``tagged``."""
    return (
        rows.transform(with_rules_salary).transform(with_rules_experience)
        .withColumns({
            "company": collapse_spaces(F.col("company")),
            "city": city(F.col("location")),
            "level": rules_level(F.col("title"), F.col("experience")),
            "skills": skills(F.col("_text"), F.col("domain"), dictionary)})
        .drop("_text"))


def process(postings: DataFrame, dictionary: Vocabulary = vocab.SKILLS) -> DataFrame:
    """The whole rule-only path. Non-IT adverts are dropped before the other fields are read."""
    return (postings.transform(tagged).filter("is_it")
            .transform(lambda df: rule_fields(df, dictionary)))


def as_mart_input(ruled: DataFrame) -> DataFrame:
    """Shape rule-only rows like the enriched table, so that the marts can read them.

    Salaries round up to whole million VND and use -1 for unknown; the province label of Ho Chi
    Minh City is spelt the way the location mart looks for it.
    """
    def whole(name: str):
        return F.coalesce(F.ceil(F.col(name)).cast("int"), F.lit(-1)).alias(name)

    place = F.when(F.col("city") == "TP.HCM", F.lit("Hồ Chí Minh")).otherwise(F.col("city"))
    return ruled.select(
        "job_id", "title", F.col("skills").alias("technical_skills"),
        F.array(place).alias("locations"),
        F.coalesce("level", F.lit("Unknown")).alias("job_level"),
        F.coalesce("years_of_experience", F.lit(-1.0).cast("float")).alias("exp_min"),
        whole("min_salary"), whole("max_salary"),
    )
