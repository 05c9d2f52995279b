"""Quality reports. Each is one pass over its input, however many counters it has."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from jobmart import vocab
from jobmart.functions.fields import is_empty_list

# --- fixed values: share above which a counter raises a warning ------------------------------
WARN_ABOVE = {"level_unknown": 0.3, "skills_empty": 0.2, "domain_other": 0.15}


def _report(df: DataFrame, tests: Mapping[str, Column],
            limits: Mapping[str, float] | None = None) -> DataFrame:
    """``metric, value, ratio, threshold, breached``; ``total`` comes first."""
    counts = df.agg(F.count(F.lit(1)).alias("total"),
                    *[F.count_if(test).alias(name) for name, test in tests.items()])
    limits = limits or {}
    rows = []
    for name in ["total", *tests]:
        ratio = F.col(name) / F.greatest(F.col("total"), F.lit(1))
        limit = F.lit(limits.get(name)).cast("double")
        rows.append(F.struct(
            F.lit(name).alias("metric"), F.col(name).alias("value"), ratio.alias("ratio"),
            limit.alias("threshold"), F.coalesce(ratio > limit, F.lit(False)).alias("breached")))
    return counts.select(F.inline(F.array(*rows)))


def clean_tests() -> dict[str, Column]:
    """Gaps of the clean stage and the preliminary verdicts."""
    verdict = F.col("is_it_preliminary")
    return {
        "no_content": ~F.col("has_content"),
        "salary_unknown": F.col("min_salary") == -1,
        "experience_unknown": F.col("exp_min") == -1,
        "deadline_missing": F.col("deadline_date").isNull(),
        "it_true": verdict == "true",
        "it_false": verdict == "false",
        "it_none": verdict == "none",
        "to_enrich": F.col("has_content") & (verdict != "false"),
    }


def clean_report(clean: DataFrame) -> DataFrame:
    """The report of ``clean_tests``."""
    return _report(clean, clean_tests())


def counters(tests: Mapping[str, Column]) -> list[Column]:
    """The same counts as metrics for ``DataFrame.observe``, which a job takes along as it writes."""
    return [F.count(F.lit(1)).alias("total"), *[F.count_if(t).alias(n) for n, t in tests.items()]]


def final_report(final: DataFrame) -> DataFrame:
    """Gaps of the enriched table, with warnings."""
    return _report(final, {
        "level_unknown": F.col("job_level") == "Unknown",
        "skills_empty": is_empty_list(F.col("technical_skills")),
        "salary_unknown": F.col("min_salary") == -1,
        "source_rule": F.col("classification_source") == "rule",
        "source_llm": F.col("classification_source") == "llm",
        "domain_other": F.col("domain") == vocab.OTHER_DOMAIN,
    }, WARN_ABOVE)


def rules_report(tagged: DataFrame) -> DataFrame:
    """Coverage of the rule-only path over all input rows; the fields count IT rows only."""
    it = F.col("is_it")
    return _report(tagged, {
        "it": it,
        "with_salary": it & F.col("min_salary").isNotNull(),
        "with_level": it & F.col("level").isNotNull(),
        "with_domain": it & F.col("domain").isNotNull(),
        "with_skills": it & F.col("skills").isNotNull(),
        "with_any_skill": it & (F.size("skills") > 0),
    })


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.desc("cnt"), column))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)
