"""Deadline, requirement tags, IT verdicts, provenance and other single-field rules."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobmart import vocab
from jobmart.functions.matching import contains_any
from jobmart.functions.text import SPACE, ascii_digits, extract, strip

# --- fixed values: requirement-tag patterns --------------------------------------------------
AGE_RANGE = rf"Tuổi{SPACE}+([0-9]+){SPACE}*[-–]{SPACE}*([0-9]+)"
AGE_FROM = rf"Từ{SPACE}+([0-9]+){SPACE}*tuổi"
LANGUAGE = r"\A(Tiếng [\p{L}\p{N}_]+)"
GENDERS = ["Nam", "Nữ"]
#: Default of ``has_content``: a text needs more characters than that.
MIN_CONTENT = 50


def with_deadline(df: DataFrame, source: str = "deadline") -> DataFrame:
    """Add ``deadline_date``: the date behind an optional ``label:``.

    Understands day/month/year, day-month-year and ISO; an impossible date is NULL.
    """
    t = F.col("_t")
    return (
        df.withColumn("_t", F.regexp_replace(strip(F.col(source)), rf"\A[^\n]*?:{SPACE}*", ""))
        .withColumn(
            "deadline_date",
            F.when(t.rlike(r"\A[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z"), F.try_to_date(t, "d/M/yyyy"))
            .when(t.rlike(r"\A[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}\z"), F.try_to_date(t, "d-M-yyyy"))
            .when(t.rlike(r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"), F.try_to_date(t, "yyyy-M-d")))
        .drop("_t"))


def has_content(description: Column, requirements: Column, least: int = MIN_CONTENT) -> Column:
    """Whether either text has more than ``least`` characters, so is worth reading."""
    return F.coalesce(
        (F.length(description) > least) | (F.length(requirements) > least), F.lit(False))


def _last(c: Column, default: Column) -> Column:
    return F.coalesce(F.try_element_at(c, F.lit(-1)), default)


def with_requirement_tags(df: DataFrame, source: str = "tags_requirement") -> DataFrame:
    """Add ``edu_level, gender, age_min, age_max, req_languages``; the last fitting tag wins."""
    tags, numbers = F.col("_tags"), F.col("_numbers")

    def ages(pick: Callable[[Column], Column]) -> Column:
        found = F.transform(numbers, lambda t: pick(t).try_cast("int"))
        return _last(F.array_compact(found), F.lit(-1))

    languages = F.array_compact(F.transform(tags, lambda t: extract(t, LANGUAGE)))
    return (
        df.withColumn("_tags", F.transform(F.array_compact(F.col(source)), strip))
        .withColumn("_numbers", F.transform(tags, ascii_digits))
        .withColumns({
            "edu_level": _last(F.filter(tags, lambda t: contains_any(t, vocab.EDUCATION)),
                               F.lit("unknown")),
            "gender": _last(F.filter(tags, lambda t: t.isin(GENDERS)), F.lit("any")),
            "age_min": ages(lambda t: F.coalesce(extract(t, AGE_FROM),
                                                 extract(t, AGE_RANGE, 1))),
            "age_max": ages(lambda t: extract(t, AGE_RANGE, 2)),
            "req_languages": F.coalesce(languages, F.array().cast("array<string>"))})
        .drop("_tags", "_numbers"))


def it_verdict(tags: Column, it_tags: Sequence[str] = tuple(vocab.IT_TAGS),
               non_it_tags: Sequence[str] = tuple(vocab.NON_IT_TAGS)) -> Column:
    """Three-valued text verdict: ``false`` beats ``true`` beats ``none``."""
    def has(words: Sequence[str]) -> Column:
        known = sorted({w.lower() for w in words})
        hit = F.exists(tags, lambda t: F.coalesce(strip(F.lower(t)).isin(known), F.lit(False)))
        return F.coalesce(hit, F.lit(False))

    return F.when(has(non_it_tags), "false").when(has(it_tags), "true").otherwise("none")


def is_it_domain(domains: Column) -> Column:
    """True when a real domain was found, that is anything but exactly ``["Other"]``."""
    only_other = domains == F.array(F.lit(vocab.OTHER_DOMAIN))
    return F.coalesce((F.size(domains) > 0) & ~only_other, F.lit(False))


def it_decision(verdict: Column, domain: Column) -> Column:
    """The rule verdict overrides the model; otherwise any domain but "Other" is IT."""
    return (F.when(verdict == "true", True).when(verdict == "false", False)
            .otherwise(~domain.eqNullSafe(F.lit(vocab.OTHER_DOMAIN))))


def provenance(verdict: Column) -> Column:
    """``llm`` where the rules had no verdict, else ``rule``."""
    return F.when(verdict == "none", F.lit("llm")).otherwise(F.lit("rule"))


def is_empty_list(c: Column) -> Column:
    return c.isNull() | (F.size(c) == 0)
