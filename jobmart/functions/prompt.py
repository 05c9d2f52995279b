"""Prompt text for a model, and tolerant reading of its reply. Both are plain columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from jobmart import schemas, vocab
from jobmart.functions.fields import it_decision
from jobmart.functions.skills import canonical_skills
from jobmart.functions.text import strip

UNKNOWN = "không rõ"

TEMPLATE = """Read the IT job advert below and answer with one JSON object and nothing else.

Title: {title}
Specialisation tags: {tags_specialization}
salary_type: {salary_type} | min_salary: {min_salary} | max_salary: {max_salary}
exp_min: {exp_min} | exp_type: {exp_type}
is_it_preliminary: {is_it_preliminary}
location_raw: {location_raw}
Description: {description}
Requirements: {requirements}
Benefits: {benefits}

Keys of the object:
- domain: the best fitting one of {domains}
- technical_skills: languages, frameworks, databases, cloud, tools and protocols named in the
  description or the requirements, each in its vendor's spelling; no soft skills, degrees or
  working methods
- exp_max: upper bound of the years of experience, or -1.0
- locations: official province names from location_raw, ["Toàn quốc"] when none is given
- max_salary_verified: for negotiable salaries the amount in million VND named among the
  benefits, or -1
"""


def python_list(c: Column) -> Column:
    """Text of a string list as Python prints it."""
    def quoted(t: Column) -> Column:
        plain = F.replace(t, F.lit("\\"), F.lit("\\\\"))
        double = t.contains("'") & ~t.contains('"')
        return (F.when(t.isNull(), F.lit("None"))
                .when(double, F.concat(F.lit('"'), plain, F.lit('"')))
                .otherwise(F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")),
                                    F.lit("'"))))

    items = F.array_join(F.transform(c, quoted), ", ")
    return F.concat(F.lit("["), F.coalesce(items, F.lit("")), F.lit("]"))


def _or(c: Column, default: str) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def _known(c: Column) -> Column:
    return F.when(c == -1, F.lit(UNKNOWN)).otherwise(F.coalesce(c.cast("string"), F.lit("None")))


def prompt(template: str = TEMPLATE, budget: dict[str, int] | None = None) -> Column:
    """Fill ``template`` from the columns of the clean stage.

    The three long texts enter whole, unless ``budget`` limits the characters of
    "description", "requirements" or "benefits" for a model with a small context.
    """
    size = budget or {}

    def head(name: str, source: str) -> Column:
        text = _or(F.col(source), "")
        return F.substring(text, 1, size[name]) if name in size else text

    values = {
        "title": _or(F.col("title"), ""),
        "tags_specialization": python_list(F.col("tags_specialization")),
        "salary_type": _or(F.col("salary_type"), "unknown"),
        "min_salary": _known(F.col("min_salary")),
        "max_salary": _known(F.col("max_salary")),
        "exp_min": _known(F.col("exp_min").cast("double")),
        "exp_type": _or(F.col("exp_type"), "unknown"),
        "is_it_preliminary": _or(F.col("is_it_preliminary"), "none"),
        "location_raw": _or(F.col("location_raw"), ""),
        "description": head("description", "mo_ta_text"),
        "requirements": head("requirements", "yeu_cau_text"),
        "benefits": head("benefits", "quyen_loi_text"),
        "domains": F.lit(" | ".join(vocab.MODEL_DOMAINS)),
    }
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[values[p] if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def decode_reply(reply: Column, verdict: Column) -> Column:
    """Model reply to ``struct<domain, technical_skills, is_it_job, exp_max, locations,
    max_salary_verified>``.

    Accepts a fenced code block with or without a language tag. Anything unreadable, as a whole
    or per field, becomes the default. Skills get their canonical names.
    """
    raw = strip(reply)
    fenced = F.get(F.split(raw, "```"), F.lit(1))
    body = F.when(raw.startswith("```"), F.regexp_replace(fenced, r"\Ajson", "")).otherwise(raw)
    r = F.from_json(strip(body), schemas.REPLY)
    none = F.array().cast("array<string>")
    domain = F.coalesce(r["domain"], F.lit(vocab.OTHER_DOMAIN))
    salary = r["max_salary_verified"].try_cast("double").try_cast("int")
    return F.struct(
        domain.alias("domain"),
        F.coalesce(canonical_skills(r["technical_skills"]), none).alias("technical_skills"),
        it_decision(verdict, domain).alias("is_it_job"),
        F.coalesce(r["exp_max"].try_cast("float"), F.lit(-1.0).cast("float")).alias("exp_max"),
        F.coalesce(r["locations"], none).alias("locations"),
        F.coalesce(F.nullif(salary, F.lit(0)), F.lit(-1)).alias("max_salary_verified"),
    )
