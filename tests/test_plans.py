"""Shape of the physical plans."""

from __future__ import annotations

import re

import pytest

from checks.inputs import order_jobs, part_jobs, postings
from checks.queries import QUERIES
from jobmart.operators import marts
from jobmart.plans import rules
from jobmart.plans.clean import clean

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", [
    "mart_skill_demand", "mart_location_trend", "mart_salary_benchmark", "clean_html",
    "unescape_entities", "page_listing", "page_detail", "salary_clean", "salary_rules",
    "experience_rules", "deadline", "requirement_tags", "city", "domains", "skills",
    "clean_stage", "prompt_text", "reply_decode", "rules_flow", "dedup_batch", "quality_rules"])
def test_no_python_in_native_queries(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "EvalPython" not in text and "InPandas" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_row_level_stages_do_not_shuffle(spark):
    for df in (clean(postings(spark, SF)), rules.process(postings(spark, SF))):
        assert "Exchange" not in plan(df)


def test_text_is_matched_once_despite_the_it_filter(spark):
    text = plan(rules.process(postings(spark, SF)))
    assert len(re.findall(r"explode\(array\(array_sort", text)) == 1
    conditions = [line for line in text.splitlines() if line.startswith("Condition")]
    assert conditions and not any("regexp" in c for c in conditions)


def test_marts_read_only_their_columns(spark):
    text = plan(marts.skill_demand(part_jobs(spark, SF)))
    schemas = re.findall(r"ReadSchema: (.*)", text)
    assert schemas and all("p_type" not in s and "p_brand" not in s for s in schemas)
    assert "struct<>" in schemas            # the total needs no column at all


def test_skill_counts_combine_before_the_shuffle(spark):
    text = plan(marts.skill_demand(part_jobs(spark, SF)))
    assert "partial_count" in text and "partial_avg" in text
    assert "Join" not in text               # counts and salaries come from one aggregate


def test_copies_merge_before_the_dedup_shuffle(spark):
    text = plan(QUERIES["dedup_batch"](spark, SF))
    assert "partial_min_by" in text and "Window" not in text


def test_rank_is_limited_before_the_shuffle(spark):
    text = plan(marts.top_skills_per_city(order_jobs(spark, SF)))
    assert text.count("WindowGroupLimit") >= 2


def test_top_skills_is_a_bounded_sort(spark):
    mart = marts.skill_demand(part_jobs(spark, SF))
    assert "TakeOrderedAndProject" in plan(marts.top_skills(mart))
