"""Time the headline queries once each and print one JSON line.

``BENCH_SF_DIR`` (default sf0.1) names the tables, ``BENCH_CPUS`` the local cores,
``BENCH_QUERIES`` an optional comma-separated choice.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES

HEADLINE = [
    "mart_skill_demand", "mart_salary_benchmark", "mart_location_trend", "clean_html",
    "salary_clean", "salary_rules", "experience_rules", "requirement_tags", "city", "domains",
    "skills", "clean_stage", "prompt_text", "rules_flow", "quality_clean", "quality_rules",
    "page_listing", "page_detail", "dedup_batch", "dedup_stream", "stream_ingest",
    "enrich_flow", "partition_overwrite",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["mart_skill_demand"](spark, sf).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names.split(",") if names else HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
