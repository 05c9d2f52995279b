"""Native columns against scalar Python UDFs for the costly row-level steps.

``python -m checks.udf_baseline [sf_dir]`` prints seconds per step. The UDFs do the same work in
the usual row-at-a-time way: one compiled regex per keyword, per-row Python.
"""

from __future__ import annotations

import html
import re
import sys
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobmart import vocab
from jobmart.functions import labels, text
from jobmart.functions.matching import WORD
from jobmart.functions.salary import with_rules_salary
from checks import fixtures as X
from checks.inputs import pick

WORDS = [(re.escape(w), d) for d, ws in vocab.DOMAINS.items() for w in ws]


def domain_udf():
    bounded = [(f"(?<![{WORD}]){w}(?![{WORD}])", d) for w, d in WORDS]

    def find(t: str) -> list[str]:
        t = t.lower()
        return sorted({d for w, d in bounded if re.search(w, t)}) or ["Other"]

    re._MAXCACHE = 4096
    return F.udf(find, "array<string>")


def skill_udf():
    per_domain = {d: f"(?i)(?<![{WORD}])(" + "|".join(
        re.escape(s) for s in sorted(ss, key=len, reverse=True)) + f")(?![{WORD}])"
        for d, ss in vocab.SKILLS.items()}
    name = {s.lower(): s for ss in vocab.SKILLS.values() for s in ss}
    return F.udf(lambda ds, t: sorted({name[m.lower()] for d in ds if d in per_domain
                                       for m in re.findall(per_domain[d], t)}), "array<string>")


def html_udf():
    steps = [("<li[^>]*>", "\n• "), (r"<p[^>]*>|<br\s*/?>|</[uo]l>", "\n"), ("<[^>]+>", "")]

    def clean(t: str) -> str:
        for pattern, new in steps:
            t = re.sub(pattern, new, t)
        kept: list[str] = []
        for line in map(str.strip, html.unescape(t).splitlines()):
            if line or not kept or kept[-1]:
                kept.append(line)
        return "\n".join(kept).strip()

    return F.udf(clean, "string")


def salary_udf():
    def parse(t: str | None) -> list[float] | None:
        found = [float(n) for n in re.findall(r"\d+(?:\.\d+)?", (t or "").replace(",", ""))]
        return [min(found[:2]), max(found[:2])] if found else None

    return F.udf(parse, "array<double>")


def seconds(df: DataFrame) -> float:
    best = float("inf")
    for _ in range(3):
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return round(best, 2)


def main(sf: str) -> None:
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "12g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs = docs.repartition(8).cache()
    copies = F.explode(F.sequence(F.lit(1), F.lit(10)))
    pages = (spark.read.parquet(f"{sf}/pages.parquet").select("html", copies.alias("copy"))
             .repartition(8).cache())
    short = spark.range(400_000).repartition(8).select(
        pick([r[0] for r in X.SALARY_RULES], by="id").alias("salary")).cache()
    tagged = labels.with_domains(docs.limit(10**9), "text").cache()
    sizes = docs.count(), pages.count(), short.count(), tagged.count()
    print("rows: documents %d, pages %d, salaries %d" % sizes[:3])
    pairs = {
        "html to text": (pages.select(text.html_to_text(F.col("html"))),
                         pages.select(html_udf()("html"))),
        "domains": (labels.with_domains(docs, "text").select("domain"),
                    docs.select(domain_udf()("text"))),
        "skills": (tagged.select(labels.skills(F.col("text"), F.col("domain"))),
                   tagged.select(skill_udf()("domain", "text"))),
        "salary (UDF: numbers only)": (with_rules_salary(short).drop("salary"),
                                       short.select(salary_udf()("salary"))),
    }
    for name, (native, udf) in pairs.items():
        print(f"{name:28s} native {seconds(native):7.2f}s   udf {seconds(udf):7.2f}s", flush=True)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
