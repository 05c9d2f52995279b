"""Adverts and crawled pages derived from the test tables. Every row of a table takes part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from checks import fixtures as X
from jobmart.functions.text import constant

# Long enough to count as content on its own.
LEAD = "Chúng tôi đang tìm một đồng nghiệp cho nhóm sản phẩm tại văn phòng. "

TITLES = [
    "Senior Data Engineer (Python, Kafka, SQL)", "IT BA / Scrum Master - Jira, UML",
    "Kế toán trưởng", "Backend Java / Spring Boot, C# .NET, REST API", "UI/UX Designer",
    "Lập trình nhúng C và C++, ESP32", "AI Scientist R&D python", "Product Manager",
    "Tester - Selenium, Unit Test", "Fullstack React Vue Nodejs", None,
    "Fresher Mobile Developer Android Studio, Kotlin", "DevOps: Docker, CI/CD, GitLab CI",
]
SPECIALIZATIONS = [["Backend Developer"], ["Sales"], None, [" data engineer ", "Foo"], []]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pick(values: list, kind: str = "string", by: str = "doc_id") -> Column:
    """The value at position ``by`` modulo the length of ``values``."""
    return F.get(constant(values, f"array<{kind}>"),
                 (F.col(by) % F.lit(len(values))).cast("int"))


def postings(spark: SparkSession, sf: str) -> DataFrame:
    """One advert per document with its whole text, in the schema of the raw stage."""
    body = F.concat(F.lit(f'<p class="devops">{LEAD}</p><div>'), F.col("text"), F.lit("</div>"))
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("job_id"),
        pick(TITLES).alias("title"),
        F.concat(F.lit(" Công ty \t "), "source", F.lit("  ")).alias("company"),
        F.concat(F.lit("https://host/viec-lam/"), "doc_id", F.lit(".html")).alias("url"),
        pick([r[0] for r in X.SALARY_CLEAN]).alias("salary"),
        pick([r[0] for r in X.CITY]).alias("location"),
        pick([r[0] for r in X.EXPERIENCE]).alias("experience"),
        pick([["x"], [], None], "array<string>").alias("tags"),
        pick([r[0] for r in X.REQUIREMENT_TAGS], "array<string>").alias("tags_requirement"),
        pick(SPECIALIZATIONS, "array<string>").alias("tags_specialization"),
        body.alias("mo_ta_cong_viec_html"),
        F.lit("").alias("yeu_cau_ung_vien_html"),
        F.lit("<ul><li>Lương tháng 13</li></ul>").alias("quyen_loi_html"),
        pick([r[0] for r in X.DEADLINE]).alias("deadline"),
    )


def varied(spark: SparkSession, sf: str) -> DataFrame:
    """One advert per document whose texts are in the description, the requirements, both, short or
    missing, by ``doc_id % 7``; some have no id. All other fields are computed from the document."""
    k, whole = F.col("doc_id") % 7, escaped("text")
    lang, source = F.col("lang"), F.col("source")
    job_id = F.when(F.col("doc_id") % 14 != 6, F.col("doc_id").cast("string"))
    description = (F.when(k.isin(0, 4, 6), F.concat(F.lit("<div>"), whole, F.lit("</div>")))
                   .when(k == 2, "").when(k == 3, F.concat(F.lit("<p>"), lang, F.lit("</p>")))
                   .when(k == 5, F.repeat(lang, F.lit(25))))
    requirements = (F.when(k.isin(1, 6), F.concat(F.lit("<ul><li>"), whole, F.lit("</li></ul>")))
                    .when(k == 0, "").when(k == 3, F.concat(F.lit("<p>"), source, F.lit("</p>")))
                    .when(k == 4, F.concat(F.lit("<p>"), F.repeat(lang, F.lit(26)), F.lit("</p>"))))
    n = F.col("n_chars") % 100 + 1
    day = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    return table(spark, sf, "documents").select(
        job_id.alias("job_id"), F.concat(F.lit("Senior "), lang, F.lit(" "), source).alias("title"),
        F.concat(F.lit("  "), source, F.lit(" \t "), lang).alias("company"),
        F.concat(F.lit("https://host/"), "doc_id", F.lit("?x="), lang).alias("url"),
        F.concat(n, F.lit(" - "), n + 5, F.lit(" triệu")).alias("salary"),
        F.concat(source, F.lit(" ")).alias("location"),
        F.when(F.col("doc_id") % 3 == 0, F.concat(n % 9, F.lit(" năm"))).alias("experience"),
        F.array(lang, source).alias("tags"), F.array(F.lit("Nam"), lang).alias("tags_requirement"),
        F.when(F.col("doc_id") % 4 == 1, F.array(F.lit("Sales")))
        .when(F.col("doc_id") % 4 == 2, F.array(F.lit("Backend Developer"))).alias("tags_specialization"),
        description.alias("mo_ta_cong_viec_html"), requirements.alias("yeu_cau_ung_vien_html"),
        F.concat(F.lit("<ul><li>"), lang, F.lit("</li></ul>")).alias("quyen_loi_html"),
        F.date_format(day, "d/M/yyyy").alias("deadline"))


def part_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """Parts in the role of enriched adverts."""
    years = (F.col("p_size") % 10 - 1).cast("float")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("job_id"), F.split("p_name", " ").alias("technical_skills"),
        F.floor("p_retailprice").cast("int").alias("max_salary"),
        F.floor(F.col("p_retailprice") / 2).cast("int").alias("min_salary"),
        years.alias("exp_min"))


def order_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in the role of enriched adverts, placed by the customer's nation."""
    nations = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"),
        pick(["Hà Nội", "Hồ Chí Minh", "TP. Đà Nẵng", "Toàn quốc", "Huế", ""], by="n_nationkey")
        .alias("place"))
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                                    "c_nationkey")
    return (table(spark, sf, "orders").join(customers, "o_custkey").join(nations, "c_nationkey")
            .select(F.col("o_orderkey").alias("job_id"),
                    F.array("place").alias("locations"),
                    F.split("o_orderpriority", "-").alias("technical_skills"),
                    F.floor("o_totalprice").cast("int").alias("max_salary")))


PER_PAGE = 25


def list_pages(spark: SparkSession, sf: str) -> DataFrame:
    """List pages showing every part, ``PER_PAGE`` to a page."""
    key = F.col("p_partkey")
    item = F.concat(
        F.lit('<div data-job-id="'), key, F.lit('" class="box job-item-search-result">'),
        F.lit('<div class="avatar"><a href="/logo?x=1"><img></a></div><h3 class="title">'),
        F.lit('<a target="_blank" href="https://host/viec-lam/'), key, F.lit('.html?ta=list">'),
        F.lit('<span data-original-title=" '), "p_name", F.lit(' &amp; '), "p_brand",
        F.lit(' ">cut...</span></a></h3><a class="company"><span class="company-name"> '),
        "p_brand", F.lit(' </span></a><label class="title-salary">'), "p_size",
        F.lit(' - '), F.col("p_size") + 10,
        F.lit(' triệu</label><label class="address"><span class="city-text">Hà Nội</span>'
              '</label><label class="exp"><span> '), "p_size",
        F.lit(' năm</span></label><div class="tag"><a class="item-tag">'), "p_type",
        F.lit('</a><div><a class="item-tag more">&copy; '), "p_brand",
        F.lit('</a></div></div></div>'))
    numbered = table(spark, sf, "part").select(
        F.floor(key / PER_PAGE).alias("page_id"), F.struct(key, item.alias("html")).alias("item"))
    pages = numbered.groupBy("page_id").agg(F.array_sort(F.collect_list("item")).alias("items"))
    body = F.array_join(F.transform("items", lambda i: i["html"]), "\n")
    return pages.select("page_id", F.concat(
        F.lit('<html><body><div class="list"><div>nav</div>'), body,
        F.lit('</div><label class="exp"><span>footer</span></label></body></html>')).alias("html"))


def escaped(c: str) -> Column:
    out = F.col(c)
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(raw), F.lit(entity))
    return out


def detail_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A detail page per document, with the whole text as description."""
    section = '<div class="job-description__item"><h3>{}</h3>'
    content = '<div class="job-description__item--content">'
    return table(spark, sf, "documents").select(
        F.concat(F.lit("https://host/d/"), "doc_id").alias("url"),
        F.concat(
            F.lit('<body><div class="x" id="box-job-information-detail">'
                  '<div class="job-tags__group"><div class="job-tags__group-name">Yêu cầu</div>'
                  '<a class="item">Nam</a><a class="item"> '), "lang",
            F.lit('</a></div><div class="job-tags__group">'
                  '<div class="job-tags__group-name">Chuyên môn</div><a class="item">'), "source",
            F.lit('</a></div></div>'),
            F.lit(section.format("Mô tả công việc") + content + "<div><div>"), escaped("text"),
            F.lit("</div></div><p>end</p></div></div>"),
            F.lit(section.format("Yêu cầu ứng viên") + content), "lang", F.lit("</div></div>"),
            F.lit('<div class="a job-detail__information-detail--actions-label">Hạn nộp: '),
            F.lit("31/03/2026</div></body>")).alias("html"))


def crawled_lists(spark: SparkSession, sf: str) -> DataFrame:
    """List pages showing every document, ``PER_PAGE`` to a page; each fifth item lacks its link."""
    link = F.concat(F.lit('<h3 class="title"><a href="https://host/d/'), "doc_id",
                    F.lit('?ta=list" title="'), "source", F.lit(" "), "doc_id", F.lit('">cut</a></h3>'))
    item = F.concat(
        F.lit('<div class="job-item-search-result" data-job-id="'), "doc_id", F.lit('">'),
        F.when(F.col("doc_id") % 5 == 2, "<h3></h3>").otherwise(link),
        F.lit('<a class="company"><span class="company-name">'), "source",
        F.lit('</span></a><label class="title-salary">'), F.col("n_chars"),
        F.lit(' USD</label><div class="tag"><a class="item-tag">'), "lang", F.lit("</a></div></div>"))
    return table(spark, sf, "documents").groupBy(F.floor(F.col("doc_id") / PER_PAGE).alias("page_id")).agg(
        F.concat(F.lit("<body><div>"), F.array_join(F.collect_list(item), "\n"), F.lit("</div></body>")).alias("html"))


def crawled_details(spark: SparkSession, sf: str) -> DataFrame:
    """Detail pages of three documents in four; some fetched twice, and some of an empty url."""
    k, found = F.regexp_extract("url", r"(\d+)$", 1).cast("long"), detail_pages(spark, sf)
    once = found.where(k % 4 != 1)
    again = found.where(k % 12 == 0).withColumn("url", F.concat("url", F.lit("?again=1")))
    lost = found.where(k % 20 == 7).withColumn("url", F.lit(""))
    return once.unionByName(again).unionByName(lost)
