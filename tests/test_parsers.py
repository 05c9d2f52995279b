"""Hand-traced values of every row-level rule."""

from __future__ import annotations

import datetime
import html
import random

import pytest
from pyspark.sql import functions as F

from checks import fixtures as X
from jobmart.functions import fields, labels, text
from jobmart.functions.experience import with_clean_experience, with_rules_experience
from jobmart.functions.prompt import decode_reply, python_list
from jobmart.functions.salary import with_clean_salary, with_rules_salary
from jobmart.functions.skills import canonical_skill, canonical_skills


def run(spark, rows, schema, transform, columns):
    """Rows of ``columns`` in input order."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
    return [tuple(r[c] for c in columns)
            for r in df.transform(transform).orderBy("i").select("i", *columns).collect()]


def column(spark, rows, schema, build):
    return [r[0] for r in run(spark, rows, schema, lambda d: d.withColumn("o", build()), ["o"])]


def near(rows):
    return [tuple(pytest.approx(v, abs=1e-5) if isinstance(v, float) else v for v in r)
            for r in rows]


def firsts(table):
    return [(r[0],) for r in table]


def test_clean_salary(spark):
    got = run(spark, firsts(X.SALARY_CLEAN), "salary string", with_clean_salary,
              ["min_salary", "max_salary", "salary_currency", "salary_type"])
    assert got == [r[1:] for r in X.SALARY_CLEAN]


def test_clean_salary_full_width_digits_and_order(spark):
    got = run(spark, [("１０ - ２０ triệu",), ("30 - 10 triệu",), ("$500-$700",), ("  ",)],
              "salary string", with_clean_salary,
              ["min_salary", "max_salary", "salary_currency", "salary_type"])
    assert got == [(10, 20, "VND", "range"), (30, 10, "VND", "range"), (13, 19, "USD", "range"),
                   (-1, -1, "VND", "negotiable")]


def test_rules_salary(spark):
    got = run(spark, firsts(X.SALARY_RULES), "salary string", with_rules_salary,
              ["min_salary", "max_salary", "currency"])
    assert got == near([r[1:] for r in X.SALARY_RULES])


def test_rules_salary_is_ordered(spark):
    rng = random.Random(1)
    rows = [(f"{rng.randint(0, 9999)}{rng.choice(['', 'k', '.5'])} {rng.choice('-–')} "
             f"{rng.randint(0, 99999)} {rng.choice(['usd', 'yen', 'eur', 'triệu', 'man', ''])}",)
            for _ in range(300)]
    for low, high in run(spark, rows, "salary string", with_rules_salary,
                         ["min_salary", "max_salary"]):
        assert (low is None) == (high is None)
        assert low is None or low <= high <= 500


def test_clean_experience(spark):
    got = run(spark, firsts(X.EXPERIENCE), "experience string", with_clean_experience,
              ["exp_min", "exp_type"])
    assert got == [r[1:3] for r in X.EXPERIENCE]


def test_rules_experience(spark):
    got = run(spark, firsts(X.EXPERIENCE), "experience string", with_rules_experience,
              ["years_of_experience"])
    assert got == near([(r[3],) for r in X.EXPERIENCE])


def test_deadline(spark):
    got = run(spark, firsts(X.DEADLINE), "deadline string", fields.with_deadline,
              ["deadline_date"])
    assert got == [(r[1] and datetime.date.fromisoformat(r[1]),) for r in X.DEADLINE]


def test_requirement_tags(spark):
    got = run(spark, firsts(X.REQUIREMENT_TAGS), "tags_requirement array<string>",
              fields.with_requirement_tags,
              ["edu_level", "gender", "age_min", "age_max", "req_languages"])
    assert got == [r[1:] for r in X.REQUIREMENT_TAGS]


def test_requirement_tags_ignore_null_elements(spark):
    got = run(spark, [([None, "Nam", None],)], "tags_requirement array<string>",
              fields.with_requirement_tags, ["gender", "age_min"])
    assert got == [("Nam", -1)]


@pytest.mark.parametrize("table, schema, build, at", [
    (X.LOCATION_MARKER, "s string", lambda: text.strip_location_marker(F.col("s")), 1),
    (X.IT_VERDICT, "s array<string>", lambda: fields.it_verdict(F.col("s")), 1),
    (X.CITY, "s string", lambda: labels.city(F.col("s")), 1),
    (X.ALIASES, "s string", lambda: canonical_skill(F.col("s")), 1),
    (X.HTML_TEXT, "s string", lambda: text.html_to_text(F.col("s")), 1),
], ids=["location", "it", "city", "alias", "html"])
def test_single_columns(spark, table, schema, build, at):
    assert column(spark, firsts(table), schema, build) == [r[at] for r in table]


def test_mart_city(spark):
    rows = [r for r in X.CITY if r[2]]
    assert column(spark, firsts(rows), "s string", lambda: labels.mart_city(F.col("s"))) == [
        r[2] for r in rows]


def test_levels(spark):
    rules = column(spark, [r[:2] for r in X.LEVEL_RULES], "t string, e string",
                   lambda: labels.rules_level(F.col("t"), F.col("e")))
    assert rules == [r[2] for r in X.LEVEL_RULES]
    title = column(spark, [r[:2] for r in X.LEVEL_TITLE], "t string, e float",
                   lambda: labels.title_level(F.col("t"), F.col("e")))
    assert title == [r[2] for r in X.LEVEL_TITLE]


def test_domains_and_it_flag(spark):
    def transform(df):
        pooled = df.withColumn("x", labels.pooled_text(F.col("t"), [], [F.col("h")]))
        found = labels.with_domains(pooled, "x")
        return found.withColumn("is_it", fields.is_it_domain(F.col("domain")))

    got = run(spark, [r[:2] for r in X.DOMAINS], "t string, h string", transform,
              ["domain", "is_it"])
    assert got == [r[2:] for r in X.DOMAINS]
    assert all(is_it == (domain != ["Other"]) for domain, is_it in got)


def test_skills(spark):
    got = column(spark, [r[:2] for r in X.SKILLS], "d array<string>, t string",
                 lambda: labels.skills(F.col("t"), F.col("d")))
    assert got == [r[2] for r in X.SKILLS]


def test_skill_dictionary_is_a_parameter(spark):
    mine = {"Bridge": ["JLPT", "Japanese N1", "N1"]}
    got = column(spark, [(["Bridge"], "Japanese n1, jlpt; N1")], "d array<string>, t string",
                 lambda: labels.skills(F.col("t"), F.col("d"), mine))
    assert got == [["JLPT", "Japanese N1", "N1"]]


def test_canonical_skill_lists_are_distinct(spark):
    got = column(spark, [(["reactjs", "React.js", "react", "Foo"],), (None,)], "s array<string>",
                 lambda: canonical_skills(F.col("s")))
    assert got == [["React", "Foo"], None]


def test_reply(spark):
    def transform(df):
        return df.withColumn("r", decode_reply(F.col("s"), F.col("v"))).select("i", "r.*")

    got = run(spark, [r[:2] for r in X.REPLIES], "s string, v string", transform,
              ["domain", "technical_skills", "is_it_job", "exp_max", "locations",
               "max_salary_verified"])
    assert got == [r[2:] for r in X.REPLIES]


@pytest.mark.parametrize("reply", ["[]", "5", "null", "", None, '{"domain": 3, "exp_max": {}}',
                                   '{"technical_skills": "x", "locations": 1}', "```", "```json"])
def test_odd_replies_fall_back(spark, reply):
    def transform(df):
        return df.withColumn("r", decode_reply(F.col("s"), F.lit("none"))).select("i", "r.*")

    (got,) = run(spark, [(reply,)], "s string", transform,
                 ["technical_skills", "exp_max", "locations", "max_salary_verified"])
    assert got == ([], -1.0, [], -1)


def test_list_is_printed_like_python(spark):
    values = [[], ["a"], ["it's", 'say "x"'], ["both ' and \""], ["back\\slash"]]
    got = column(spark, [(v,) for v in values] + [(None,)], "s array<string>",
                 lambda: python_list(F.col("s")))
    assert got == [str(v) for v in values] + ["[]"]


# --- HTML against the standard library --------------------------------------------------------

PIECES = ["<li>", '<p class="x">', "<br/>", "<br >", "</ul>", "</ol>", "<b>", "</p>", "<link>",
          "&amp;", "&lt;", "&nbsp;", "&#233;", "&#x1F600;", "&#0;", "&#128;", "&notit;", "&amp",
          "&copy2", "&;", "&", "&#xD800;", "&#99999999999;", "&#x00041", "&NotEqualTilde;",
          "&unknown;", "&#xFFFE;", "&#11;", "&eacute", "&#", "&#x;", "\n", "\r\n", "\r", "\v", " ",
          "\t", "\x1c", "\x1f", "\x85", "\xa0", "\u2028", "\u3000", "\n\n", "abc", "Đức", "x"]


def random_texts(n, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(1, 40))) for _ in range(n)]


def test_unescape_matches_the_standard_library(spark):
    texts = random_texts(1500)
    got = column(spark, [(t,) for t in texts], "s string", lambda: text.unescape(F.col("s")))
    assert got == [html.unescape(t) for t in texts]


def test_strip_matches_python(spark):
    texts = random_texts(500, seed=8)
    got = column(spark, [(t,) for t in texts], "s string", lambda: text.strip(F.col("s")))
    assert got == [t.strip() for t in texts]


def test_lines_are_tidied(spark):
    texts = [html.unescape(t).replace("<", "(").replace(">", ")").replace("&", "+")
             for t in random_texts(1500, seed=9)]

    def tidy(t):
        lines = [line.strip() for line in t.splitlines()]
        kept = [line for i, line in enumerate(lines) if line or i == 0 or lines[i - 1]]
        return "\n".join(kept).strip()

    got = column(spark, [(t,) for t in texts], "s string", lambda: text.html_to_text(F.col("s")))
    assert got == [tidy(t) for t in texts]


def test_both_ways_of_removing_tags_agree(spark):
    rng = random.Random(11)
    odd = PIECES + ["<", ">", "<>", "< >", "<li", "<p", "<br\xa0>", "<br/", "</ul", "<Li>"]
    texts = random_texts(500, seed=10) + [
        "".join(rng.choices(odd, k=rng.randint(1, 12))) for _ in range(1500)]
    fast = column(spark, [(t,) for t in texts], "s string", lambda: text.tags_to_lines(F.col("s")))
    slow = column(spark, [(t,) for t in texts], "s string",
                  lambda: text.tags_by_pattern(F.col("s")))
    assert fast == slow


def test_escaped_tags_survive_and_real_ones_do_not(spark):
    got = column(spark, [("<div>a</div>&lt;i&gt;b<pre>c</pre>",)], "s string",
                 lambda: text.html_to_text(F.col("s")))
    assert got == ["a<i>b\nc"]


def test_closed_references_only(spark):
    raw = ["a&amp", "a&ampp{", "&copy &copy; &#233 &#233;&#xe9", "&amp;lt; &lt;b&gt;", "&nope; &notit;"]
    got = column(spark, [(t,) for t in raw], "s string", lambda: text.unescape(F.col("s"), unclosed=False))
    assert got == ["a&amp", "a&ampp{", "&copy © &#233 é&#xe9", "&lt; <b>", "&nope; &notit;"]


def test_cut_references_in_pages_as_in_the_sql(spark, tmp_path):
    import duckdb
    from checks.oracles import ORACLES
    from checks.queries import QUERIES

    head = ["Rock &amp; Roll &am", "Rock&amp", "a&&&amp", "a &amp; b", "x = &quot;7&quot;"]
    rows = [(i, f"<title>{h}</title><style>p</style><h1>{h}</h1>{'x' * j}") for i, (h, j) in enumerate((h, j) for h in head for j in range(5))]
    df = spark.createDataFrame(rows, "page_id int, html string")
    df.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    for name in ("clean_html", "page_title"):
        got = sorted(tuple(r) for r in QUERIES[name](spark, str(tmp_path)).collect())
        assert got == sorted(db.execute(ORACLES[name]).fetchall())
