"""DuckDB statements giving the expected rows of each query.

Parsers are compared with the hand-traced outputs of ``fixtures`` (picked by the same modulo) or
with arithmetic on the columns the text was written from, dictionaries with plain per-keyword
regexes. Rounded averages and shares use whole-number arithmetic, so they are exact.
"""

from __future__ import annotations

import re

from checks import fixtures as X
from checks.inputs import LEAD, PER_PAGE, SPECIALIZATIONS, TITLES
from jobmart import vocab

AS_OF = "2026-03-15"
ORACLES: dict[str, str] = {}


# --- SQL building -----------------------------------------------------------------------------

def q(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).upper()
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, list):
        return q("|".join(v))
    return "'" + v.replace("'", "''") + "'"


def at(values: list, kind: str = "VARCHAR", by: str = "doc_id") -> str:
    items = ", ".join(q(v) for v in values)
    return f"(CAST([{items}] AS {kind}[]))[CAST({by} % {len(values)} AS BIGINT) + 1]"


def column(rows: list, i: int, kind: str = "VARCHAR") -> str:
    return at([r[i] for r in rows], kind)


def single(rows: list, i: int) -> str:
    return f"CAST({column(rows, i, 'FLOAT')} AS DOUBLE)"


def docs(**columns: str) -> str:
    body = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"SELECT CAST(doc_id AS VARCHAR) AS job_id, {body} FROM documents"


def avg1(value: str, where: str = "TRUE") -> str:
    s, n = f"sum({value}) FILTER ({where})", f"count(*) FILTER ({where})"
    return f"CAST((20 * {s} + {n}) // nullif(2 * {n}, 0) AS DOUBLE) / 10"


def share(count: str, total: str) -> str:
    return f"CAST((20000 * {count} + {total}) // (2 * {total}) AS DOUBLE) / 100"


W = r"a-zA-Z0-9\x{00C0}-\x{024F}\x{1E00}-\x{1EFF}"


def word(*words: str) -> str:
    return f"(^|[^{W}])(" + "|".join(re.escape(w) for w in words) + f")([^{W}]|$)"


def has(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, {q(pattern)})"


# --- marts ------------------------------------------------------------------------------------

PART = ("(SELECT p_partkey, p_size, string_split(p_name, ' ') AS words, "
        "CAST(floor(p_retailprice) AS BIGINT) AS hi, CAST(floor(p_retailprice / 2) AS INTEGER) AS lo "
        "FROM part)")
SKILL_MART = f"""
  SELECT skill_name, count(*) AS job_count,
         {share('count(*)', '(SELECT count(*) FROM part)')} AS percentage,
         {avg1('hi', 'hi > 0')} AS avg_salary, '{AS_OF}' AS updated_date
  FROM (SELECT hi, unnest(words) AS skill_name FROM {PART})
  WHERE skill_name <> '' AND length(skill_name) <= 40 GROUP BY skill_name"""
ORACLES["mart_skill_demand"] = SKILL_MART
_LISTED = """(SELECT CAST(floor(p_retailprice) AS BIGINT) AS hi, unnest([string_split(p_name, ' ')[1], p_name,
              p_name || ' ' || p_type || ' ' || p_brand, '', NULL]) AS skill_name FROM part)"""
ORACLES["mart_skill_long"] = f"""
  SELECT skill_name, count(*) AS job_count, {share('count(*)', '(SELECT count(*) FROM part)')} AS percentage,
         {avg1('hi', 'hi > 0')} AS avg_salary, '{AS_OF}' AS updated_date
  FROM {_LISTED} WHERE skill_name <> '' AND length(skill_name) <= 40 GROUP BY skill_name"""
ORACLES["mart_skill_losses"] = f"""
  SELECT 'listed' AS metric, count(*) AS value FROM {_LISTED}
  UNION ALL SELECT 'blank', count(*) FROM {_LISTED} WHERE coalesce(skill_name, '') = ''
  UNION ALL SELECT 'too_long', count(*) FROM {_LISTED} WHERE length(skill_name) > 40"""
ORACLES["mart_skill_sorted"] = f"SELECT skill_name, job_count FROM ({SKILL_MART}) ORDER BY 1"
ORACLES["mart_skill_top10"] = f"""
  SELECT skill_name, job_count FROM ({SKILL_MART}) ORDER BY job_count DESC, skill_name LIMIT 10"""


def band(years: str) -> str:
    return (f"CASE WHEN {years} IS NULL OR {years} < 0 THEN 'Unknown' WHEN {years} >= 7 THEN "
            f"'Senior' WHEN {years} >= 3 THEN 'Middle' ELSE 'Junior' END")


PART_LEVEL = band("(p_size % 10 - 1)")
ORACLES["mart_salary_benchmark"] = f"""
  SELECT {PART_LEVEL} AS job_level, count(*) AS job_count, {avg1('hi')} AS avg_salary,
         CAST(min(lo) AS DOUBLE) AS min_salary, CAST(max(hi) AS DOUBLE) AS max_salary,
         {avg1('(p_size % 10 - 1)')} AS years_of_experience, '{AS_OF}' AS updated_date
  FROM {PART} WHERE lo > 0 AND hi > 0 AND {PART_LEVEL} <> 'Unknown' GROUP BY 1"""
ORACLES["level_distribution"] = f"""
  SELECT {PART_LEVEL} AS job_level, count(*) AS cnt FROM part GROUP BY 1"""

PLACES = ["Hà Nội", "Hồ Chí Minh", "TP. Đà Nẵng", "Toàn quốc", "Huế", ""]
BUCKETS = ["Hà Nội", "Hồ Chí Minh", "Đà Nẵng", "Toàn quốc", "Khác", ""]
ORACLES["mart_location_trend"] = f"""
  WITH jobs AS (
    SELECT {at(BUCKETS, by='n_nationkey')} AS city, CAST(floor(o_totalprice) AS BIGINT) AS hi,
           string_split(o_orderpriority, '-') AS skills
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
  placed AS (SELECT * FROM jobs WHERE city <> ''),
  pairs AS (SELECT city, skill, count(*) AS cnt
            FROM (SELECT city, unnest(skills) AS skill FROM placed)
            WHERE length(skill) <= 40 GROUP BY 1, 2),
  ranked AS (SELECT *, rank() OVER (PARTITION BY city ORDER BY cnt DESC) AS rnk FROM pairs),
  top AS (SELECT city, string_agg(skill, ', ' ORDER BY cnt DESC, skill) AS top_skills
          FROM ranked WHERE rnk <= 5 GROUP BY city),
  totals AS (SELECT city, count(*) AS job_count,
                    {share('count(*)', '(SELECT count(*) FROM jobs)')} AS percentage,
                    {avg1('hi', 'hi > 0')} AS avg_salary FROM placed GROUP BY city)
  SELECT totals.*, top_skills, '{AS_OF}' AS updated_date FROM totals LEFT JOIN top USING (city)"""
ORACLES["mart_city_skills"] = f"""
  WITH pairs AS (
    SELECT {at(BUCKETS, by='n_nationkey')} AS city, unnest(string_split(o_orderpriority, '-')) AS skill
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
  ranked AS (SELECT city, skill, count(*) AS cnt, CAST(rank() OVER (PARTITION BY city ORDER BY count(*) DESC) AS INTEGER) AS rnk
             FROM pairs WHERE city <> '' AND length(skill) <= 40 GROUP BY 1, 2)
  SELECT * FROM ranked WHERE rnk <= 5"""
_PLACED = [r for r in X.CITY if r[2]]
ORACLES["location_bucket"] = docs(city=column(_PLACED, 2))


# --- text -------------------------------------------------------------------------------------

def chain(text: str, *steps: tuple[str, str]) -> str:
    for pattern, new in steps:
        text = f"regexp_replace({text}, {q(pattern)}, {q(new)}, 'g')"
    return text


_TAGLESS = chain("html", ("<li[^>]*>", "\n• "), ("<p[^>]*>", "\n"), (r"<br\s*/?>", "\n"),
                 ("</ul>|</ol>", "\n"), ("<[^>]+>", ""))
for _name, _char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"),
                     ("amp", "&")):
    _TAGLESS = f"replace({_TAGLESS}, '&{_name};', {q(_char)})"
CLEAN_TEXT = chain(_TAGLESS, (r"[ \t]*\n[ \t]*", "\n"), (r"\n{3,}", "\n\n"), (r"^\s+|\s+$", ""))
ORACLES["clean_html"] = f"SELECT page_id, {CLEAN_TEXT} AS text FROM pages"
ORACLES["strip_tags"] = f"SELECT page_id, {chain('html', ('<[^>]+>', ' '))} AS text FROM pages"
ORACLES["has_content"] = f"SELECT page_id, length({CLEAN_TEXT}) > 50 AS has_content FROM pages"
ORACLES["unescape_entities"] = docs(
    text="chr(CAST(doc_id % 500 + 192 AS INTEGER)) || chr(CAST(doc_id % 500 + 192 AS INTEGER)) "
         "|| '©¬it; ' || text")
ORACLES["company_norm"] = "SELECT c_custkey, c_name || ' ' || c_mktsegment AS company FROM customer"
ORACLES["page_url"] = "SELECT page_id, string_split(url, '?')[1] AS url FROM pages"


# --- crawled pages ----------------------------------------------------------------------------

ORACLES["page_listing"] = f"""
  SELECT CAST(p_partkey // {PER_PAGE} AS BIGINT) AS page_id,
         CAST(row_number() OVER (PARTITION BY p_partkey // {PER_PAGE} ORDER BY p_partkey) - 1
              AS INTEGER) AS position,
         CAST(p_partkey AS VARCHAR) AS job_id, p_name || ' & ' || p_brand AS title,
         'https://host/viec-lam/' || p_partkey || '.html' AS url, p_brand AS company,
         p_size || ' - ' || (p_size + 10) || ' triệu' AS salary, 'Hà Nội' AS location,
         p_size || ' năm' AS experience, p_type || '|© ' || p_brand AS tags FROM part"""
_SECTION = '<div class="job-description__item--content">'
ORACLES["page_detail"] = f"""
  SELECT 'https://host/d/' || doc_id AS url, 'Nam|' || lang AS tags_requirement,
         source AS tags_specialization,
         '{_SECTION}<div><div>' || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'),
         '>', '&gt;') || '</div></div><p>end</p></div>' AS mo_ta_cong_viec_html,
         '{_SECTION}' || lang || '</div>' AS yeu_cau_ung_vien_html, '' AS quyen_loi_html,
         'Hạn nộp: 31/03/2026' AS deadline FROM documents"""
ORACLES["page_title"] = """
  SELECT page_id, trim(replace(regexp_extract(html, '<title>(.*?)</title>', 1), '&amp;', '&'))
         AS title FROM pages"""
ORACLES["page_merge"] = """
  WITH p AS (SELECT page_id, string_split(url, '?')[1] AS u, html FROM pages),
  d AS (SELECT u, max(length(html)) AS n FROM p WHERE contains(html, '<br>') GROUP BY u)
  SELECT CAST(page_id AS VARCHAR) AS job_id, u AS url, CAST(coalesce(n, -1) AS INTEGER)
         AS html_chars FROM p LEFT JOIN d USING (u)"""

_FOUND = "doc_id % 4 <> 1 AND doc_id % 5 <> 2"
ORACLES["pages_to_postings"] = f"""
  SELECT CAST(doc_id AS VARCHAR) AS job_id, CASE WHEN doc_id % 5 <> 2 THEN source || ' ' || doc_id ELSE '' END AS title,
         source AS company, CASE WHEN doc_id % 5 <> 2 THEN 'https://host/d/' || doc_id ELSE '' END AS url,
         n_chars || ' USD' AS salary, '' AS location, '' AS experience, lang AS tags,
         CASE WHEN {_FOUND} THEN 'Nam|' || lang END AS tags_requirement,
         CASE WHEN {_FOUND} THEN source END AS tags_specialization,
         CASE WHEN {_FOUND} THEN '{_SECTION}<div><div>' || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'),
           '>', '&gt;') || '</div></div><p>end</p></div>' END AS mo_ta_cong_viec_html,
         CASE WHEN {_FOUND} THEN '{_SECTION}' || lang || '</div>' END AS yeu_cau_ung_vien_html,
         CASE WHEN {_FOUND} THEN '' END AS quyen_loi_html,
         CASE WHEN {_FOUND} THEN 'Hạn nộp: 31/03/2026' END AS deadline FROM documents"""


# --- field parsers ----------------------------------------------------------------------------

ORACLES["salary_clean"] = docs(
    min_salary=column(X.SALARY_CLEAN, 1, "INTEGER"), max_salary=column(X.SALARY_CLEAN, 2, "INTEGER"),
    salary_currency=column(X.SALARY_CLEAN, 3), salary_type=column(X.SALARY_CLEAN, 4))
ORACLES["salary_clean_computed"] = """
  WITH p AS (SELECT p_partkey, p_partkey % 5 AS k, p_size AS n, floor(p_retailprice) AS m FROM part)
  SELECT p_partkey,
    CAST(CASE k WHEN 0 THEN n WHEN 1 THEN ceil(m * CAST(0.026 AS DOUBLE)) WHEN 2 THEN ceil(n / 2)
         WHEN 3 THEN ceil(m * 100 * CAST(0.000165 AS DOUBLE)) ELSE -1 END AS INTEGER) AS min_salary,
    CAST(CASE k WHEN 0 THEN n + 10 WHEN 1 THEN ceil(m * 2 * CAST(0.026 AS DOUBLE)) WHEN 2 THEN n
         WHEN 3 THEN ceil(m * 200 * CAST(0.000165 AS DOUBLE)) ELSE -1 END AS INTEGER) AS max_salary,
    CASE k WHEN 1 THEN 'USD' WHEN 3 THEN 'JPY' ELSE 'VND' END AS salary_currency,
    CASE k WHEN 2 THEN 'upper_bound' WHEN 4 THEN 'unknown' ELSE 'range' END AS salary_type FROM p"""
ORACLES["salary_rules"] = docs(
    min_salary=single(X.SALARY_RULES, 1), max_salary=single(X.SALARY_RULES, 2),
    currency=column(X.SALARY_RULES, 3))
ORACLES["salary_rules_computed"] = """
  WITH p AS (SELECT p_partkey, p_partkey % 4 AS k, CAST(p_size AS DOUBLE) AS n,
                    floor(p_retailprice) AS m FROM part),
  v AS (SELECT *,
    CASE k WHEN 0 THEN n WHEN 1 THEN m * 10000 / 1000000 WHEN 2 THEN m * CAST(0.025 AS DOUBLE)
         ELSE n * 1000 * CAST(0.027 AS DOUBLE) END AS a,
    CASE k WHEN 0 THEN n + 9 WHEN 2 THEN m * 30 * CAST(0.025 AS DOUBLE) END AS b FROM p),
  w AS (SELECT *, CASE WHEN a <= 500 AND NOT (k = 3 AND n * 1000 > 50000) THEN a END AS x,
        CASE WHEN b <= 500 AND NOT (k = 2 AND m * 30 > 50000) THEN b END AS y FROM v)
  SELECT p_partkey, CAST(CAST(least(x, y) AS FLOAT) AS DOUBLE) AS min_salary,
         CAST(CAST(greatest(x, y) AS FLOAT) AS DOUBLE) AS max_salary,
         CASE k WHEN 2 THEN 'USD' WHEN 3 THEN 'EUR' ELSE 'VND' END AS currency FROM w"""
ORACLES["experience_clean"] = docs(exp_min=single(X.EXPERIENCE, 1),
                                   exp_type=column(X.EXPERIENCE, 2))
ORACLES["experience_rules"] = docs(years_of_experience=single(X.EXPERIENCE, 3))
ORACLES["experience_computed"] = """
  SELECT p_partkey, CAST(p_size + 2 AS DOUBLE) AS exp_min,
         CAST(p_size + 1 AS DOUBLE) AS years_of_experience FROM part"""
ORACLES["deadline"] = docs(deadline_date=column(X.DEADLINE, 1))
ORACLES["deadline_computed"] = """
  SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN strftime(o_orderdate, '%Y-%m-%d') END
         AS deadline_date FROM orders"""
ORACLES["requirement_tags"] = docs(
    edu_level=column(X.REQUIREMENT_TAGS, 1), gender=column(X.REQUIREMENT_TAGS, 2),
    age_min=column(X.REQUIREMENT_TAGS, 3, "INTEGER"),
    age_max=column(X.REQUIREMENT_TAGS, 4, "INTEGER"), req_languages=column(X.REQUIREMENT_TAGS, 5))
ORACLES["location_marker"] = docs(location_raw=column(X.LOCATION_MARKER, 1))
ORACLES["city"] = docs(city=column(X.CITY, 1))
ORACLES["level_title"] = docs(job_level=column(X.LEVEL_TITLE, 2))
ORACLES["level_rules"] = docs(level=column(X.LEVEL_RULES, 2))
ORACLES["it_verdict"] = docs(is_it_preliminary=column(X.IT_VERDICT, 1))


# Texts computed from columns. Of a keyword itself, the label is worked out here from the dictionaries
# by plain search: for provinces the longest keyword inside it, for levels the first, for domains all.
def inside(word: str, vocabulary: dict) -> list[tuple[str, str]]:
    return [(label, w) for label, w in X.keywords(vocabulary)
            if re.search(rf"(?<![^\W_]){re.escape(w.strip().lower())}(?![^\W_])", word.lower())]


_BY_CITY = [max(inside(w, vocab.LOCATIONS), key=lambda p: len(re.escape(p[1].lower())))[0] for _, w in X.keywords(vocab.LOCATIONS)]
_IN_MARTS = {"TP.HCM": "Hồ Chí Minh", "Remote": "Toàn quốc"}
ORACLES["city_computed"] = docs(city=at(_BY_CITY), mart=at([_IN_MARTS.get(c, c) for c in _BY_CITY]))
_BY_LEVEL = [inside(w, vocab.LEVELS)[0][0] for _, w in X.keywords(vocab.LEVELS)]
ORACLES["level_computed"] = docs(
    by_rules=f"CASE WHEN n_chars % 3 <> 0 THEN {at(_BY_LEVEL)} END", by_years=band("(n_chars % 12 - 2)"))
ORACLES["domains_computed"] = docs(
    domain=at(["|".join(sorted({label for label, _ in inside(w, vocab.DOMAINS)})) for _, w in X.keywords(vocab.DOMAINS)]))
ORACLES["requirement_tags_computed"] = docs(
    gender="CASE WHEN n_chars % 3 = 1 THEN CASE WHEN n_chars % 2 = 0 THEN 'Nam' ELSE 'Nữ' END ELSE 'any' END",
    age_min="CAST(CASE n_chars % 3 WHEN 0 THEN n_chars % 30 + 20 WHEN 1 THEN n_chars % 20 + 18 ELSE -1 END AS INTEGER)",
    age_max="CAST(CASE n_chars % 3 WHEN 1 THEN n_chars % 20 + 30 ELSE -1 END AS INTEGER)",
    req_languages="CASE WHEN n_chars % 3 = 1 THEN 'Tiếng ' || lang ELSE '' END")
_MART_NAMES = [*vocab.MART_CITIES, "Huế", "hà nội"]
ORACLES["location_computed"] = docs(
    city=at([*vocab.MART_CITIES, "Khác", "Khác"], by="n_chars"),
    location_raw=f"source || ' ' || {at(_MART_NAMES, by='n_chars')} || ' ' || lang")
ORACLES["it_verdict_computed"] = docs(
    is_it_preliminary="CASE WHEN n_chars % 5 = 4 THEN 'none' WHEN n_chars % 3 = 0 THEN 'true' WHEN n_chars % 3 = 1 THEN 'false' ELSE 'none' END")
_NAMES_OF = [*vocab.CANONICAL_SKILLS, *[vocab.IRREGULAR_ALIASES[a] for a in vocab.IRREGULAR_ALIASES]]
ORACLES["skill_alias_computed"] = docs(
    skill=f"CASE WHEN n_chars % 4 = 3 THEN trim({at([*vocab.CANONICAL_SKILLS, *vocab.IRREGULAR_ALIASES])}) || ' zz' || n_chars "
          f"ELSE {at(_NAMES_OF)} END")
_DECODED = "n_chars % 4 <> 3"
ORACLES["reply_decode_computed"] = docs(
    domain=f"CASE WHEN {_DECODED} THEN lang || ' \"x\" ' || source ELSE 'Other' END",
    technical_skills=f"CASE WHEN {_DECODED} THEN source || n_chars || '|zz ü' ELSE '' END", is_it_job=_DECODED,
    exp_max=f"CAST(CASE WHEN {_DECODED} THEN n_chars % 9 ELSE -1 END AS DOUBLE)", locations=f"CASE WHEN {_DECODED} THEN lang ELSE '' END",
    max_salary_verified=f"CAST(CASE WHEN {_DECODED} AND n_chars % 4 <> 0 THEN n_chars % 4 * n_chars ELSE -1 END AS INTEGER)")


# --- dictionaries -----------------------------------------------------------------------------

def tag_text(values: list) -> list:
    return [" | ".join(t for t in v if t) or None if v else None for v in values]


_BODY = f"'<p class=\"devops\">{LEAD}</p><div>' || text || '</div>'"
_HTML = _BODY
_DOMAIN_NAMES = sorted(vocab.DOMAINS)
_FLAG = {name: f"d{i}" for i, name in enumerate(_DOMAIN_NAMES)}
_FLAGS = ", ".join(
    has("low", word(*vocab.DOMAINS[n])) + f" AS {_FLAG[n]}" for n in _DOMAIN_NAMES)
_NAMES = ", ".join(f"CASE WHEN {_FLAG[n]} THEN {q(n)} END" for n in _DOMAIN_NAMES)
ADVERTS = f"""
  WITH texts AS (
    SELECT doc_id, source, CAST(doc_id AS VARCHAR) AS job_id,
      concat_ws(' | ', {at(TITLES)}, {at(['x', None, None])},
                {at(tag_text([r[0] for r in X.REQUIREMENT_TAGS]))},
                {at(tag_text(SPECIALIZATIONS))},
                {chain(_HTML, ('<[^>]+>', ' '))}) AS pooled FROM documents),
  flags AS (SELECT *, {_FLAGS} FROM (SELECT *, lower(pooled) AS low FROM texts)),
  adverts AS (SELECT *, coalesce(nullif(concat_ws('|', {_NAMES}), ''), 'Other') AS domain FROM flags)
"""
ORACLES["domains"] = ADVERTS + "SELECT job_id, domain FROM adverts"
ORACLES["is_it"] = ADVERTS + "SELECT job_id, domain <> 'Other' AS is_it FROM adverts"
ORACLES["domain_distribution"] = ADVERTS + """
  SELECT domain, count(*) AS cnt
  FROM (SELECT unnest(string_split(domain, '|')) AS domain FROM adverts) GROUP BY domain"""


def skill_test(name: str) -> str:
    """Found for one of the row's domains, outside longer skills of that same domain."""
    tests = []
    for domain, names in vocab.SKILLS.items():
        if name not in names:
            continue
        longer = [n for n in names if n != name
                  and re.search(rf"(?i)(?<![^\W_]){re.escape(name)}(?![^\W_])", n)]
        text = chain("pooled", *[("(?i)" + re.escape(n), " ") for n in longer])
        tests.append(f"({_FLAG[domain]} AND {has(text, '(?i)' + word(name))})")
    return f"CASE WHEN {' OR '.join(tests)} THEN {q(name)} END"


_SKILLS = ", ".join(skill_test(n) for n in sorted({s for v in vocab.SKILLS.values() for s in v}))
SKILL_LIST = f"concat_ws('|', {_SKILLS})"
ORACLES["skills"] = ADVERTS + f"SELECT job_id, {SKILL_LIST} AS skills FROM adverts"
ORACLES["skill_alias"] = docs(skill=column(X.ALIASES, 1))
for _name in ("domains", "skills", "city", "skill_alias"):
    ORACLES[f"{_name}_by_join"] = ORACLES[_name]
ORACLES["dictionary_of_words"] = f"""
  WITH found AS (SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '[{W}]+')) AS word FROM documents),
  words AS (SELECT DISTINCT doc_id, lang, word FROM found WHERE length(word) >= 8),
  shared AS (SELECT DISTINCT a.doc_id, b.lang FROM words a JOIN (SELECT DISTINCT lang, word FROM words) b USING (word))
  SELECT doc_id, coalesce(langs, '') AS langs FROM documents LEFT JOIN (
    SELECT doc_id, string_agg(lang, '|' ORDER BY lang) AS langs FROM shared GROUP BY doc_id) USING (doc_id)"""


# --- clean, route, enrich ---------------------------------------------------------------------

_CONTENT = "TRUE"
_VERDICT = at(["true", "false", "none", "true", "none"])
_YEARS = column(X.EXPERIENCE, 1, "DOUBLE")
_NULL_SAFE_CITY = at([r[0] or "" for r in X.CITY])
ORACLES["clean_stage"] = docs(
    title=at(TITLES), has_content=_CONTENT, quyen_loi_text="'• Lương tháng 13'",
    min_salary=column(X.SALARY_CLEAN, 1, "INTEGER"), max_salary=column(X.SALARY_CLEAN, 2, "INTEGER"),
    salary_currency=column(X.SALARY_CLEAN, 3), salary_type=column(X.SALARY_CLEAN, 4),
    exp_min=single(X.EXPERIENCE, 1), exp_type=column(X.EXPERIENCE, 2),
    deadline_date=column(X.DEADLINE, 1), location_raw=_NULL_SAFE_CITY,
    edu_level=column(X.REQUIREMENT_TAGS, 1), gender=column(X.REQUIREMENT_TAGS, 2),
    age_min=column(X.REQUIREMENT_TAGS, 3, "INTEGER"),
    age_max=column(X.REQUIREMENT_TAGS, 4, "INTEGER"), req_languages=column(X.REQUIREMENT_TAGS, 5),
    is_it_preliminary=_VERDICT)
ORACLES["route"] = docs(
    route=f"CASE WHEN NOT {_CONTENT} THEN 'no_content' WHEN {_VERDICT} = 'false' THEN 'non_it' "
          "ELSE 'enrich' END")
_SOURCE = f"CASE WHEN {_VERDICT} = 'none' THEN 'llm' ELSE 'rule' END"
ORACLES["provenance"] = docs(classification_source=_SOURCE)
ORACLES["it_override"] = """
  SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE
         ELSE coalesce(toxic, 0) <> 1 END AS is_it_job FROM labels"""
_TAG_LISTS = ["['Backend Developer']", "['Sales']", "[]", "[' data engineer ', 'Foo']", "[]"]


def _known(values: list) -> str:
    return at(["không rõ" if v == -1 else str(v) for v in values])


ORACLES["prompt_text"] = docs(
    prompt=f"'T: ' || coalesce({at(TITLES)}, '') || chr(10) || 'Tags: ' || {at(_TAG_LISTS)} "
           f"|| chr(10) || {column(X.SALARY_CLEAN, 4)} || '|' "
           f"|| {_known([r[1] for r in X.SALARY_CLEAN])} || '|' "
           f"|| {_known([r[2] for r in X.SALARY_CLEAN])} || '|' "
           f"|| {_known([r[1] for r in X.EXPERIENCE])} || '|' || {column(X.EXPERIENCE, 2)} "
           f"|| '|' || {_VERDICT} || '|' || {_NULL_SAFE_CITY} || chr(10) || '• Lương tháng 13'")
ORACLES["reply_decode"] = docs(
    domain=column(X.REPLIES, 2), technical_skills=column(X.REPLIES, 3),
    is_it_job=column(X.REPLIES, 4, "BOOLEAN"), exp_max=column(X.REPLIES, 5, "DOUBLE"),
    locations=column(X.REPLIES, 6), max_salary_verified=column(X.REPLIES, 7, "INTEGER"))

# Adverts of ``inputs.varied``: which texts they have, computed again.
_TIDY = chain("text", (r"[ \t]*\n[ \t]*", "\n"), (r"\n{3,}", "\n\n"), (r"^\s+|\s+$", ""))
VARIED = f"""
  WITH raw AS (SELECT *, doc_id % 7 AS k, {_TIDY} AS tidy, n_chars % 100 + 1 AS n FROM documents),
  varied AS (SELECT *, CAST(doc_id AS VARCHAR) AS job_id,
    CASE WHEN k IN (0, 4, 6) THEN tidy WHEN k = 3 THEN lang WHEN k = 5 THEN repeat(lang, 25) ELSE '' END AS mo_ta_text,
    CASE WHEN k IN (1, 6) THEN trim('• ' || tidy) WHEN k = 3 THEN source WHEN k = 4 THEN repeat(lang, 26) ELSE '' END AS yeu_cau_text,
    CASE doc_id % 4 WHEN 1 THEN 'false' WHEN 2 THEN 'true' ELSE 'none' END AS verdict
    FROM raw WHERE doc_id % 14 <> 6),
  stage AS (SELECT *, length(mo_ta_text) > 50 OR length(yeu_cau_text) > 50 AS has_content FROM varied)
"""
ORACLES["clean_varied"] = VARIED + """
  SELECT job_id, 'Senior ' || lang || ' ' || source AS title, '  ' || source || ' ' || chr(9) || ' ' || lang AS company,
    'https://host/' || doc_id || '?x=' || lang AS url, lang || '|' || source AS tags,
    CASE doc_id % 4 WHEN 1 THEN 'Sales' WHEN 2 THEN 'Backend Developer' END AS tags_specialization,
    mo_ta_text, yeu_cau_text, '• ' || lang AS quyen_loi_text, has_content, n || ' - ' || (n + 5) || ' triệu' AS salary_raw,
    CAST(n AS INTEGER) AS min_salary, CAST(n + 5 AS INTEGER) AS max_salary, 'VND' AS salary_currency, 'range' AS salary_type,
    CAST(CASE WHEN doc_id % 3 = 0 THEN n % 9 ELSE -1 END AS DOUBLE) AS exp_min,
    CASE WHEN doc_id % 3 = 0 THEN 'exact' ELSE 'unknown' END AS exp_type,
    CAST(CAST('2026-01-01' AS DATE) + CAST(doc_id % 365 AS INTEGER) AS VARCHAR) AS deadline_date, source AS location_raw,
    'unknown' AS edu_level, 'Nam' AS gender, -1 AS age_min, -1 AS age_max,
    '' AS req_languages, verdict AS is_it_preliminary FROM stage"""
ORACLES["prompt_varied"] = VARIED + """
  SELECT job_id, 'Senior ' || lang || ' ' || source || '|' || verdict || chr(10) || mo_ta_text || chr(10) || yeu_cau_text
         || chr(10) || '• ' || lang AS prompt FROM stage"""
_VARIED_TESTS = {
    "no_content": "NOT has_content", "salary_unknown": "FALSE", "experience_unknown": "doc_id % 3 <> 0",
    "deadline_missing": "FALSE", "it_true": "verdict = 'true'", "it_false": "verdict = 'false'",
    "it_none": "verdict = 'none'", "to_enrich": "has_content AND verdict <> 'false'"}
ORACLES["route_all"] = VARIED + " UNION ALL ".join(
    f"SELECT {q(m)} AS metric, count(*) FILTER ({t}) AS value FROM stage" for m, t in ({"total": "TRUE"} | _VARIED_TESTS).items()) + """
  UNION ALL SELECT 'null_keys', count(*) FROM documents WHERE doc_id % 14 = 6
  UNION ALL SELECT 'route ' || CASE WHEN NOT has_content THEN 'no_content' WHEN verdict = 'false' THEN 'non_it' ELSE 'enrich' END,
                   count(*) FROM stage GROUP BY 1"""
ORACLES["quality_varied"] = VARIED + " UNION ALL ".join(
    f"SELECT {q(m)} AS metric, count(*) FILTER ({t}) AS value, CAST((2000 * count(*) FILTER ({t}) + count(*)) // (2 * count(*)) AS BIGINT) "
    f"AS per_mille, TRUE AS unlimited, FALSE AS breached FROM stage" for m, t in ({"total": "TRUE"} | _VARIED_TESTS).items())

_TITLE_LEVEL = at(["Senior" if t and "Senior" in t else "Manager" if t and "Manager" in t else None
                   for t in TITLES])
_LEVEL = f"coalesce({_TITLE_LEVEL}, {band(_YEARS)})"


def _answer(t: str | None) -> str:
    t = t or ""
    return "Other" if "Kế toán" in t or "Product" in t else (
        "Backend Developer" if "Java" in t else "DevOps")


_DOMAIN = at([_answer(t) for t in TITLES])
_UNANSWERED = f"({_DOMAIN} = 'Other')"
_JAVA = f"({_DOMAIN} = 'Backend Developer')"
_ENRICHED = docs(
    domain=_DOMAIN, is_it_job="TRUE", job_level=_LEVEL, classification_source=_SOURCE,
    source="'jobs'", technical_skills=f"CASE WHEN {_JAVA} THEN 'Java' ELSE '' END",
    exp_max=f"CAST(CASE WHEN {_JAVA} THEN 5 ELSE -1 END AS DOUBLE)",
    locations=f"CASE WHEN {_JAVA} THEN 'Hà Nội' ELSE '' END", max_salary_verified="-1",
    ingestion_date=f"'{AS_OF}'")
_ASKED = f"({_VERDICT} <> 'false' AND NOT {_UNANSWERED})"
_IS_IT = f"({_VERDICT} = 'true' OR ({_VERDICT} = 'none' AND {_DOMAIN} <> 'Other'))"
ORACLES["enrich_flow"] = f"{_ENRICHED} WHERE {_CONTENT} AND {_IS_IT}"
ORACLES["enrich_incremental"] = ORACLES["enrich_flow"]

ORACLES["enrich_incremental_copies"] = (
    f"SELECT job_id, CAST(1 AS BIGINT) AS answers FROM ({docs(domain=_DOMAIN, asked=_ASKED)}) "
    f"WHERE asked")
ORACLES["enrich_outage"] = " UNION ALL ".join(
    f"SELECT job_id, CAST(1 AS BIGINT) AS answers, '{way}' AS way FROM ({docs(domain=_DOMAIN, asked=_ASKED)}) WHERE asked"
    for way in ("job", "stream"))
ORACLES["enrich_replan"] = ORACLES["enrich_flow"]
_FINAL = ("WITH jobs AS (SELECT * FROM (" + docs(
    domain=_DOMAIN, java=_JAVA, is_it=_IS_IT, level=_LEVEL,
    lo=column(X.SALARY_CLEAN, 1, "INTEGER"), hi=column(X.SALARY_CLEAN, 2, "INTEGER"),
    years=_YEARS) + ") WHERE is_it) ")
ORACLES["enriched_skill_demand"] = _FINAL + f"""
  SELECT 'Java' AS skill_name, count(*) AS job_count,
         {share('count(*)', '(SELECT count(*) FROM jobs)')} AS percentage,
         {avg1('hi', 'hi > 0')} AS avg_salary, '{AS_OF}' AS updated_date
  FROM jobs WHERE java HAVING count(*) > 0"""
ORACLES["enriched_location_trend"] = _FINAL + f"""
  SELECT 'Hà Nội' AS city, count(*) AS job_count,
         {share('count(*)', '(SELECT count(*) FROM jobs)')} AS percentage,
         {avg1('hi', 'hi > 0')} AS avg_salary, 'Java' AS top_skills, '{AS_OF}' AS updated_date
  FROM jobs WHERE java HAVING count(*) > 0"""
ORACLES["enriched_salary_benchmark"] = _FINAL + f"""
  SELECT level AS job_level, count(*) AS job_count, {avg1('hi')} AS avg_salary,
         CAST(min(lo) AS DOUBLE) AS min_salary, CAST(max(hi) AS DOUBLE) AS max_salary,
         round(avg(CAST(trunc(years) AS INTEGER)), 1) AS years_of_experience,
         '{AS_OF}' AS updated_date
  FROM jobs WHERE lo > 0 AND hi > 0 AND level <> 'Unknown' GROUP BY 1"""

_FLAT = f"lower(concat_ws(' | ', {at(TITLES)}, {q(LEAD)} || text))"
_ANY_DOMAIN = has(_FLAT, word(*[w for words in vocab.DOMAINS.values() for w in words]))
# Of each row of X.CITY: all provinces named, in the marts' spelling; no text counts as nationwide.
_PLACES = at(["Toàn quốc", "Hà Nội", "Hồ Chí Minh", "Hà Nội|Hồ Chí Minh", "Hồ Chí Minh", "Hồ Chí Minh",
              "Khác", "Đà Nẵng", "Đồng Nai", "Toàn quốc", "Toàn quốc"])
_FIRST_DOMAIN = "CASE " + " ".join(f"WHEN {has(_FLAT, word(*words))} THEN {q(name)}" for name, words in sorted(vocab.DOMAINS.items())) + " ELSE 'Other' END"
ORACLES["enrich_without_model"] = docs(
    domain=_FIRST_DOMAIN, is_it_job=f"{_VERDICT} = 'true' OR {_ANY_DOMAIN}", job_level=_LEVEL, locations=_PLACES,
) + f" WHERE {_CONTENT} AND {_VERDICT} <> 'false'"


# --- dedup, messages, streams -----------------------------------------------------------------

ORACLES["dedup_batch"] = """
  SELECT user_id AS job_id, event_id, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
  WHERE rn = 1"""
ORACLES["dedup_stored"] = ORACLES["dedup_batch"]
ORACLES["dedup_stream"] = """
  SELECT CAST(event_id AS VARCHAR) AS job_id, event_type AS title FROM events"""
ORACLES["dedup_within"] = "SELECT event_id, event_type FROM events"
ORACLES["postings_read"] = """
  SELECT CASE WHEN doc_id % 14 <> 6 THEN CAST(doc_id AS VARCHAR) END AS job_id, 'Senior ' || lang || ' ' || source AS title,
         lang || '|' || source AS tags, CAST(CASE WHEN doc_id % 7 IN (0, 4, 6) THEN 11 + length(replace(replace(replace(
         text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) WHEN doc_id % 7 = 2 THEN 0 WHEN doc_id % 7 = 3 THEN 7 + length(lang)
         WHEN doc_id % 7 = 5 THEN 25 * length(lang) END AS INTEGER) AS chars, CAST(NULL AS VARCHAR) AS others FROM documents"""
_URL = "'https://host/viec-lam/' || doc_id || '.html'"
ORACLES["stream_ingest"] = (docs(title=at(TITLES), url=_URL)
                            + " UNION ALL SELECT '(none)', NULL, NULL")
_TAGS = at([None if r[0] is None else "|".join(r[0]) for r in X.REQUIREMENT_TAGS])
_SALARY_TEXT = column(X.SALARY_CLEAN, 0)
ORACLES["publish_roundtrip"] = docs(
    title=at(TITLES), company="' Công ty ' || chr(9) || ' ' || source || '  '", url=_URL,
    salary=_SALARY_TEXT, mo_ta_cong_viec_html=_HTML, tags_requirement=_TAGS)
ORACLES["bronze_read"] = docs(title=at(TITLES), salary=_SALARY_TEXT, tags_requirement=_TAGS)


# --- quality ----------------------------------------------------------------------------------

def report(source: str, tests: dict[str, str], extra: str = "") -> str:
    rows = {"total": "TRUE"} | tests
    return " UNION ALL ".join(
        f"SELECT {q(name)} AS metric, count(*) FILTER ({test}) AS value{extra.format(name=name)} "
        f"FROM {source}" for name, test in rows.items())


ORACLES["quality_clean"] = report("documents", {
    "no_content": f"NOT {_CONTENT}",
    "salary_unknown": f"{column(X.SALARY_CLEAN, 1, 'INTEGER')} = -1",
    "experience_unknown": f"{_YEARS} = -1",
    "deadline_missing": f"{column(X.DEADLINE, 1)} IS NULL",
    "it_true": f"{_VERDICT} = 'true'", "it_false": f"{_VERDICT} = 'false'",
    "it_none": f"{_VERDICT} = 'none'", "to_enrich": f"{_CONTENT} AND {_VERDICT} <> 'false'"})
_FINAL_TESTS = {
    "level_unknown": f"{PART_LEVEL} = 'Unknown'",
    "skills_empty": "NOT contains(array_to_string(words, ' '), 'i')",
    "salary_unknown": "lo = -1", "source_rule": "hi % 2 <> 0", "source_llm": "hi % 2 = 0",
    "domain_other": "hi % 5 = 0"}
_LIMITS = {"level_unknown": 0.3, "skills_empty": 0.2, "domain_other": 0.15}
ORACLES["quality_final"] = " UNION ALL ".join(
    f"SELECT {q(m)} AS metric, count(*) FILTER ({t}) AS value, "
    f"CAST({q(_LIMITS.get(m))} AS DOUBLE) AS threshold, "
    + (f"count(*) FILTER ({t}) > {_LIMITS[m]} * count(*)" if m in _LIMITS else "FALSE")
    + f" AS breached FROM {PART}" for m, t in ({"total": "TRUE"} | _FINAL_TESTS).items())

_RULE_LEVEL = "CASE " + " ".join(
    f"WHEN {has('t', word(*words))} THEN {q(label)}" for label, words in vocab.LEVELS.items()
) + " END"
# Rule-path salaries of the clean-path inputs, traced by hand.
_RULE_SALARY = [
    (None, None, None), (None, None, "VND"), (None, None, "VND"), (None, None, "VND"),
    (10.0, 20.0, "VND"), (12.5, 18.5, "VND"), (20.0, 25.0, "VND"), (25.0, 50.0, "USD"),
    (33.0, 49.5, "JPY"), (30.0, 30.0, "VND"), (37.5, 37.5, "USD"), (37.5, 37.5, "USD"),
    (15.0, 15.0, "VND"), (10.0, 20.0, "VND"), (10.0, 20.0, "VND")]
_RULED = f""", ruled AS (
  SELECT *, {_RULE_LEVEL} AS level, {single(_RULE_SALARY, 0)} AS min_salary,
         {single(_RULE_SALARY, 1)} AS max_salary, {column(_RULE_SALARY, 2)} AS currency,
         {column(X.CITY, 1)} AS city, {single(X.EXPERIENCE, 3)} AS years_of_experience
  FROM (SELECT *, CASE WHEN {at(TITLES)} IS NOT NULL THEN
          lower({at(TITLES)} || ' ' || coalesce({column(X.EXPERIENCE, 0)}, '')) END AS t
        FROM adverts))"""
ORACLES["rules_flow"] = ADVERTS + _RULED + f"""
  SELECT job_id, 'Công ty ' || source AS company, city, level, domain, {SKILL_LIST} AS skills,
         years_of_experience, min_salary, max_salary, currency
  FROM ruled WHERE domain <> 'Other'"""
_IT = "domain <> 'Other'"
ORACLES["quality_rules"] = ADVERTS + _RULED + report("ruled", {
    "it": _IT, "with_salary": f"{_IT} AND min_salary IS NOT NULL",
    "with_level": f"{_IT} AND level IS NOT NULL", "with_domain": _IT, "with_skills": _IT,
    "with_any_skill": f"{_IT} AND {SKILL_LIST} <> ''"})
ORACLES["rules_to_location_mart"] = ADVERTS + _RULED + f""",
  it AS (SELECT {at(['Khác' if r[1] not in ('Hà Nội', 'Đà Nẵng', 'TP.HCM') else
                     'Hồ Chí Minh' if r[1] == 'TP.HCM' else r[1] for r in X.CITY])} AS city,
                CAST(coalesce(ceil(max_salary), -1) AS BIGINT) AS hi, string_split({SKILL_LIST}, '|') AS skills
         FROM ruled WHERE domain <> 'Other'),
  pairs AS (SELECT city, skill, count(*) AS cnt FROM (SELECT city, unnest(skills) AS skill FROM it)
            WHERE skill <> '' AND length(skill) <= 40 GROUP BY 1, 2),
  ranked AS (SELECT *, rank() OVER (PARTITION BY city ORDER BY cnt DESC) AS rnk FROM pairs),
  top AS (SELECT city, string_agg(skill, ', ' ORDER BY cnt DESC, skill) AS top_skills FROM ranked WHERE rnk <= 5 GROUP BY city),
  totals AS (SELECT city, count(*) AS job_count, {share('count(*)', '(SELECT count(*) FROM it)')} AS percentage,
                    {avg1('hi', 'hi > 0')} AS avg_salary FROM it GROUP BY city)
  SELECT totals.*, top_skills, '{AS_OF}' AS updated_date FROM totals LEFT JOIN top USING (city)"""


# --- resume, tables ---------------------------------------------------------------------------

ORACLES["resume_anti"] = """
  SELECT o_orderkey AS job_id, o_orderstatus FROM orders AS t
  WHERE NOT EXISTS (SELECT 1 FROM orders AS l
                    WHERE l.o_orderkey = t.o_orderkey AND l.o_orderstatus = 'F')"""
ORACLES["ledger_batches"] = """
  SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS _batch_id FROM orders"""
ORACLES["stage_preview"] = """
  SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 5"""
ORACLES["partition_overwrite"] = """
  WITH days AS (SELECT CAST(ts AS DATE) AS day, event_type FROM events),
  replaced AS (SELECT day, count(*) AS n FROM days
               WHERE event_type = 'error' AND day(day) > 15 GROUP BY day)
  SELECT CAST(d.day AS VARCHAR) AS ingestion_date, coalesce(any_value(n), count(*)) AS cnt
  FROM days d LEFT JOIN replaced USING (day) GROUP BY d.day"""
ORACLES["table_count"] = "SELECT count(*) AS total_jobs FROM events"
ORACLES["table_partitions"] = """
  SELECT DISTINCT 'ingestion_date=' || CAST(CAST(ts AS DATE) AS VARCHAR) AS partition FROM events"""
ORACLES["table_partitions_added"] = """
  SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS ingestion_date, count(*) AS cnt FROM events
  WHERE day(CAST(ts AS DATE)) <= 15 GROUP BY 1"""
