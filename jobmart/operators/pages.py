"""Advert fields out of crawled HTML: list pages, detail pages and their merge.

Elements are found by tag, class and attribute with patterns that do not depend on attribute
order, quotes or further classes. Nested ``div`` blocks are cut by counting, so an element ends
at its own closing tag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobmart import schemas
from jobmart.operators.dedup import first_per_key
from jobmart.functions.text import SPACE, canonical_url, let, non_empty, strip, unescape

# --- fixed values: markup of the crawled site ------------------------------------------------
ITEM_CLASS = "job-item-search-result"
GROUPS = {"tags_requirement": "Yêu cầu", "tags_specialization": "Chuyên môn"}
SECTIONS = {
    "mo_ta_cong_viec_html": "Mô tả công việc",
    "yeu_cau_ung_vien_html": "Yêu cầu ứng viên",
    "quyen_loi_html": "Quyền lợi",
}
DEADLINE_CLASS = "job-detail__information-detail--actions-label"


def _start(tag: str, cls: str | None = None, attr: str | None = None,
           element_id: str | None = None) -> str:
    """Pattern of an opening tag, without the ``<``, having a class token, attribute or id."""
    need = ""
    if cls:
        need += rf"""(?=[^>]*?\sclass\s*=\s*["'](?:[^"'>]*\s)?{cls}(?:\s[^"'>]*)?["'])"""
    if element_id:
        need += rf"""(?=[^>]*?\sid\s*=\s*["']{element_id}["'])"""
    if attr:
        need += rf"(?=[^>]*?\s{attr}\s*=)"
    return rf"{tag}(?=[\s>/]){need}[^>]*>"


def opening(tag: str, **need: str) -> str:
    return "<" + _start(tag, **need)


def _element(tag: str, **need: str) -> str:
    return rf"(?is){opening(tag, **need)}(.*?)</{tag}\s*>"


def first(html: Column, tag: str, **need: str) -> Column:
    """Inner HTML of the first such element, '' if none. For elements not nested in their kind."""
    return F.regexp_extract(html, _element(tag, **need), 1)


def every(html: Column, tag: str, **need: str) -> Column:
    """Inner HTML of all such elements."""
    return F.regexp_extract_all(html, F.lit(_element(tag, **need)), F.lit(1))


def attribute(open_tag: Column, name: str) -> Column:
    """Raw value of an attribute in an opening tag; '' when absent."""
    pattern = rf"""(?is)\A<\w+(?:\s[^>]*?)?\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)')"""
    return F.concat(F.regexp_extract(open_tag, pattern, 1),
                    F.regexp_extract(open_tag, pattern, 2))


def inner_text(inner: Column) -> Column:
    """Text of an element, entities still encoded: text nodes stripped and joined."""
    return F.regexp_replace(inner, rf"{SPACE}*<[^>]+>{SPACE}*", "")


def decoded(*raw: Column) -> Column:
    """Decoded and stripped texts, as one array so that the decoder is planned once."""
    return F.transform(F.array(*raw), lambda r: strip(unescape(F.coalesce(r, F.lit("")))))


_SPAN = "struct<start:int,stop:int>"
_SCAN = f"struct<at:int,start:int,depth:int,spans:array<{_SPAN}>>"


def blocks(html: Column, **need: str) -> Column:
    """All ``div`` elements of a kind that does not nest in itself, each complete.

    The text is cut at its ``div`` tags, and a fold over the pieces counts the nesting and notes where
    each element starts and stops. It goes by runs of pieces, the square root of all long, and only
    a whole run's spans are added to the list, so a page of thousands of items isn't copied for
    each of them. An unclosed element takes the rest of the text.
    """
    def state(at, start, depth, spans) -> Column:
        return F.struct(at, start, depth, spans).cast(_SCAN)

    def step(s: Column, piece: Column) -> Column:
        at = s["at"] + 1
        opens = piece.rlike(r"(?i)\Adiv").cast("int")
        closes = piece.rlike(r"(?i)\A/div").cast("int")
        depth = s["depth"] + opens - closes
        span = F.array(F.struct(s["start"], at).cast(_SPAN))
        starts = (at > 1) & piece.rlike(rf"(?is)\A{_start('div', **need)}")
        zero = F.lit(0)
        return (F.when((s["start"] == 0) & ~starts, state(at, zero, zero, s["spans"]))
                .when(s["start"] == 0, state(at, at, F.lit(1), s["spans"]))
                .when(depth == 0, state(at, zero, zero, F.concat(s["spans"], span)))
                .otherwise(state(at, s["start"], depth, s["spans"])))

    def finish(s: Column) -> Column:
        rest = F.array(F.struct(s["start"], s["at"] + 1).cast(_SPAN))
        return F.when(s["start"] > 0, F.concat(s["spans"], rest)).otherwise(s["spans"])

    none = F.array().cast(f"array<{_SPAN}>")

    def run(s: Column, pieces: Column) -> Column:
        begin = state(s["at"], s["start"], s["depth"], none)
        return F.aggregate(pieces, begin, step, lambda t: state(
            t["at"], t["start"], t["depth"], F.concat(s["spans"], t["spans"])))

    def cut(pieces: Column) -> Column:
        long = F.greatest(F.lit(64), F.ceil(F.sqrt(F.size(pieces)))).cast("int")
        starts = F.sequence(F.lit(1), F.greatest(F.size(pieces), F.lit(1)), long)
        runs = F.transform(starts, lambda i: F.slice(pieces, i, long))
        spans = F.aggregate(runs, state(F.lit(0), F.lit(0), F.lit(0), none), run, finish)
        return F.transform(spans, lambda p: F.concat(
            F.lit("<"), F.array_join(F.slice(pieces, p["start"], p["stop"] - p["start"]), "<"),
            F.when(p["stop"] > F.size(pieces), F.lit("")).otherwise(F.lit("</div>"))))

    return let(F.split(html, r"<(?=(?i:/?div)[\s>/])"), cut)


def title_of(link: Column) -> Column:
    """Title of a link element: tooltip span, its text, then the link's own attributes, text."""
    tip = opening("span", attr="data-original-title")
    span = F.regexp_extract(link, rf"(?is){tip}", 0)
    inside = F.regexp_extract(link, rf"(?is){tip}(.*?)</span\s*>", 1)
    choices = decoded(attribute(span, "data-original-title"), inner_text(inside),
                      attribute(link, "title"), attribute(link, "aria-label"), inner_text(link))
    return F.coalesce(F.get(F.filter(choices, lambda c: c != ""), F.lit(0)), F.lit(""))


def _link(item: Column) -> Column:
    """The link of a list item as outer HTML, from the heading or else from the picture."""
    anchor = rf"(?is){opening('a', attr='href')}.*?</a\s*>"
    heading = first(item, "h3", cls="title")
    picture = F.get(blocks(item, cls="avatar"), F.lit(0))
    return F.coalesce(non_empty(F.regexp_extract(heading, anchor, 0)),
                      non_empty(F.regexp_extract(picture, anchor, 0)))


def listing(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per advert on a list page, with the input's other columns and ``position``."""
    item = F.col("_item")
    found = pages.select(
        *[c for c in pages.columns if c != html],
        F.posexplode(blocks(F.col(html), cls=ITEM_CLASS, attr="data-job-id"))
        .alias("position", "_item"))
    named = found.withColumn("_link", _link(item))
    link = F.col("_link")
    company = F.regexp_extract(
        first(item, "a", cls="company"),
        r"(?is)" + opening(r"(\w+)", cls="company-name") + r"(.*?)</\1\s*>", 2)
    location = F.regexp_extract(
        first(item, "label", cls="address"),
        r"(?is)" + opening(r"(\w+)", cls="city-text") + r"(.*?)</\1\s*>", 2)
    salary = F.coalesce(F.get(every(item, "label", cls="title-salary"), F.lit(0)),
                        first(first(item, "label", cls="salary"), "span"))
    experience = first(first(item, "label", cls="exp"), "span")
    tags = F.flatten(F.transform(blocks(item, cls="tag"),
                                 lambda b: every(b, "a", cls="item-tag")))
    fields = ["job_id", "url", "company", "salary", "location", "experience"]
    raw = [attribute(item, "data-job-id"), attribute(link, "href"),
           *[inner_text(c) for c in (company, salary, location, experience)]]
    read = named.select(
        *[c for c in found.columns if c != "_item"],
        title_of(link).alias("title"), decoded(*raw).alias("_fields"),
        F.transform(tags, lambda t: strip(unescape(inner_text(t)))).alias("tags"))
    values = {name: F.get("_fields", F.lit(i)) for i, name in enumerate(fields)}
    values["url"] = canonical_url(values["url"])
    return read.select(
        *[c for c in found.columns if c != "_item"], "title",
        *[values[name].alias(name) for name in fields], "tags")


def _last_match(rows: Column, field: str, default: Column) -> Column:
    return F.coalesce(F.try_element_at(rows, F.lit(-1))[field], default)


def detail(pages: DataFrame, html: str = "html") -> DataFrame:
    """Description, requirements, benefits, tag groups and deadline of a detail page.

    Sections are chosen by their heading and tag groups by their name; what is missing is ``''``
    or ``[]``. Where a heading fits several names the first name of the list claims it.
    """
    page = F.col(html)
    box = F.get(blocks(page, element_id="box-job-information-detail"), F.lit(0))
    groups = F.transform(blocks(box, cls="job-tags__group"), lambda g: F.struct(
        F.get(decoded(inner_text(first(g, "div", cls="job-tags__group-name"))), F.lit(0))
        .alias("name"),
        F.transform(every(g, "a", cls="item"), lambda a: strip(unescape(inner_text(a))))
        .alias("items")))
    sections = F.transform(blocks(page, cls="job-description__item"), lambda s: F.struct(
        inner_text(first(s, "h3")).alias("name"),
        F.get(blocks(s, cls="job-description__item--content"), F.lit(0)).alias("content")))
    prepared = pages.select(*[c for c in pages.columns if c != html],
                            page.alias("_page"), groups.alias("_groups"),
                            F.filter(sections, lambda s: s["content"].isNotNull())
                            .alias("_sections"))

    def chosen(rows: str, names: list[str], i: int) -> Column:
        def mine(r: Column) -> Column:
            keep = r["name"].contains(names[i])
            for earlier in names[:i]:
                keep = keep & ~r["name"].contains(earlier)
            return keep
        return F.filter(F.col(rows), mine)

    none = F.array().cast("array<string>")
    group_names, section_names = list(GROUPS.values()), list(SECTIONS.values())
    return prepared.select(
        *[c for c in pages.columns if c != html],
        *[_last_match(chosen("_groups", group_names, i), "items", none).alias(name)
          for i, name in enumerate(GROUPS)],
        *[_last_match(chosen("_sections", section_names, i), "content", F.lit("")).alias(name)
          for i, name in enumerate(SECTIONS)],
        F.get(decoded(inner_text(first(F.col("_page"), "div", cls=DEADLINE_CLASS))), F.lit(0))
        .alias("deadline"),
    )


def merge(listed: DataFrame, details: DataFrame) -> DataFrame:
    """Complete the list rows by url; rows without a detail page keep what the list gave.

    A url that was fetched more than once counts with one of its details, and an empty url is none.
    A list with many rows of one url is left to adaptive skew handling, which splits the hot side of
    a sort-merge join.
    """
    url = F.nullif(F.col("url"), F.lit(""))
    one = first_per_key(details.withColumn("url", url).where("url is not null"), "url", [])
    return listed.withColumn("url", url).join(one, "url", "left")


def adverts(list_pages: DataFrame, detail_pages: DataFrame, html: str = "html") -> DataFrame:
    """Adverts in the schema of the raw stage, from list pages and the detail pages fetched for them.

    Detail pages have a ``url`` as it was fetched, query string and all. An advert without a link keeps its
    empty url and meets no detail page; without a detail page the fields that only it gives are NULL.
    """
    fields = schemas.POSTING.fieldNames()
    listed = listing(list_pages.select(F.col(html).alias("html"))).drop("position")
    fetched = detail_pages.select(canonical_url(F.col("url")).alias("url"), F.col(html).alias("html"))
    whole = merge(listed, detail(fetched)).withColumn("url", F.coalesce("url", F.lit("")))
    return whole.select(*fields)
