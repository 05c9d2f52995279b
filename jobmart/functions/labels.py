"""Vocabulary-driven labels: city, level, domains, skills and mart buckets."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobmart import vocab
from jobmart.functions.matching import ENDS, STARTS, all_labels, any_of, contains_any, first_label
from jobmart.functions.text import constant, non_empty, strip, strip_tags

Vocabulary = Mapping[str, Sequence[str]]


def city(c: Column, locations: Vocabulary = vocab.LOCATIONS) -> Column:
    """Province named in a location text.

    The longest keyword present wins wherever it stands. Length is measured on the escaped
    keyword (a blank or dot counts twice); ties keep vocabulary order.
    """
    pairs = [(w.lower(), label) for label, words in locations.items() for w in words]
    pairs.sort(key=lambda p: -len(re.escape(p[0])))
    found = first_label(strip(F.lower(c)), pairs)
    return F.coalesce(found, F.lit(vocab.OTHER_CITY))


def mart_city(c: Column) -> Column:
    """Coarse city bucket of the location mart (case-sensitive substring tests, in order)."""
    first, *rest = vocab.MART_CITIES
    out = F.when(c.contains(first), F.lit(first))
    for name in rest:
        out = out.when(c.contains(name), F.lit(name))
    return out.otherwise(F.lit(vocab.OTHER_CITY))


def mart_place(label: Column) -> Column:
    """A province label of ``city`` in the spelling that ``mart_city`` tests for."""
    return F.when(label == "TP.HCM", vocab.MART_CITIES[1]).when(label == "Remote", vocab.MART_CITIES[3]).otherwise(label)


def rules_level(title: Column, experience: Column, levels: Vocabulary = vocab.LEVELS) -> Column:
    """Highest-priority level with a keyword in title or experience; NULL without a title."""
    text = F.lower(F.concat_ws(" ", non_empty(title), F.coalesce(experience, F.lit(""))))
    ranked = [(w, label) for label, words in levels.items() for w in words]
    return F.when(non_empty(title).isNotNull(), first_label(text, ranked))


def title_level(title: Column, exp_min: Column) -> Column:
    """Level from title substrings, else from years of experience, else ``Unknown``."""
    t = F.lower(title)
    out = None
    for label, words in vocab.TITLE_LEVELS.items():
        test = contains_any(t, words)
        out = F.when(test, label) if out is None else out.when(test, label)
    return (out.when(exp_min.isNull() | (exp_min < 0), "Unknown").when(exp_min >= 7, "Senior")
            .when(exp_min >= 3, "Middle").otherwise("Junior"))


def pooled_text(title: Column, tag_lists: Sequence[Column], html_texts: Sequence[Column]) -> Column:
    """One searchable text: title, tags and tag-free HTML, joined so that words never merge."""
    lists = [F.filter(tags, lambda t: t != "") for tags in tag_lists]
    bodies = [strip_tags(non_empty(h)) for h in html_texts]
    return F.concat_ws(" | ", non_empty(title), *lists, *bodies)


def posting_text() -> Column:
    """The pooled text of an advert row. Benefits are left out."""
    return pooled_text(
        F.col("title"),
        [F.col("tags"), F.col("tags_requirement"), F.col("tags_specialization")],
        [F.col("mo_ta_cong_viec_html"), F.col("yeu_cau_ung_vien_html")])


def with_domains(df: DataFrame, text: str,
                 vocabulary: Vocabulary = vocab.DOMAINS) -> DataFrame:
    """Add ``domain``: every technical domain mentioned, sorted; ``["Other"]`` for none.

    The match is the costliest step of a flow and filters usually follow it. Catalyst would push
    such a filter below the projection by copying the match into it, so that the text is scanned
    twice. Producing the match through a one-row ``explode`` keeps it in one place.
    """
    found = F.col("_found")
    match = F.explode(F.array(all_labels(F.lower(F.col(text)), vocabulary))).alias("_found")
    return (df.select("*", match)
            .withColumn("domain", F.when(F.size(found) > 0, found)
                        .otherwise(F.array(F.lit(vocab.OTHER_DOMAIN))))
            .drop("_found"))


def skills(text: Column, found_domains: Column, dictionary: Vocabulary = vocab.SKILLS) -> Column:
    """Skills of the row's own domains, canonical spelling, sorted and distinct.

    One case-insensitive pattern per domain, longest skill first and consuming, evaluated only
    on rows having that domain ("C++" therefore hides "C" at the same place).
    """
    canonical: dict[str, str] = {}
    for names in dictionary.values():
        for name in names:
            kept = canonical.get(name.strip().lower())
            if kept is None or len(name.strip()) > len(kept):
                canonical[name.strip().lower()] = name.strip()
    none = F.array().cast("array<string>")
    hits = []
    for domain, names in dictionary.items():
        words = sorted({n.strip().lower() for n in names if n.strip()})
        if not words:
            continue
        pattern = f"(?iu){STARTS}({any_of(words)}){ENDS}"
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
        hits.append(F.when(F.array_contains(found_domains, domain), found).otherwise(none))
    spelling = constant(canonical, "map<string,string>")
    lowered = F.array_distinct(F.transform(F.concat(*hits), F.lower))
    named = F.transform(lowered, lambda s: F.try_element_at(spelling, s))
    return F.coalesce(F.array_sort(F.array_distinct(F.array_compact(named))), none)
