"""Text columns: trimming, HTML to text, entity decoding. All JVM-side."""

from __future__ import annotations

import html
import json
import sys
import unicodedata
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column, functions as F

# Whitespace of a Unicode-aware strip: every character Python's str.isspace accepts. Spelt out
# for patterns, because the JVM's \s is ASCII only and its Unicode variant leaves out
# U+001C..U+001F.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

_DIGITS = "".join(
    chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"
)
_ASCII = "".join(str(unicodedata.digit(c)) for c in _DIGITS)


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace, Unicode-aware. Looks at the ends only."""
    return F.btrim(c, F.lit(WHITESPACE))


def non_empty(c: Column) -> Column:
    """NULL for the empty string."""
    return F.nullif(c, F.lit(""))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern``, or NULL (not ``''``) when there is none."""
    return non_empty(F.regexp_extract(c, pattern, group))


def ascii_digits(c: Column) -> Column:
    """Rewrite every Unicode decimal digit (full-width and others) as 0-9."""
    return F.when(c.rlike(r"[^\x00-\x7f]"), F.translate(c, _DIGITS, _ASCII)).otherwise(c)


def collapse_spaces(c: Column) -> Column:
    """Company names: every whitespace run becomes one blank, then trim blanks."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def canonical_url(c: Column) -> Column:
    """Drop the query string."""
    return F.substring_index(c, "?", 1)


def strip_tags(c: Column) -> Column:
    """Replace every tag by a blank."""
    return F.regexp_replace(c, r"<[^>]+>", " ")


def strip_location_marker(c: Column) -> Column:
    """Remove the "(new)" markers of merged provinces; NULL becomes ''."""
    gone = F.regexp_replace(c, rf"(?iu){SPACE}*+\((?:mới|new)\)", "")
    return F.coalesce(strip(gone), F.lit(""))


# --- entities ---------------------------------------------------------------------------------
# Both lookup tables come from the standard library. The five usual names lead the table, since
# a literal map is searched in order.
_USUAL = ["amp;", "nbsp;", "lt;", "gt;", "quot;"]
_NAMED = {n: html5[n] for n in _USUAL} | {n: v for n, v in html5.items() if n.endswith(";")}
_LEGACY = {n: v for n, v in html5.items() if not n.endswith(";")}
_LEGACY_START = "^(" + "|".join(sorted(_LEGACY, key=len, reverse=True)) + ")"
# Code points below 160 include the Windows-1252 leftovers that browsers remap.
_LOW = [html.unescape(f"&#{n};") for n in range(160)]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def constant(value: list | dict, kind: str) -> Column:
    """A list or mapping as one literal; the optimizer folds the parsing away."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _char(code: Column) -> Column:
    """Text of a numeric character reference (``code`` is NULL when out of range)."""
    low = constant(_LOW, "array<string>")
    return (
        F.when(code.isNull() | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), F.lit("\ufffd"))
        .when(code < 160, F.get(low, code.cast("int")))
        .when(
            code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE), F.lit("")
        )
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    )


def _code(digits: Column, base: int, longest: int) -> Column:
    significant = F.regexp_replace(digits, "^0+(?=.)", "")
    number = F.conv(significant, base, 10).cast("long")
    return F.when(F.length(significant) <= longest, number)


def _decode_number(piece: Column, unclosed: bool) -> Column:
    end = ";?" if unclosed else ";"
    reference = F.regexp_extract(piece, rf"^#([0-9]+|[xX][0-9a-fA-F]+){end}", 1)
    code = F.when(reference.rlike("^[xX]"), _code(F.substr(reference, F.lit(2)), 16, 6)).otherwise(
        _code(reference, 10, 7))
    rest = F.regexp_replace(piece, r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?", "")
    return F.when(reference == "", F.concat(F.lit("&"), piece)).otherwise(
        F.concat(let(code, _char), rest))


def _decode_name(piece: Column, unclosed: bool) -> Column:
    def with_table(table: dict) -> Callable[[Column], Column]:
        return lambda name: F.concat(F.try_element_at(constant(table, "map<string,string>"), name),
                                     F.substr(piece, F.length(name) + 1))

    name = F.regexp_extract(piece, r"^[^\t\n\x0c <&#;]{1,32};", 0)
    legacy = F.regexp_extract(piece, _LEGACY_START, 1)
    known = [let(name, with_table(_NAMED)), *([let(legacy, with_table(_LEGACY))] if unclosed else [])]
    return (
        F.when(piece.startswith("amp;"), F.concat(F.lit("&"), F.substr(piece, F.lit(5))))
        .otherwise(F.coalesce(*known, F.concat(F.lit("&"), piece))))


def unescape(c: Column, unclosed: bool = True) -> Column:
    """Decode character references the way HTML5 does, in one left-to-right pass.

    Covers named (with or without the closing semicolon), decimal and hexadecimal references.
    Without ``unclosed`` a reference needs its semicolon, as in XML, and ``&amp`` cut short stays.
    Text without ``&`` is passed through untouched.
    """
    def piece(p: Column, i: Column) -> Column:
        return F.when(i == 0, p).when(p.startswith("#"), _decode_number(p, unclosed)).otherwise(
            _decode_name(p, unclosed))

    return let(c, lambda t: F.when(
        t.contains("&"), F.array_join(F.transform(F.split(t, "&"), piece), "")).otherwise(t))


BULLET = "\n• "
LINE_TAG = rf"br{SPACE}*/?>|/[uo]l>"


def tags_by_pattern(c: Column) -> Column:
    """Tags to bullets and line breaks, one pattern after the other. Right for any text."""
    t = F.regexp_replace(c, r"<li[^>]*>", BULLET)
    t = F.regexp_replace(t, r"<p[^>]*>", "\n")
    t = F.regexp_replace(t, rf"<(?:{LINE_TAG})", "\n")
    return F.regexp_replace(t, r"<[^>]+>", "")


def tags_to_lines(c: Column) -> Column:
    """Same result as ``tags_by_pattern``, in one split where every ``<`` has its own ``>``.

    Splitting at a single character avoids the regex engine and is several times faster than the
    four patterns. A text with a stray ``<`` takes the patterns.
    """
    def piece(p: Column, i: Column) -> Column:
        after = F.substr(p, F.instr(p, ">") + 1)
        line = p.startswith("p") | ((p.startswith("b") | p.startswith("/"))
                                    & p.rlike(rf"\A(?:{LINE_TAG})"))
        return (F.when(i == 0, p)
                .when(p.startswith("li"), F.concat(F.lit(BULLET), after))
                .when(line, F.concat(F.lit("\n"), after))
                .when(p.startswith(">"), F.concat(F.lit("<"), p))
                .otherwise(after))

    def replaced(pieces: Column) -> Column:
        tags = F.slice(pieces, F.lit(2), F.size(pieces))
        stray = F.exists(tags, lambda p: ~p.contains(">"))
        return F.when(~stray, F.array_join(F.transform(pieces, piece), ""))

    return F.coalesce(let(F.split(c, "<"), replaced), tags_by_pattern(c))


def html_to_text(c: Column, unclosed: bool = True) -> Column:
    """HTML to readable text: list items become bullets, blocks become lines.

    NULL becomes ''. Blank lines are kept, but never two in a row. Entities are decoded after
    the tags are gone, so an escaped tag stays visible; ``unclosed`` as in ``unescape``.
    """
    return F.coalesce(tidy_lines(unescape(tags_to_lines(c), unclosed)), F.lit(""))


_ODD_BREAKS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"


def tidy_lines(c: Column) -> Column:
    """Strip every line and keep at most one blank line in a row.

    Breaks other than a newline are looked for by plain search, which is nearly free, and only
    texts having one go through the pattern.
    """
    def one_break(t: Column) -> Column:
        odd = t.contains(_ODD_BREAKS[0])
        for ch in _ODD_BREAKS[1:]:
            odd = odd | t.contains(ch)
        return F.when(odd, F.regexp_replace(t, rf"\r\n|[{_ODD_BREAKS}]", "\n")).otherwise(t)

    def kept(lines: Column) -> Column:
        return F.filter(lines, lambda line, i: (line != "") | (
            F.coalesce(F.get(lines, i - 1), F.lit("x")) != ""))

    lines = F.transform(F.split(let(c, one_break), "\n"), strip)
    return strip(F.array_join(let(lines, kept), "\n"))
