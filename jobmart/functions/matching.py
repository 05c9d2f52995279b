"""Dictionary matching in one regex pass over the text.

One regex per keyword makes every row pay for every keyword. Here all keywords of a vocabulary
are folded into a single prefix-shared pattern, and a zero-width lookahead reports the longest
keyword starting at each word boundary. Shorter keywords hidden behind a longer one at the same
position are restored from a table computed once (``covered``), so no hit is lost.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, functions as F

from jobmart.functions.text import constant

# --- fixed values: characters that count as part of a word -----------------------------------
WORD = r"a-zA-Z0-9\u00C0-\u024F\u1E00-\u1EFF"

STARTS = rf"(?<![{WORD}])"
ENDS = rf"(?![{WORD}])"

_WORD_CHAR = re.compile(f"[{WORD}]")


def any_of(words: Iterable[str]) -> str:
    """A pattern matching the longest of ``words``, with shared prefixes factored out."""
    root: dict = {}
    for word in words:
        node = root
        for ch in word:
            node = node.setdefault(ch, {})
        node[""] = {}
    return _render(root)


def _render(node: dict) -> str:
    branches = [
        ("\\" + ch if ch in r"\.^$|?*+()[]{}" else ch) + _render(child)
        for ch, child in node.items() if ch
    ]
    if not branches:
        return ""
    if "" in node:
        return "(?:" + "|".join(branches) + ")?"
    return branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"


def scan(text: Column, keywords: Sequence[str]) -> Column:
    """All keywords found at word boundaries of lower-cased ``text`` (longest per position)."""
    words = sorted({k.lower() for k in keywords})
    first = "".join(sorted({re.escape(w[0]) for w in words}))
    pattern = f"{STARTS}(?=[{first}])(?=({any_of(words)}){ENDS})"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def covered(keywords: Iterable[str]) -> dict[str, list[str]]:
    """For each keyword: itself and every keyword that is a whole-word prefix of it."""
    words = {k.lower() for k in keywords}
    return {
        w: [p for p in words
            if w == p or (w.startswith(p) and not _WORD_CHAR.match(w[len(p)]))]
        for w in words
    }


def all_labels(text: Column, vocabulary: Mapping[str, Sequence[str]]) -> Column:
    """Sorted distinct labels that have at least one keyword in lower-cased ``text``."""
    owner: dict[str, set[str]] = {}
    for label, words in vocabulary.items():
        for w in words:
            owner.setdefault(w.strip().lower(), set()).add(label)
    owner.pop("", None)
    table = {
        w: sorted(set().union(*(owner[p] for p in prefixes)))
        for w, prefixes in covered(owner).items()
    }
    labels = constant(table, "map<string,array<string>>")
    hits = F.array_distinct(scan(text, list(owner)))
    found = F.flatten(F.transform(hits, lambda h: F.try_element_at(labels, h)))
    return F.array_sort(F.array_distinct(found))


def first_label(text: Column, ranked: Sequence[tuple[str, str]]) -> Column:
    """Label of the best-ranked keyword present in lower-cased ``text``, or NULL.

    ``ranked`` lists ``(keyword, label)`` from best to worst.
    """
    rank: dict[str, int] = {}
    for i, (word, _) in enumerate(ranked):
        rank.setdefault(word.lower(), i)
    best = {w: min(rank[p] for p in prefixes) for w, prefixes in covered(rank).items()}
    table = constant(best, "map<string,int>")
    hits = scan(text, list(rank))
    winner = F.array_min(F.transform(hits, lambda h: F.try_element_at(table, h)))
    return F.get(constant([label for _, label in ranked], "array<string>"), winner)


def contains_any(text: Column, needles: Sequence[str]) -> Column:
    """Plain substring test for any of ``needles``."""
    out = text.contains(needles[0])
    for needle in needles[1:]:
        out = out | text.contains(needle)
    return out
