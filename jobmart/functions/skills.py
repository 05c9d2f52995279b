"""Skill aliases to canonical names."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from jobmart import vocab
from jobmart.functions.text import SPACE, constant, strip

_SEPARATORS = r"[\s.\-/]+"
# Names written with an "apache" prefix or a "js" suffix too; elsewhere these name another product.
_APACHE = "spark|kafka|airflow|hadoop|hive"
_JS = "react|vue|angular"


def alias_table(canonical: Sequence[str] = tuple(vocab.CANONICAL_SKILLS),
                irregular: Mapping[str, str] = vocab.IRREGULAR_ALIASES) -> dict[str, str]:
    """Squashed spelling -> canonical name.

    A squashed spelling is lower case without blanks, dots, hyphens and slashes, so the regular
    variants ("node js", "node.js", "NodeJS") need no entry of their own.
    """
    squash = lambda s: re.sub(_SEPARATORS, "", s.lower())
    table = {squash(alias): name for alias, name in irregular.items()}
    table.update({squash(name): name for name in canonical})
    return table


def canonical_skill(c: Column, table: Mapping[str, str] | None = None) -> Column:
    """Canonical name of one skill; an unknown skill keeps its own spelling.

    An "apache" prefix and a "js" suffix are dropped from the few names that are written so.
    """
    names = constant(dict(table or alias_table()), "map<string,string>")
    return F.coalesce(*[F.try_element_at(names, k) for k in squashed_keys(c)], strip(c))


def squashed_keys(c: Column) -> list[Column]:
    """The squashed spellings under which a skill is looked up, in that order."""
    key = F.regexp_replace(F.lower(c), rf"{SPACE}+|[.\-/]+", "")
    return [key, F.regexp_replace(key, f"^apache(?=({_APACHE})$)", ""),
            F.regexp_replace(key, f"(?<=^({_JS}))js$", "")]


def canonical_skills(c: Column, table: Mapping[str, str] | None = None) -> Column:
    """Canonical names of a skill list, first occurrence kept."""
    return F.array_distinct(F.transform(c, lambda s: canonical_skill(s, table)))
