"""Dictionaries of any size, matched by joins.

``functions.matching`` compiles a vocabulary into the plan, which suits hundreds of keywords. Here
the dictionary is a table. A text is cut at every place where a keyword may begin (no letter or
digit just before); each place keeps as many characters as the longest keyword has. Places and
keywords meet on their head, the first run of letters and digits or else the first character, and a
place is a hit if it starts with the keyword and no letter or digit follows. A dictionary that is
small enough, by a measured size, is broadcast and the texts stay where they are; a larger one is
joined by a shuffle of the places, in which every head is dealt over several salts.

Keys name texts: rows with the same key count as one text, and a NULL key is a key like others.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobmart import vocab
from jobmart.functions.matching import STARTS, WORD, any_of
from jobmart.functions.skills import squashed_keys
from jobmart.functions.text import SPACE, strip

#: A dictionary is broadcast up to this many characters and rows, about 100 MB in memory.
BROADCAST_CHARS = 16 * 1024 ** 2
BROADCAST_ROWS = 500_000
#: In a shuffled join, the tasks that share the places of one head.
SALTS = 16
#: Of a dictionary of up to ``PREFIX_ROWS`` rows, the first ``PREFIX`` characters of its keywords go into the pattern if
#: they are ``PREFIXES`` at most. They spare places where no keyword begins; results don't depend on them.
PREFIX, PREFIXES, PREFIX_ROWS = 4, 2000, 50_000
_HEAD = rf"^(?:[{WORD}]+|[\s\S])"
_START = rf"{STARTS}(?=\S)"


def table(spark: SparkSession, vocabulary: Mapping[str, Sequence[str]]) -> DataFrame:
    """A vocabulary mapping as a ``label, keyword`` table."""
    rows = [(label, word) for label, words in vocabulary.items() for word in words]
    return spark.createDataFrame(rows, "label string, keyword string")


def entries(dictionary: DataFrame) -> DataFrame:
    """The distinct entries of a ``label, keyword`` table: keywords stripped and in lower case, with
    their ``_head`` and the ``_span``, the number of places a keyword covers. Blank ones are dropped."""
    word = strip(F.lower("keyword"))
    return (dictionary.withColumn("keyword", word).filter("keyword != ''").dropDuplicates()
            .withColumns({"_head": F.regexp_extract("keyword", _HEAD, 0),
                          "_span": F.regexp_count("keyword", F.lit(_START))}))


def hits(texts: DataFrame, key: str, text: str, dictionary: DataFrame,
         salts: int = SALTS) -> DataFrame:
    """``key``, ``_at`` (the number of the place in the text) and the entry's columns for every
    occurrence of a keyword in the lower-cased ``text``.

    Only the dictionary's size and at most ``PREFIXES`` beginnings of keywords are asked for on the driver, never its
    rows. Places where no keyword can begin are counted, but neither cut out nor joined.
    """
    words = entries(dictionary)
    size = words.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("keyword")).alias("chars"),
                     F.max(F.length("keyword")).alias("longest"),
                     F.min(F.length(F.regexp_extract("keyword", f"^[{WORD}]*", 0))).alias("run")).first()
    longest = max(size["longest"] or 1, 1)
    small = size["n"] <= BROADCAST_ROWS and (size["chars"] or 0) <= BROADCAST_CHARS
    pattern = rf"{_START}(?=((?={_beginning(words, size)})[\s\S]{{1,{longest + 1}}})?)"
    found = F.regexp_extract_all(F.lower(F.col(text)), F.lit(pattern), F.lit(1))
    places = texts.select(F.col(key), F.posexplode(found).alias("_at", "_place")).where("_place != ''").withColumn(
        "_head", F.regexp_extract("_place", _HEAD, 0))
    if small:
        joined = places.join(F.broadcast(words), "_head")
    else:
        every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
        salt = F.pmod(F.xxhash64(key, "_at"), F.lit(salts)).cast("int")
        joined = places.withColumn("_salt", salt).join(
            words.withColumn("_salt", every), ["_head", "_salt"]).drop("_salt")
    follows = F.substring(F.col("_place"), F.length("keyword") + 1, F.lit(1))
    matches = F.startswith("_place", F.col("keyword")) & ~_ends_in_word(follows)
    return joined.filter(matches).drop("_place", "_head")


def _beginning(words: DataFrame, size) -> str:
    """A pattern of what every keyword begins with: one of their first characters, or so many letters and digits."""
    if 0 < size["n"] <= PREFIX_ROWS:
        found = words.select(F.substring("keyword", 1, PREFIX).alias("p")).distinct().limit(PREFIXES + 1).collect()
        if len(found) <= PREFIXES:
            return any_of(sorted(r.p for r in found))
    return f"[{WORD}]{{{size['run'] or 0}}}"


def _ends_in_word(c: Column) -> Column:
    return c.rlike(f"^[{WORD}]")


def labels_by_join(texts: DataFrame, key: str, text: str, dictionary: DataFrame,
                   other: str | None = None) -> DataFrame:
    """``key, labels``: per text the sorted distinct labels with a keyword in it, or ``[other]``."""
    found = hits(texts, key, text, dictionary).groupBy(key).agg(
        F.array_sort(F.collect_set("label")).alias("labels"))
    none = F.array(F.lit(other)) if other is not None else F.array().cast("array<string>")
    return _for_all(texts, key, found).withColumn("labels", F.coalesce("labels", none))


def first_by_join(texts: DataFrame, key: str, text: str, ranked: DataFrame) -> DataFrame:
    """``key, label``: per text the label of the best keyword present, NULL without one.

    ``ranked`` has a ``rank`` beside ``label`` and ``keyword``; the least wins.
    """
    found = hits(texts, key, text, ranked).groupBy(key).agg(F.min_by("label", "rank").alias("label"))
    return _for_all(texts, key, found)


def skills_by_join(texts: DataFrame, key: str, text: str, dictionary: DataFrame,
                   domains: DataFrame) -> DataFrame:
    """``key, skills``: per text the dictionary's skills of the text's own domains.

    ``dictionary`` has the domain as ``label`` and the skill as ``keyword``; ``domains`` is
    ``key, labels``. In each domain the longest skill at a place is taken and its places are used
    up ("C++" hides "C" there). Names are given in the dictionary's own spelling, sorted.
    """
    stripped = dictionary.select("label", strip(F.col("keyword")).alias("name")).filter("name != ''")
    longest = F.struct(-F.length("name"), "name")
    names = stripped.groupBy(strip(F.lower("name")).alias("keyword")).agg(F.min_by("name", longest).alias("name"))
    own = domains.select(F.col(key).alias("_key"), F.explode("labels").alias("_label"))
    found = hits(texts, key, text, dictionary.select("label", "keyword"))
    found = found.join(own, F.col(key).eqNullSafe(F.col("_key")) & (F.col("label") == F.col("_label")), "left_semi")
    in_order = F.array_sort(F.collect_set(F.struct("_at", (-F.length("keyword")).alias("_short"), "_span", "keyword")))
    start = F.struct(F.lit(0).alias("free"), F.array().cast("array<string>").alias("taken"))
    walked = F.aggregate("_found", start, lambda a, h: F.when(
        h["_at"] >= a["free"], F.struct((h["_at"] + h["_span"]).cast("int").alias("free"),
                                        F.array_union(a["taken"], F.array(h["keyword"])).alias("taken"))).otherwise(a))
    taken = (found.groupBy(key, "label").agg(in_order.alias("_found"))
             .select(key, F.explode(walked["taken"]).alias("keyword")).dropDuplicates())
    named = taken.join(names, "keyword").groupBy(key).agg(
        F.array_sort(F.collect_set("name")).alias("skills"))
    return _for_all(texts, key, named).withColumn(
        "skills", F.coalesce("skills", F.array().cast("array<string>")))


def canonical_by_join(names: DataFrame, skill: str, aliases: DataFrame) -> DataFrame:
    """Adds ``canonical``: the name of a skill in an ``alias, name`` table of any size, by the rules
    of ``skills.canonical_skill``; unknown skills keep their own spelling.

    Distinct spellings are looked up, so that a skill in a third of all rows is one row of the join.
    """
    table = aliases.select(F.regexp_replace(F.lower("alias"), rf"{SPACE}+|[.\-/]+", "").alias("_squashed"), "name")
    table = table.groupBy("_squashed").agg(F.min("name").alias("name"))
    distinct = names.select(F.col(skill).alias("_skill")).dropDuplicates()
    tried = distinct.select("_skill", F.posexplode(F.array(*squashed_keys(F.col("_skill")))).alias("_try", "_squashed"))
    known = tried.join(table, "_squashed").groupBy("_skill").agg(F.min_by("name", "_try").alias("canonical"))
    return (names.join(known, F.col(skill) == F.col("_skill"), "left").drop("_skill")
            .withColumn("canonical", F.coalesce("canonical", strip(F.col(skill)))))


def _for_all(texts: DataFrame, key: str, found: DataFrame) -> DataFrame:
    """``found`` for every key of ``texts``; only keys travel."""
    keys = texts.select(F.col(key)).dropDuplicates()
    renamed = found.withColumnRenamed(key, "_key")
    return keys.join(renamed, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def cities(spark: SparkSession, locations: Mapping[str, Sequence[str]] = vocab.LOCATIONS) -> DataFrame:
    """Location keywords ranked as ``labels.city`` ranks them: long first, then in given order."""
    pairs = [(w.lower(), label) for label, words in locations.items() for w in words]
    pairs.sort(key=lambda p: -len(re.escape(p[0])))
    seen: dict[str, tuple[str, int]] = {}
    for i, (word, label) in enumerate(pairs):
        seen.setdefault(word.strip(), (label, i))
    return spark.createDataFrame([(label, word, i) for word, (label, i) in seen.items()],
                                 "label string, keyword string, rank int")
