"""The one-pass matchers against one regex per keyword."""

from __future__ import annotations

import random
import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from jobmart import vocab
from jobmart.functions import labels
from jobmart.functions.matching import WORD, all_labels, any_of, covered, first_label

BEFORE, AFTER = f"(?<![{WORD}])", f"(?![{WORD}])"


def present(word: str, text: str) -> bool:
    return re.search(BEFORE + re.escape(word.lower()) + AFTER, text.lower()) is not None


def texts_of(words: list[str], n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    glue = [" ", ", ", "", "-", "/", ".", "ế", "x", "3", " | ", "\n", "C++", "#"]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 12)):
            w = rng.choice(words)
            if rng.random() < 0.3:
                w = w[: rng.randint(1, len(w))]
            parts += [rng.choice([w, w.upper(), w.title()]), rng.choice(glue)]
        out.append("".join(parts))
    return out


def evaluate(spark, texts, build, extra=None):
    rows = [(i, t, *(extra[i] if extra else ())) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string" + (", d array<string>" if extra else ""))
    return [r.o for r in df.select("i", build().alias("o")).orderBy("i").collect()]


def test_all_domains_are_found(spark):
    words = [w for ws in vocab.DOMAINS.values() for w in ws]
    texts = texts_of(words, 1500, 1)
    got = evaluate(spark, texts, lambda: all_labels(F.lower("t"), vocab.DOMAINS))
    want = [sorted(d for d, ws in vocab.DOMAINS.items() if any(present(w, t) for w in ws))
            for t in texts]
    assert got == want
    assert sum(len(w) > 1 for w in want) > 100


def test_city_takes_the_longest_keyword(spark):
    words = [w for ws in vocab.LOCATIONS.values() for w in ws]
    texts = texts_of(words, 1500, 2)

    def best(t):
        t = t.lower().strip()
        hits = [(-len(re.escape(w)), i, city) for i, (city, w) in enumerate(
            (c, w) for c, ws in vocab.LOCATIONS.items() for w in ws) if present(w, t)]
        return min(hits)[2] if hits else "Khác"

    assert evaluate(spark, texts, lambda: labels.city(F.col("t"))) == [best(t) for t in texts]


def test_level_follows_priority(spark):
    words = [w for ws in vocab.LEVELS.values() for w in ws]
    texts = texts_of(words, 800, 3)
    want = [next((lv for lv, ws in vocab.LEVELS.items() if any(present(w, t) for w in ws)), None)
            if t else None for t in texts]
    got = evaluate(spark, texts, lambda: labels.rules_level(F.col("t"), F.lit(None)))
    assert got == want


def test_skills_consume_longest_first(spark):
    rng = random.Random(4)
    domains = [rng.sample([*vocab.SKILLS, "Other"], rng.randint(0, 4)) for _ in range(800)]
    texts = []
    for i, ds in enumerate(domains):
        words = [s for d in ds for s in vocab.SKILLS.get(d, [])] or ["Java"]
        texts += texts_of(words, 1, 100 + i)
    name = {s.lower(): s for ss in vocab.SKILLS.values() for s in ss}

    def want(ds, t):
        found = set()
        for d in ds:
            if d in vocab.SKILLS:
                options = "|".join(re.escape(s) for s in sorted(
                    vocab.SKILLS[d], key=len, reverse=True))
                found |= {m.group(1).lower() for m in re.finditer(
                    f"{BEFORE}({options}){AFTER}", t, re.IGNORECASE)}
        return sorted(name[f] for f in found)

    got = evaluate(spark, texts, lambda: labels.skills(F.col("t"), F.col("d")),
                   [(d,) for d in domains])
    assert got == [want(d, t) for d, t in zip(domains, texts)]


def test_shorter_keyword_behind_a_longer_one_is_kept(spark):
    ranked = [("b", "rare"), ("b a", "common")]
    got = evaluate(spark, ["b a", "x b", "ba"], lambda: first_label(F.col("t"), ranked))
    assert got == ["rare", "rare", None]
    assert sorted(covered(["scrum", "scrum master", "scrummer"])["scrum master"]) == [
        "scrum", "scrum master"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab.+ đ", min_size=1, max_size=5), min_size=1, max_size=8),
       st.text(alphabet="ab.+ đ", max_size=12))
def test_factored_pattern_equals_plain_alternation(words, text):
    plain = "|".join(re.escape(w) for w in sorted(set(words), key=len, reverse=True))
    mine = re.compile(f"({any_of(sorted(set(words)))})(?!a)")
    assert [m.group(1) for m in mine.finditer(text)] == [
        m.group(1) for m in re.finditer(f"({plain})(?!a)", text)]
