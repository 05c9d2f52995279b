"""Dictionary joins against the compiled matcher, in both kinds of join."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from jobmart import vocab
from jobmart.functions import labels
from jobmart.functions.matching import all_labels
from jobmart.operators import dictionary as D

WORDS = {"A": ["c", "c++", "node.js", " Unit Test ", ""], "B": [".net", "node", "ci/cd"], "C": ["é", "ội", "test"]}
TEXTS = ["C++ and c", "c++x", "Node.JS, unit  test; unit test", "asp.net .NET", "(ci/cd)", "xnode", "Hà Nội é", "", None,
         "c" * 5000, "node.js" * 3, "c c c " * 2000, "\n.net", "test.", "nodé"]


@pytest.fixture(params=[True, False], ids=["broadcast", "shuffled"])
def small(request, monkeypatch):
    if not request.param:
        monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    return request.param


def test_labels_equal_the_compiled_matcher(spark, small):
    texts = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    want = {r.id: r.w or [] for r in texts.select("id", all_labels(F.lower("text"), WORDS).alias("w")).collect()}
    found = D.labels_by_join(texts, "id", "text", D.table(spark, WORDS))
    assert {r.id: r.labels for r in found.collect()} == want
    plan = D.hits(texts, "id", "text", D.table(spark, WORDS))._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == small


def test_skills_equal_the_compiled_matcher(spark, small):
    rng = random.Random(1)
    names = [n for v in vocab.SKILLS.values() for n in v]
    rows = [(i, rng.choice([" ", ", ", "/", ""]).join(rng.choices(names, k=rng.randint(0, 12)))) for i in range(60)]
    texts = spark.createDataFrame(rows + [(100, None), (None, "Python")], "id int, text string")
    own = F.array(*[F.lit(d) for d in sorted(vocab.SKILLS)][::2])
    domains = texts.select("id", own.alias("labels"))
    want = texts.select("id", labels.skills(F.col("text"), own).alias("w"))
    found = D.skills_by_join(texts, "id", "text", D.table(spark, vocab.SKILLS), domains)
    assert {r.id: r.skills for r in found.collect()} == {r.id: r.w or [] for r in want.collect()}


def test_a_hundred_thousand_keywords(spark, small):
    words = spark.range(100_000).select(F.concat(F.lit("label "), F.col("id") % 7).alias("label"), F.concat(F.lit("key"), "id", F.lit(" word")).alias("keyword"))
    texts = spark.createDataFrame([(1, "KEY99999 word, key8 word"), (2, "key100000 word key12 words"), (3, "key12")], "id int, text string")
    got = {r.id: r.labels for r in D.labels_by_join(texts, "id", "text", words, "none").collect()}
    assert got == {1: sorted({f"label {99999 % 7}", "label 1"}), 2: ["none"], 3: ["none"]}


def test_empty_dictionary_and_texts_and_repeated_keys(spark):
    none = D.table(spark, {})
    texts = spark.createDataFrame([(1, "c"), (1, ".net"), (None, "c")], "id int, text string")
    assert {r.id: r.labels for r in D.labels_by_join(texts, "id", "text", none).collect()} == {1: [], None: []}
    got = {r.id: r.labels for r in D.labels_by_join(texts, "id", "text", D.table(spark, WORDS)).collect()}
    assert got == {1: ["A", "B"], None: ["A"]}
    assert D.labels_by_join(texts.where("false"), "id", "text", D.table(spark, WORDS)).count() == 0


def test_texts_stay_where_they_are_for_a_small_dictionary(spark):
    texts = spark.range(10).select("id", F.lit("c").alias("text"))
    plan = D.hits(texts, "id", "text", D.table(spark, WORDS))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id" not in plan and "SortMergeJoin" not in plan


def test_sizes_of_the_dictionaries():
    assert (len(vocab.SKILLS), sum(map(len, vocab.SKILLS.values()))) == (23, 249)
    assert (len(vocab.DOMAINS), sum(map(len, vocab.DOMAINS.values()))) == (23, 151)
    assert (len(vocab.LOCATIONS), sum(map(len, vocab.LOCATIONS.values()))) == (35, 157)
    assert (len(vocab.LEVELS), sum(map(len, vocab.LEVELS.values()))) == (7, 30)


@pytest.mark.parametrize("prefix_rows", [0, 50_000])
def test_places_where_no_keyword_begins_are_not_joined(spark, monkeypatch, prefix_rows):
    monkeypatch.setattr(D, "PREFIX_ROWS", prefix_rows)
    words = spark.createDataFrame([("a", "longer"), ("a", "longest way"), ("b", "lonely+"), ("b", "ärger-net")], "label string, keyword string")
    texts = spark.createDataFrame([(1, "the Longest way is longer, a lon lonely+ way (ÄRGER-NET) longe longers")], "id int, text string")
    joined = D.hits(texts, "id", "text", words)
    assert sorted((r._at, r.keyword, r._span) for r in joined.collect()) == [
        (1, "longest way", 2), (4, "longer", 1), (7, "lonely+", 1), (10, "ärger-net", 2)]
    begins = D._beginning(D.entries(words), {"n": 4, "run": 5})
    pattern = rf"{D._START}(?=((?={begins})[\s\S]{{1,12}})?)"
    places = texts.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(pattern), F.lit(1))).alias("p"))
    assert 0 < places.where("p != ''").count() < places.count()
