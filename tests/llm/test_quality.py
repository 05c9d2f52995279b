"""Quality model: counting in Spark against counting here, calibration, odd inputs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobmart.llm import quality


def rows(n: int = 300, seed: int = 2):
    rng = random.Random(seed)
    words = {0: "river stone meadow light garden song".split(), 1: "buy cheap click win now free".split(), 2: "hate kill stupid idiot filth scum".split()}
    out = []
    for i in range(n):
        k = rng.choice([0, 0, 1, 2])
        body = [rng.choice(words[k] if rng.random() < 0.5 else "the a of and to in was it on as with by".split()) + str(rng.randrange(30)) * (rng.random() < .6) for _ in range(120)]
        out.append((i, " ".join(body), int(k != 1), int(k == 2)))
    return out


def test_features_are_those_counted_at_once(spark, monkeypatch):
    monkeypatch.setattr(quality, "CHI_SQUARE", 4.0)
    df = spark.createDataFrame(rows(), "doc_id long, text string, quality int, toxic int").repartition(4)
    sampled = df.withColumns({"kind": F.expr("case when toxic = 1 then 2 when quality = 0 then 1 else 0 end"), "fold": (F.col("doc_id") % 3).cast("int")})
    got = sampled.collect()
    totals = np.zeros((3, 3), np.int64)
    for r in got:
        totals[r.fold, r.kind] += 1
    names = quality._choose(sampled, totals)
    ids = {r.doc_id: np.unique(quality.features(r.text.encode())) for r in got}
    for fold, trait in [(-1, 0), (-1, 1), (0, 0), (2, 1)]:
        part = [r for r in got if r.fold != fold and (trait == 1 or r.kind != 2)]
        y = np.array([r.kind == trait + 1 for r in part])
        every, at = np.unique(np.concatenate([ids[r.doc_id] for r in part]), return_inverse=True)
        truth = np.repeat(y, [len(ids[r.doc_id]) for r in part])
        n, n1 = np.bincount(at), np.bincount(at[truth], minlength=len(every))
        expected = n * y.sum() / len(y)
        chi = (n1 - expected) ** 2 / (expected * (1 - y.mean()) * (1 - n / (len(y) + 1)))
        assert names[fold, trait].tolist() == every[(chi >= 4.0) & (n >= quality.LEAST)].tolist()


def test_held_out_verdicts_and_bounded_curves(spark):
    df = spark.createDataFrame(rows(900), "doc_id long, text string, quality int, toxic int").repartition(4)
    model = quality.fit(df.select("doc_id", "text"), df.where("doc_id < 500").select("doc_id", "quality", "toxic"), sample=450)
    assert (model.slope >= 0.05).all() and (model.slope < 20).all() and (abs(model.offset) < 50).all()
    held = quality.judge(df.where("doc_id >= 500").select("doc_id", "text"), model).collect()
    clean = {i for i, _, fine, toxic in rows(900) if fine and not toxic}
    good = [r.kept for r in held if r.doc_id in clean]
    bad = [r.kept for r in held if r.doc_id not in clean]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.05


@pytest.mark.parametrize("few", [1, 5, 40, 240])
def test_calibration_of_scores_that_tell_classes_apart(few):
    rng = np.random.default_rng(few)
    for gap in (0.5, 3, 30, 3000):
        z = np.concatenate([rng.normal(-gap, 1, 480), rng.normal(gap, 1, few)])
        y = np.repeat([0.0, 1.0], [480, few])
        slope, offset = quality._calibrate(z, y)
        p = 1 / (1 + np.exp(-np.clip(slope * z + offset, -500, 500)))
        assert 0.05 <= slope < 20 and abs(offset) < 200
        assert abs(p.mean() - y.mean()) < 0.02


def test_null_labels_repeated_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(1, None), (1, "a b"), (None, "x"), (2, "")] + [(i, "w " * 60 + str(i)) for i in range(3, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(40)] + [(5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    first = quality.fit(docs, labels)
    again = quality.fit(docs.repartition(5), labels.repartition(3))
    assert first.ids.tolist() == again.ids.tolist() and np.allclose(first.weights, again.weights)
    assert quality.judge(docs, first).count() == docs.count()
    for d, x in ((docs.where("false"), labels), (docs, labels.where("false"))):
        model = quality.fit(d, x)
        assert quality.judge(docs, model).where("doc_id > 2 and not base_failed and kept").count() == quality.judge(docs, model).where("doc_id > 2 and not base_failed").count()
    assert quality.judge(docs.where("false"), first).count() == 0


def test_measures_against_regular_expressions():
    rng = random.Random(4)
    for _ in range(400):
        text = "".join(rng.choice("ab #*$é \n\n \t") for _ in range(rng.randint(0, 80)))
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        inside = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
        assert quality.measures(text) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))
