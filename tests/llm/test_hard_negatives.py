"""The tree search against brute force: clusters, copies, odd rows, repeated ids."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobmart.llm import hard_negatives as H


def table(n: int, dims: int, seed: int, spread: float = 0.3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        rows.append((i, [x + rng.gauss(0, spread) for x in c], rng.randint(0, 4)))
    return rows


def brute(rows, step=10, positives=5, negatives=10):
    kept = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    def score(a, b):
        return sum(x * y for x, y in zip(a, b))
    out, seen = [], set()
    for i, label, v in kept:
        if i % step or (i, label, tuple(v)) in seen:
            continue
        seen.add((i, label, tuple(v)))
        order = sorted((-score(v, w), j, other) for j, other, w in kept if j != i)
        for ps, p, _ in [x for x in order if x[2] == label][:positives]:
            fit = [x for x in order if x[2] != label and -30 * ps <= -100 * x[0] <= -90 * ps][:negatives]
            out += [(i, p, k + 1, n, -ps, -s) for k, (s, n, _) in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, step=10):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = H.mine(H.prepare(df.withColumn("score", F.lit("x")), "vec_id", "label", "embedding", 256), F.col("id") % step == 0, 5, 10, 30, 90)
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("part, sample, queries", [(8192, 4096, 512), (60, 128, 7)])
def test_against_brute_force(spark, monkeypatch, part, sample, queries):
    monkeypatch.setattr(H, "PART", part)
    monkeypatch.setattr(H, "SAMPLE", sample)
    monkeypatch.setattr(H, "QUERIES", queries)
    monkeypatch.setattr(H, "LEAF", 8)
    monkeypatch.setattr(H, "BLOCKS", 3)
    rows = table(600, 8, 1)
    rows += [(1000 + i, rows[3][1], i % 5) for i in range(150)]  # copies of one vector
    rows += [(20, rows[20][1], rows[20][2]), (20, rows[21][1], 1), (-40, rows[5][1], 2)]  # repeated and negative ids
    rows += [(None, [1.0] * 8, 1), (2000, None, 1), (2010, [1.0] * 8, None), (2020, [float("nan")] + [0.0] * 7, 1),
             (2030, [float("inf")] * 8, 1), (2040, [None, 1.0], 1), (2050, [], 1), (2060, [0.5, 0.5], 3), (2070, [0.0] * 8, 3)]
    assert mined(spark, rows) == brute(rows)


def test_few_rows_and_none(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0, 2.0], 1)]) == []
    two = [(0, [1.0, 0.0], 1), (1, [1.0, 0.5], 1), (2, [0.5, 0.0], 2)]
    assert mined(spark, two) == brute(two) != []


def test_large_products_are_exact():
    a = np.array([[2**30 + 1, 3], [5, 2**30 - 7]], np.int64)
    assert H.products(a, a, False).tolist() == [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in a] for r in a]


def test_search_leaves_out_subtrees_and_loses_nothing():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 6)) * 300
    x = np.floor(np.repeat(centres, 100, 0) + rng.normal(size=(2000, 6)) * 5)
    longest = float(np.sqrt((x * x).sum(1).max()))
    space = H.Space(6, longest, True, len(x))
    tree, leaves = H.grow(space.augmented(x), 32)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(2000))
    row = {"block": 0, "ids": np.arange(4).tobytes(), "labels": np.zeros(4, np.int64).tobytes(), "vectors": x[:4].astype("<i8").tobytes(), "slots": 0, "low": None, "high": None}
    wanted, looked = H.Wanted(space, row, 5), []

    def visit(leaf, which):
        looked.append(len(leaves[leaf]) * len(which))
        wanted.score(which, leaves[leaf], np.zeros(len(leaves[leaf]), np.int64), x[leaves[leaf]])
        wanted.best.first()

    H.search(tree, x[:4], longest, wanted.annulus, visit)
    slots, scores, ids = wanted.best.first()
    for k in range(4):
        want = sorted((-s, j) for j, s in enumerate((x @ x[k]).tolist()) if j != k)[:5]
        assert [(-s, j) for s, j in zip(scores[slots == k].tolist(), ids[slots == k].tolist())] == want
    assert sum(looked) < 0.5 * 4 * len(x)
    assert H.Tree.unpacked(tree.packed()).child.tolist() == tree.child.tolist()
