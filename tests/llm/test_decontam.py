"""Pieces found by q-grams against exhaustive alignment; runs of one character; the size of a full index."""

from __future__ import annotations

import pickle
import random
import tracemalloc

import numpy as np
from jobmart.llm import decontam


def least_edits(piece: str, text: str) -> int:
    """Least edits between a piece and any part of a text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(piece, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def pieces_of(item: str) -> list[str]:
    starts = {*range(0, max(1, len(item) - decontam.PIECE + 1), decontam.STRIDE), max(0, len(item) - decontam.PIECE)}
    return [item[s:s + decontam.PIECE] for s in starts]


def test_matches_equal_exhaustive_alignment():
    rng = random.Random(3)
    hit = 0
    for trial in range(30):
        letters = "ab" if trial % 5 == 0 else "abcdefgh "
        items = ["".join(rng.choice(letters) for _ in range(rng.choice([40, 70, 100, 104, 131]))) for _ in range(2)]
        if trial % 7 == 0:
            items[0] = "-" * 120
        text = list("".join(rng.choice(letters) for _ in range(rng.randint(0, 60))))
        part = rng.choice(items)
        start = rng.randint(0, max(0, len(part) - 100))
        copy = list(part[start:start + 110])
        for _ in range(rng.randint(0, 12)):
            at = rng.randrange(len(copy))
            copy[at:at + 1] = rng.choice([[], [rng.choice(letters)], [copy[at], "z"]])
        text = "".join(text + copy + ["q"] * rng.randint(0, 9))
        index = decontam.Index(list(enumerate(items)))
        got = {m["item_id"] for m in index.search([text])[0]}
        want = {i for i, item in enumerate(items) if any(least_edits(p, text) <= decontam.allowed(len(p)) for p in pieces_of(item))}
        assert got == want
        hit += bool(want)
    assert 8 < hit < 30


def test_runs_of_one_character_take_bounded_memory():
    index = decontam.Index([(1, "-" * 200), (2, "x" * 30 + "=" * 90)])
    text = "-" * 200_000 + "x" * 20 + "=" * 500
    tracemalloc.start()
    found = index.search([text])[0]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {m["item_id"] for m in found} >= {1} and most < 300e6


def test_a_full_index_is_small():
    rng = np.random.default_rng(5)
    items = [(i, "".join(map(chr, rng.integers(97, 123, 2000)))) for i in range(decontam.INDEX // 2000)]
    assert len(pickle.dumps(decontam.Index(items))) < 40e6


def test_no_items():
    index = decontam.Index([])
    assert index.search(["some text", ""]) == [[], []]
