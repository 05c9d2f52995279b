"""Packing against the tokenizer: each id once, full windows, neighbours by a plain BM25."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobmart.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def texts() -> list[str | None]:
    rng = random.Random(3)
    words = "the of river bank money loan water fish tree code data model train é über 12 x-y".split()
    out = [None, "", " \n ", "one", "river " * 9000, "same text " * 5]
    out += [" ".join(rng.choices(words, k=rng.randint(1, 400))) for _ in range(120)]
    return out + ["same text " * 5] * 40


def whole(rows, docs, window):
    """Every piece lies where it says, sequences are gapless and full or a power of two."""
    tokenizer = Tokenizer.from_file(PATH)
    want = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in docs}
    of_doc, of_sequence = {}, {}
    for r in rows:
        assert r.doc_tokens == len(want[r.doc_id]) and r.length > 0
        ids = want[r.doc_id][r.start:r.start + r.length]
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        of_doc.setdefault(r.doc_id, []).append((r.start, r.length))
        of_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(of_doc) == set(want)
    for i, pieces in of_doc.items():
        assert sum(n for _, n in pieces) == len(want[i])
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(pieces), sorted(pieces)[1:]))
    short = 0
    for pieces in of_sequence.values():
        pieces.sort()
        assert pieces[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:]))
        total = sum(pieces[-1])
        assert total == window or total < window and total & (total - 1) == 0
        short += total < window
    return short


@pytest.mark.parametrize("window, docs_in_shard", [(2048, 4096), (256, 7), (64, 1)])
def test_each_id_in_one_piece_of_a_full_window(spark, monkeypatch, window, docs_in_shard):
    monkeypatch.setattr(packing, "SHARD_DOCS", docs_in_shard)
    monkeypatch.setattr(packing, "KEYED", 3)
    docs = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, IDS string, start int").repartition(3)
    rows = packing.pack(df, PATH, end=1, window=window).collect()
    short = whole(rows, docs, window)
    assert short <= 4 * int(math.log2(window))  # at the end of each task only
    assert packing.pack(df.where("false"), PATH, end=1).count() == 0


def test_repeated_and_null_ids_and_crc(spark):
    df = spark.createDataFrame([(None, "a b"), (None, None), (1, "a b"), (1, "c")], "doc_id long, text string")
    rows = packing.pack(df, PATH, end=1).withColumn("crc", F.crc32("ids")).collect()
    assert sorted((r.doc_id is None, r.doc_tokens) for r in rows if r.start == 0) == [(False, 2), (False, 3), (True, 1), (True, 3)]
    assert sum(r.length for r in rows) == 9
    assert all(r.crc == zlib.crc32(r.ids) for r in rows)


def test_statistics_cover_all_documents(spark):
    df = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string").repartition(4)
    found, docs, mean = packing.statistics(packing.encode(df, PATH, 1))
    tokenizer = Tokenizer.from_file(PATH)
    ids = [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts()]
    assert docs == len(ids) and mean == pytest.approx(sum(map(len, ids)) / docs)
    for i in {x for row in ids for x in row}:
        assert found[i] == sum(i in set(row) for row in ids)


def test_neighbours_are_those_of_plain_bm25():
    rng = random.Random(5)
    docs = [np.array([rng.randint(0, 40) for _ in range(rng.randint(1, 20))], "<u2") for _ in range(200)]
    df = np.array([sum(t in d for d in docs) for t in range(41)])
    idf, mean = packing.inverse(df, len(docs)), sum(map(len, docs)) / len(docs)
    shard = packing.Shard(docs, idf, mean)
    shard.unused[[3, 9, 50]] = False
    for seed in (0, 3, 77):
        terms = set(docs[seed].tolist())  # at most 20, all are looked up
        score = {}
        for d, ids in enumerate(docs):
            s = sum(float(idf[t]) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(ids) / mean)) for t in terms if (c := ids.tolist().count(t)))
            if s and shard.unused[d]:
                score[d] = s
        got = shard.neighbours(seed).tolist()
        best = sorted(score.values(), reverse=True)[:packing.NEIGHBOURS]
        assert [score[d] for d in got] == pytest.approx(best, rel=1e-5)


def test_windows_hold_neighbours():
    """Two kinds of documents in turn: each window has one kind, but for the one where they meet."""
    kinds = [np.array([10 + k, 20 + k, 30 + k, 1], "<u2") for k in (0, 1)]
    docs = [kinds[i % 2] for i in range(64)]
    df = np.bincount(np.concatenate(docs), minlength=32) > 0
    shard = packing.Shard(docs, packing.inverse(np.where(df, 32, 0), 64), 4.0)
    packer = packing.Packer(0, 16)
    for _ in packing.fill(shard, docs, list(range(64)), packer):
        pass
    packer.finish()
    mixed = sum(len({r[0] % 2 for r in packer.rows if r[4] == s}) > 1 for s in range(packer.sequence))
    assert len(packer.rows) == 64 and mixed <= 1
