"""Token counts of whole texts from a table of frequent pre-tokens and worker caches.

A pre-token is a run of blanks with what follows up to the next blank. No piece of the model holds
a blank behind another character, so pre-tokens are encoded independently and their counts add up;
``check_model`` refuses a model for which that does not hold.

Tier 1: every partition counts its pre-tokens, keeps a bounded summary of the most frequent, and
summaries merge in a tree; no pre-token is shuffled by key. The winners' lengths travel as a
compact open-addressing table, a few hundred kB whatever the corpus; the distinct pre-tokens of a
batch probe it together in numpy. Tier 2: other pre-tokens are encoded by the library in one batch and kept in
the worker's cache. Both tiers decide speed only, never a count.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmart.llm.common import add_columns, pieces

#: Pre-tokens of tier 1, entries of a partition's summary, and entries of a worker's cache.
FREQUENT, SUMMARY, CACHE = 8_192, 16_384, 300_000
#: Characters of the texts that are looked up together, and of the longest pre-token that is cached.
TOGETHER, LONGEST = 1_000_000, 64
BLANK = "▁"
_PIECES = re.compile(" +[^ ]*")


def check_model(data: bytes) -> sentencepiece.SentencePieceProcessor:
    model = sentencepiece.SentencePieceProcessor(model_proto=data)
    pieces = map(model.id_to_piece, range(model.vocab_size()))
    if any(BLANK in p.lstrip(BLANK) for p in pieces):
        raise ValueError("the model has pieces that span blanks")
    probe = "  a ﬁ  "  # identity normalisation, a leading blank added
    if model.encode(probe, out_type=str) and model.decode(model.encode(probe)) != probe:
        raise ValueError("the model normalises texts")
    if model.piece_to_id(BLANK) == model.unk_id():
        raise ValueError("the model has no piece for a blank")
    return model


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens without their first blank: the model puts one before every text by itself."""
    text = text.replace(BLANK, " ")
    parts = text.split(" ")
    if "" in parts:
        return [p[1:] for p in _PIECES.findall(" " + text)] if text else []
    return parts


class LengthTable:
    """Open addressing by a 64-bit hash, at most half of the slots taken: of each slot the hash, the pre-token and its number of tokens."""

    def __init__(self, lengths: dict[str, int]):
        self.size = 1 << max(4, (2 * len(lengths)).bit_length())
        self.hashes, self.lengths = np.zeros(self.size, np.uint64), np.full(self.size, -1, np.int32)
        keys: list[str | None] = [None] * self.size
        for key, n in lengths.items():
            h = xxhash.xxh3_64_intdigest(key)
            slot = h & (self.size - 1)
            while keys[slot] is not None:
                slot = (slot + 1) & (self.size - 1)
            self.hashes[slot], self.lengths[slot], keys[slot] = h, n, key
        self.keys = pa.array(keys, pa.string())

    def find(self, words: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """The number of tokens of each word, -1 where the table lacks it. All words probe at once, slot after slot."""
        out = np.full(len(words), -1, np.int64)
        slot = (hashes & np.uint64(self.size - 1)).astype(np.int64)
        left = np.arange(len(words))
        while True:
            left = left[self.lengths[slot[left]] >= 0]  # an empty slot ends a search
            if not len(left):
                return out
            hit = left[self.hashes[slot[left]] == hashes[left]]
            same = pc.equal(self.keys.take(pa.array(slot[hit])), words.take(pa.array(hit))).to_numpy(zero_copy_only=False).astype(bool)
            out[hit[same]] = self.lengths[slot[hit[same]]]
            left = left[out[left] < 0]
            slot[left] = (slot[left] + 1) & (self.size - 1)


def frequent(df: DataFrame, text: str, n: int = FREQUENT, summary: int = SUMMARY) -> list[str]:
    """The most frequent pre-tokens of all texts, from summaries of at most ``summary`` entries."""

    def cut(counts: Counter) -> Counter:
        return counts if len(counts) <= summary else Counter(dict(counts.most_common(summary)))

    def count(batches):
        counts: Counter = Counter()
        for b in pieces(batches):
            for x in b.column(0).to_pylist():
                if x:
                    counts.update(pre_tokens(x))
                    if len(counts) > 8 * summary:
                        counts = cut(counts)
        counts = cut(counts)
        yield pa.RecordBatch.from_arrays([pa.array([list(counts)], pa.list_(pa.string())), pa.array([list(counts.values())], pa.list_(pa.int64()))], ["words", "n"])

    def merge(a: Counter, b: Counter) -> Counter:
        a.update(b)
        return cut(a)

    summaries = df.select(F.col(f"`{text}`").cast("string")).mapInArrow(count, "words array<string>, n array<long>")
    total = summaries.rdd.map(lambda r: Counter(dict(zip(r.words, r.n, strict=True)))).treeAggregate(Counter(), merge, merge, depth=2)
    return [k for k, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:n]]


class Tiers:
    """Both tiers of a worker: the table, and a cache of what the library was asked for."""

    def __init__(self, model: bytes, table: LengthTable):
        self.model, self.table, self.cache = sentencepiece.SentencePieceProcessor(model_proto=model), table, {}

    def lengths(self, words: pa.Array) -> np.ndarray:
        """The number of tokens of each of distinct words."""
        every = words.to_numpy(zero_copy_only=False).tolist()
        out = self.table.find(words, np.fromiter(map(xxhash.xxh3_64_intdigest, every), np.uint64, len(every)))
        missing = np.flatnonzero(out < 0)
        asked = [every[i] for i in missing.tolist()]
        found = list(map(self.cache.get, asked))
        new = [w for w, x in zip(asked, found, strict=True) if x is None]
        if new:
            known = dict(zip(new, map(len, self.model.encode(new, num_threads=1)), strict=True))
            found = [known[w] if x is None else x for w, x in zip(asked, found, strict=True)]
            if len(self.cache) > CACHE:
                self.cache.clear()
            self.cache.update((k, v) for k, v in known.items() if len(k) <= LONGEST)
        out[missing] = found
        return out

    def count(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text."""
        parts = list(map(pre_tokens, texts))
        words = pa.array([p for own in parts for p in own], pa.string()).dictionary_encode()
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        upto = np.concatenate([[0], np.cumsum(self.lengths(words.dictionary)[words.indices.to_numpy()])])
        return np.diff(upto[np.concatenate([[0], ends])])


_workers: dict[int, tuple] = {}


def _groups(texts: list[str]):
    """Texts of about ``TOGETHER`` characters at a time."""
    group, size = [], 0
    for x in texts:
        group.append(x)
        size += len(x)
        if size >= TOGETHER:
            yield group
            group, size = [], 0
    if group:
        yield group


def count_tokens(df: DataFrame, model_path: str, text: str = "text", limit: int = 4096) -> DataFrame:
    """Append n_bytes, n_tokens (long) and over_limit of each whole text; a null text counts as empty."""
    with open(model_path, "rb") as f:
        data = f.read()
    model = check_model(data)
    keys = frequent(df, text)
    lengths = {k: len(x) for k, x in zip(keys, model.encode(keys, num_threads=1), strict=True)} if keys else {}
    lengths[""] = 1  # a single blank at the end of a text is one token, though the library gives an empty text none
    shared = df.sparkSession.sparkContext.broadcast((data, LengthTable(lengths)))

    def make():
        key = id(shared.value)
        if key not in _workers:
            _workers.clear()
            _workers[key] = (Tiers(*shared.value), shared.value)
        tiers = _workers[key][0]

        def run(texts: pa.Array) -> list[pa.Array]:
            whole = [x or "" for x in texts.to_pylist()]
            n_tokens = np.concatenate([np.zeros(0, np.int64), *map(tiers.count, _groups(whole))])
            n_bytes = [len(x.encode("utf-8", "surrogatepass")) for x in whole]
            return [pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(n_tokens > limit, pa.bool_())]
        return run

    fields = T.StructType().add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")
    return add_columns(df, text, fields, make)
