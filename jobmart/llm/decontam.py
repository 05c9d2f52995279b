"""Benchmark passages in texts by q-gram lemma filtering and banded alignment.

An item counts as found if one of its pieces of ``PIECE`` characters (the whole item if it is shorter)
stands in a text with at most ``EDITS`` of its length in edits. Pieces begin every ``STRIDE`` characters, so any
``PIECE`` characters of an item are within ``STRIDE`` / 2 edits of a piece. Items shorter than ``SHORTEST`` must stand in
a text without an edit and between word borders. Letters A-Z compare in lower case and white space as blanks,
so positions are those of the text itself.

A piece of m characters found with e edits shares m + 1 - q(e + 1) q-grams with the text, on diagonals that
span e at most. Diagonals are counted in bands of 2(e + 1) that overlap by half, so one band holds the
whole alignment; bands below the bound are dropped, the others aligned by dynamic programming
inside the band, all bands of a batch at once.

Benchmarks are split by hash into indexes of about ``INDEX`` characters, each small enough to
broadcast; texts pass by one index after the other, without any shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmart.llm.common import add_columns

PIECE, STRIDE, EDITS, Q = 100, 10, 0.08, 10
#: Items with fewer characters must match exactly: with edits they would be found in clean texts.
SHORTEST = 40
#: Characters of one broadcast index, and of a text that are looked at together.
INDEX, CHUNK = 800_000, 1 << 20
#: Hits that are counted together; bounds a worker's memory.
HITS = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
MATCH = T.ArrayType(T.StructType().add("item_id", "long").add("start", "long").add("stop", "long").add("edits", "integer"))


def codes(text: str) -> np.ndarray:
    """Code points with A-Z in lower case and white space as blanks."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    c[(c >= 65) & (c <= 90)] += 32
    c[(c >= 9) & (c <= 13)] = 32
    return c


def grams(c: np.ndarray, q: int = Q) -> np.ndarray:
    """Hashes of all runs of ``q`` code points."""
    n = len(c) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    run, step, power, out, have = c.astype(np.uint64), 1, _ODD, None, 0
    while True:
        if q & step:
            if out is None:
                out, have = run, step
            else:
                m = len(c) - have - step + 1
                out, have = out[:m] * power + run[have:have + m], have + step
        if 2 * step > q:
            break
        run = run[:len(run) - step] * power + run[step:]
        power, step = np.uint64(int(power) ** 2 & 0xFFFFFFFFFFFFFFFF), 2 * step
    out = (out[:n] ^ (out[:n] >> np.uint64(31))) * _ODD
    return out ^ (out >> np.uint64(29))


def allowed(m: int, edits: float = EDITS, q: int = Q) -> int:
    """Edits in a piece of ``m`` characters: its share, but few enough for four common q-grams."""
    return max(0, min(int(edits * m), (m - 3) // q - 1))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


@cache
def _alnum() -> np.ndarray:
    return np.array([chr(x).isalnum() for x in range(0x110000)])


class Short:
    """Items that must match exactly, by length and a polynomial hash; hits are compared character by character."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.lengths: dict[int, tuple[np.ndarray, list[tuple[int, np.ndarray]]]] = {}
        for size in sorted({len(c) for _, c in items}):
            own = [(item, c) for item, c in items if len(c) == size]
            h = (np.array([c for _, c in own], np.uint64) * _powers(int(_ODD), size)).sum(axis=1, dtype=np.uint64)
            order = np.argsort(h, kind="stable")
            self.lengths[size] = h[order], [own[k] for k in order]

    def search(self, c: np.ndarray, first: bool, last: bool) -> Iterator[tuple[int, int, int]]:
        """(item, start, stop); ``first`` and ``last`` tell whether the text begins and ends with ``c``."""
        if not self.lengths or not len(c):
            return
        inside = _alnum()[c]
        border = np.concatenate([[first], ~(inside[1:] & inside[:-1]), [last]])
        starts = np.flatnonzero(border[:-1])
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(c * _powers(int(_ODD), len(c)), dtype=np.uint64)])
        back = _powers(pow(int(_ODD), -1, 1 << 64), len(c))[starts]
        for size, (hashes, items) in self.lengths.items():
            fits = np.searchsorted(starts, len(c) - size, side="right")
            at = starts[:fits]
            ends = border[at + size]
            at, h = at[ends], ((sums[at + size] - sums[at]) * back[:fits])[ends]
            low, high = np.searchsorted(hashes, h), np.searchsorted(hashes, h, side="right")
            for k in np.flatnonzero(low < high).tolist():
                start = int(at[k])
                for item, own in items[low[k]:high[k]]:
                    if (c[start:start + size] == own).all():
                        yield item, start, start + size


class Index:
    """The q-grams of all items, each place once: sorted hashes, and for each the places and the pieces over them."""

    def __init__(self, items: list[tuple[int, str]]):
        short, texts, names, first, at, sizes = [], [], [], [], [], []
        length = 0
        for item, text in items:
            c = codes(text or "")
            if len(c) < SHORTEST:
                c = codes(text.strip(" \t\n\v\f\r")) if text else c
                short += [(item, c)] if len(c) else []
                continue
            starts = sorted({*range(0, max(1, len(c) - PIECE + 1), STRIDE), max(0, len(c) - PIECE)})
            first.append(len(at))
            at += [length + x for x in starts]
            sizes += [min(PIECE, len(c))] * len(starts)
            names += [item] * len(starts)
            texts.append(c)
            length += len(c)
        self.short = Short(short)
        self.items, self.at = np.array(names, np.int64), np.array(at, np.int32)
        self.sizes = np.array(sizes, np.int64)
        self.edits = np.array([allowed(n) for n in sizes], np.int64)
        self.least = self.sizes + 1 - Q * (self.edits + 1)
        self.codes = np.concatenate([*texts, np.zeros(PIECE, np.uint32)]).astype(np.uint32)
        h, places, low, high = [], [], [], []
        begin = 0
        for text, one, after in zip(texts, first, [*first, len(at)][1:], strict=True):
            own = grams(text)
            place = begin + np.arange(len(own))
            starts, ends = self.at[one:after], self.at[one:after] + self.sizes[one:after] - Q
            h.append(own)
            places.append(place)
            low.append(one + np.searchsorted(ends, place))  # the pieces that hold the whole q-gram
            high.append(one + np.searchsorted(starts, place, side="right"))
            begin += len(text)
        h, places, low, high = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (h, places, low, high))
        order = np.argsort(h, kind="stable")
        h, places, low, high = h[order].astype(np.uint64), places[order], low[order], high[order]
        # Places one after another with the same q-gram (equal characters) are one entry.
        new = np.concatenate([np.ones(min(1, len(h)), bool), (h[1:] != h[:-1]) | (places[1:] != places[:-1] + 1) | (low[1:] >= high[:-1])])
        begin, end = np.flatnonzero(new), np.flatnonzero(np.append(new[1:], True)) if len(h) else np.zeros(0, np.int64)
        self.place, self.last = places[begin].astype(np.int32), places[end].astype(np.int32)
        self.low, self.high = low[begin].astype(np.int32), high[end].astype(np.int32)
        self.hashes, start, count = np.unique(h[begin], return_index=True, return_counts=True)
        self.first, self.count = start.astype(np.int32), count.astype(np.int32)
        hits = (self.high - self.low).astype(np.int64) * (1 + np.minimum(self.last - self.place, PIECE) // 4)
        self.pieces = (np.minimum(np.add.reduceat(hits, start), HITS) if len(start) else hits).astype(np.int32)
        self.near = np.zeros(1 << 22, bool)
        self.near[self.hashes >> np.uint64(42)] = True

    def bands(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece, first diagonal) of the bands of a text that meet the bound.

        A place of the text counts once in a band, however often its q-gram stands in the piece. Places are worked
        on in runs of about ``HITS`` hits, so equal characters cost time, not memory.
        """
        h = grams(c)
        at = np.flatnonzero(self.near[h >> np.uint64(42)]) if len(self.hashes) else h[:0].astype(np.int64)
        k = np.searchsorted(self.hashes, h[at])
        ok = self.hashes[np.minimum(k, len(self.hashes) - 1)] == h[at] if len(at) else np.zeros(0, bool)
        at, k = at[ok], k[ok]
        keys, counts, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        run = np.cumsum(self.pieces[k], dtype=np.int64) // HITS
        edges = np.concatenate([[0], np.flatnonzero(np.diff(run)) + 1, [len(at)]]) if len(at) else [0]
        for i, j in zip(edges, edges[1:], strict=False):
            key, shared = np.unique(self._hits(at[i:j], k[i:j]), return_counts=True)
            keys.append(key)
            counts.append(shared)
            held += len(key)
            if held > 4 * HITS:
                keys, counts = map(list, zip(_summed(keys, counts), strict=True))
                held = 0
        key, shared = _summed(keys, counts)
        piece = key >> 32
        enough = shared >= self.least[piece]
        piece, band = piece[enough], (key & 0xFFFFFFFF)[enough] - 1
        return piece, band * (self.edits[piece] + 1) - PIECE

    def _hits(self, at: np.ndarray, k: np.ndarray) -> np.ndarray:
        """piece << 32 | band + 1 of all hits at places ``at`` with the hashes numbered ``k``, once for each place and band."""
        entry, of = _spread(self.first[k], self.count[k])
        text = at[of]
        piece, of = _spread(self.low[entry], self.high[entry] - self.low[entry])
        text, entry = text[of], entry[of]
        begin = np.maximum(self.place[entry], self.at[piece]) - self.at[piece]
        end = np.minimum(self.last[entry] - self.at[piece], self.sizes[piece] - Q)
        width = self.edits[piece] + 1
        lowest = (text - end + PIECE) // width  # diagonals begin at 1 - PIECE
        band, of = _spread(lowest, (text - begin + PIECE) // width - lowest + 1)
        text, piece = text[of], piece[of]
        order = np.lexsort((band, piece, text))
        text, piece, band = text[order], piece[order], band[order]
        other = np.concatenate([np.ones(min(1, len(band)), bool), (text[1:] != text[:-1]) | (piece[1:] != piece[:-1])])
        new = other.copy()
        new[1:] |= band[1:] != band[:-1]
        text, piece, band, other = text[new], piece[new], band[new], other[new]
        alone = other.copy()  # whether the band below is not among the place's own
        alone[1:] |= band[1:] - 1 != band[:-1]
        return np.concatenate([piece << 32 | band + 1, piece[alone] << 32 | band[alone]])

    def align(self, piece: np.ndarray, low: np.ndarray, texts: list[np.ndarray], text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least edits of each piece in its band and where in the text that alignment ends."""
        width = 2 * (int(self.edits[piece].max()) + 1)
        span = np.zeros((len(piece), PIECE + width), np.int64) - 1  # -1 equals no character
        for i, (k, a) in enumerate(zip(text.tolist(), low.tolist(), strict=True)):
            part = texts[k][max(0, a):max(0, a + span.shape[1])]
            span[i, max(0, -a):max(0, -a) + len(part)] = part
        steps = np.arange(width)
        inside = steps < 2 * (self.edits[piece, None] + 1)
        d = np.where(inside, 0, 999)
        best, end = np.full(len(piece), 999), np.zeros(len(piece), np.int64)
        for i in range(1, int(self.sizes[piece].max()) + 1):
            differ = span[:, i - 1:i - 1 + width] != self.codes[self.at[piece] + i - 1][:, None]
            up = np.concatenate([d[:, 1:], np.full((len(d), 1), 999)], axis=1) + 1
            d = np.minimum(d + differ, up)
            d = np.where(inside, np.minimum.accumulate(d - steps, axis=1) + steps, 999)
            done = self.sizes[piece] == i
            if done.any():
                k = d[done].argmin(axis=1)
                best[done], end[done] = d[done][np.arange(len(k)), k], low[done] + k + i
        return best, end

    def search(self, texts: list[str]) -> list[list[dict]]:
        """For each text its matches, one per item: where the first and last piece stand, least edits."""
        found: list[dict[int, dict]] = [{} for _ in texts]
        for group in _chunks(texts):
            chars, pieces, lows, owners = [], [], [], []
            for k, (text, offset, c) in enumerate(group):
                for item, start, stop in self.short.search(c, not offset, offset + len(c) == len(texts[text])):
                    _add(found[text], item, start + offset, stop + offset, 0)
                piece, low = self.bands(c)
                chars.append(c)
                pieces.append(piece)
                lows.append(low)
                owners.append(np.full(len(piece), k))
            piece, low, owner = map(np.concatenate, (pieces, lows, owners))
            for i in range(0, len(piece), 20_000):
                part = slice(i, i + 20_000)
                edits, end = self.align(piece[part], low[part], chars, owner[part])
                for p, k, e, stop in zip(piece[part], owner[part], edits, end, strict=True):
                    if e <= self.edits[p]:
                        text, offset, _ = group[k]
                        stop = int(stop) + offset
                        _add(found[text], int(self.items[p]), max(0, stop - int(self.sizes[p])), stop, int(e))
        return [[m for _, m in sorted(x.items())] for x in found]


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of ``count`` numbers from ``first`` on, one after another, and to which range each belongs."""
    count = np.maximum(count, 0).astype(np.int64)
    of = np.repeat(np.arange(len(count)), count)
    return np.repeat(first.astype(np.int64) - np.cumsum(count) + count, count) + np.arange(len(of)), of


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(at, np.concatenate(counts), len(key)).astype(np.int64)


def _add(found: dict[int, dict], item: int, start: int, stop: int, edits: int) -> None:
    m = found.setdefault(item, {"item_id": item, "start": start, "stop": stop, "edits": edits})
    m |= {"start": min(m["start"], start), "stop": max(m["stop"], stop), "edits": min(m["edits"], edits)}


def _chunks(texts: list[str]) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Groups of (text, offset, characters) of about ``CHUNK`` characters; long texts in overlapping parts."""
    group, size = [], 0
    for k, x in enumerate(texts):
        for start in range(0, max(1, len(x)), CHUNK):
            group.append((k, start, codes(x[start:start + CHUNK + 4 * PIECE])))
            size += len(group[-1][2])
            if size >= CHUNK:
                yield group
                group, size = [], 0
    if group:
        yield group


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "matches", index: int = INDEX) -> DataFrame:
    """Append the benchmark items found in each whole text: array of (item_id, start, stop, edits).

    ``benchmark``: item_id, text. ``stop`` is where the alignment of the last piece ends, ``start`` that of the first
    less its length. Null texts have none; null, blank and repeated items add none.
    """
    total = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-total // index) or 1
    fields = T.StructType().add(out, MATCH)
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("edits", pa.int32())]))
    rows = benchmark.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    for part in range(parts):
        own = rows.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == part) if parts > 1 else rows
        items = [(r.item_id, r.text) for r in own.orderBy("item_id", "text").collect()]  # about `index` characters
        shared = docs.sparkSession.sparkContext.broadcast(Index(items))

        def make(shared=shared):
            def run(texts: pa.Array) -> list[pa.Array]:
                return [pa.array(shared.value.search([x or "" for x in texts.to_pylist()]), kind)]
            return run

        name = out if part == 0 else "more matches"
        docs = add_columns(docs, text, fields if part == 0 else T.StructType().add(name, MATCH), make)
        if part:
            docs = docs.withColumn(out, F.concat(out, F.col(f"`{name}`"))).drop(name)
    return docs
