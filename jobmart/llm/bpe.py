"""Byte-level BPE encoding and decoding.

Each pattern match of a text is encoded by itself. Its bytes, read as Latin-1, go through an
Aho-Corasick automaton of all tokens; the encoder takes the longest token at a position, steps back
to the next shorter one where no valid continuation exists, and accepts a token only if merging
would leave the border between it and its predecessor alone. That test undoes the merges on both
sides of the border and is memoised per pair of tokens, so the work is linear in the bytes.

A pattern match that is a token itself is that token, as in the tiktoken library. Tokens that the
merges can't build take part in that way only.
"""

from __future__ import annotations

import base64

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from jobmart.llm.common import ROWS, add_columns

#: Entries of a worker's memory of pattern matches and of token pairs; of either generation.
MEMORY = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[int, int] | None:
    """The two tokens that merging joins last to build this one; None if it never builds it."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        joins = [ranks.get(parts[i] + parts[i + 1], len(ranks) + 999) for i in range(len(parts) - 1)]
        best = min(joins)
        if best >= ranks[token]:
            return None
        i = joins.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return ranks[parts[0]], ranks[parts[1]]


_coders: dict[str, object] = {}


class Vocabulary:
    """Tokens with their last merges; made on the driver and broadcast (bounded by the rank file)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self.merges = {r: pair for t, r in ranks.items() if len(t) > 1 and (pair := _last_merge(t, ranks))}

    def coder(self) -> Coder:
        """The worker's own coder, kept for later tasks; a worker has one at a time."""
        if _coders.get("of") is not self:
            _coders.clear()
            _coders.update({"of": self, "coder": Coder(self)})
        return _coders["coder"]

    def tokens(self) -> dict[int, bytes]:
        if "_tokens" not in self.__dict__:
            self._tokens = {r: t for t, r in self.ranks.items()}
        return self._tokens

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_tokens"}


class Coder(dict):
    """Pattern match -> its ids as packed 32-bit integers, computed on the first request. A full memory
    of ``memory`` entries becomes the old one, from which what is asked for again comes back."""

    def __init__(self, vocabulary: Vocabulary, memory: int = MEMORY):
        super().__init__()
        self.memory = memory
        self.old: dict[str, bytes] = {}
        self.ranks = vocabulary.ranks
        self.find = regex.compile(vocabulary.pattern).findall
        self.tokens = vocabulary.tokens()
        self.split = {r: (r, r) for t, r in self.ranks.items() if len(t) == 1} | vocabulary.merges
        self.joined = {pair: r for r, pair in vocabulary.merges.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for rank in self.split:
            self.automaton.add_word(self.tokens[rank].decode("latin-1"), (rank, len(self.tokens[rank])))
        self.automaton.make_automaton()

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is not None:
            self[piece] = ids
            return ids
        data = piece.encode("utf-8", "surrogatepass")
        rank = self.ranks.get(data)
        ids = rank.to_bytes(4, "little") if rank is not None else np.array(self.backtrack(data), "<i4").tobytes()
        if len(self) >= self.memory:
            self.old = dict(self)
            self.clear()
        if len(piece) <= 256:
            self[piece] = ids
        return ids

    def backtrack(self, data: bytes) -> list[int]:
        n = len(data)
        at: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for last, (rank, size) in self.automaton.iter(data.decode("latin-1")):
            at[last + 1 - size].append((rank, last + 1))  # shorter ones come first
        dead = bytearray(n + 1)
        ids: list[int] = []
        places: list[tuple[int, int]] = []
        pos, left = 0, len(at[0])
        while pos < n:
            found = at[pos]
            while left:
                left -= 1
                rank, end = found[left]
                if not dead[end] and (not ids or self.fits(ids[-1], rank)):
                    ids.append(rank)
                    places.append((pos, left))
                    pos, left = end, len(at[end]) if end < n else 0
                    break
            else:
                dead[pos] = 1
                if not ids:
                    raise ValueError("the rank file lacks a single byte")
                ids.pop()
                pos, left = places.pop()
        return ids

    def fits(self, a: int, b: int) -> bool:
        """Whether merging keeps the border between tokens ``a`` and ``b``."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= self.memory:
                self.pairs.clear()
            known = self.pairs[a, b] = self._fits(a, b)
        return known

    def _fits(self, a: int, b: int) -> bool:
        # Undo merges on the two sides, latest first. A join across the border made earlier than
        # the merge just undone would have been taken first.
        before = 1 << 40
        while True:
            if self.joined.get((a, b), before) < before:
                return False
            inner_a, inner_b = self.split[a][1], self.split[b][0]
            can_a, can_b = inner_a != a, inner_b != b
            if not can_a and not can_b:
                return True
            if can_a and (not can_b or a > b):
                before, a = a, inner_a
            else:  # of two equal merges the left one comes first, so the right one is undone first
                before, b = b + 1, inner_b

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.find(text)))


def broadcast(df: DataFrame, path: str, pattern: str):
    """The vocabulary as a broadcast; the rank file bounds its size."""
    return df.sparkSession.sparkContext.broadcast(Vocabulary(read_ranks(path), pattern))


def encode(df: DataFrame, vocabulary, text: str = "text", ids: str = "ids", memory: int | None = None,
           decoded: str | None = None) -> DataFrame:
    """Append the ids of each whole text as ``array<int>``; a null or empty text has none.

    Workers keep their coder for later tasks. With ``memory`` (entries) each task has its own and nothing
    is left in the worker: for jobs whose other stages need the space. With ``decoded`` the ids are decoded
    in the same task, as by ``decode``, into a column of that name.
    """

    def make():
        coder = vocabulary.value.coder() if memory is None else Coder(vocabulary.value, memory)
        token = coder.tokens.__getitem__

        def run(texts: pa.Array) -> list[pa.Array]:
            packed = [coder.encode(x) if x else b"" for x in texts.to_pylist()]
            offsets = np.zeros(len(packed) + 1, np.int64)
            np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
            flat = np.frombuffer(b"".join(packed), "<i4")
            out = [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))]
            if decoded:
                data = [b"".join(map(token, flat[i:j].tolist())) for i, j in zip(offsets, offsets[1:], strict=False)]
                out.append(pa.array(data, pa.binary()))
            return out
        return run

    fields = T.StructType().add(ids, T.ArrayType(T.IntegerType()))
    return add_columns(df, text, fields.add(decoded, T.BinaryType()) if decoded else fields, make)


def decode(df: DataFrame, vocabulary, ids: str = "ids", data: str = "decoded") -> DataFrame:
    """Append the bytes of each list of ids; null ids give no bytes, an unknown id raises KeyError."""
    fields = [f for f in df.schema.fields if f.name.lower() != data.lower()]
    schema = T.StructType([*fields, T.StructField(data, T.BinaryType())])
    names, at = schema.names, [f.name for f in fields].index(ids)

    def apply(batches):
        tokens = vocabulary.value.tokens()
        for b in (whole.slice(i, ROWS) for whole in batches for i in range(0, whole.num_rows, ROWS)):
            out = [b"".join(map(tokens.__getitem__, x.values.to_pylist())) if x.is_valid else b"" for x in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names)

    return df.select(*[f"`{f.name}`" for f in fields]).mapInArrow(apply, schema)
