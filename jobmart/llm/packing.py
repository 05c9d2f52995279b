"""Training sequences packed by lexical retrieval: each window holds a seed document and its BM25 neighbours.

One pass turns texts into ids and, per document, its distinct ids (the terms); document frequencies and the mean length come from
all of them. Documents are then range-partitioned by their rarest shared terms, so that documents on the same things
meet in one shard, and a document repeated a million times is still dealt over many. A task cuts its sorted rows
into shards of bounded size. Each shard is an inverted index of BM25 weights: a window starts with a seed document,
the index returns its unused neighbours, and they fill the window in order of their score until it is full. The
document that doesn't fit is cut there, and its rest is the seed of the next window. A seed whose neighbours leave
room asks for the next ones; if none is left, the shard's next document is the seed.

Padding: windows are full, and only what is left in a task at its end makes shorter sequences, of a power of two
tokens each, which need none.

Nulls: a null text is empty; an empty document still has its end id. Repeated or null document ids are documents
like others. An empty table gives no piece.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.llm.common import ROWS, partitions, scratch
from jobmart.llm.token_files import Words, _groups

#: Tokens of a sequence.
WINDOW = 2048
#: A shard is closed at so many documents or tokens.
SHARD_DOCS = 4096
SHARD_TOKENS = 4_000_000
#: Terms of a seed that are looked up, the weightiest first, and neighbours returned at a time.
TERMS = 24
NEIGHBOURS = 32
#: Documents that must share a term for it to decide on a document's shard.
KEYED = 64
#: Fixed: the usual BM25 parameters.
K1, B = 1.2, 0.75

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_words: dict[str, Words] = {}


def _id_type(path: str, end: int) -> str:
    """Two bytes an id where the vocabulary allows."""
    from tokenizers import Tokenizer
    return "<u2" if max(end, *Tokenizer.from_file(path).get_vocab().values()) < 1 << 16 else "<u4"


def encode(df: DataFrame, path: str, end: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n and the ids of each whole text with ``end``. The last row of each task has only ``counts``: of each id
    the documents it is in, then all documents and all tokens."""
    kind = _id_type(path, end)

    def apply(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path not in _words:
            _words[path] = Words(path)
        words = _words[path]
        counts = np.zeros(max(len(words.ends), end + 1) + 2, np.int64)
        tail = np.array([end], "<u4")
        names = ["doc_id", "n", "ids", "counts"]
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                ids = []
                for texts in _groups(b.column(1)):
                    for own in words.encode(texts):
                        row = np.concatenate([own, tail]).astype(kind)
                        counts[terms_of(row)[0]] += 1
                        ids.append(row)
                n = [len(x) for x in ids]
                counts[-2:] += len(n), sum(n)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int32()), pa.array([x.tobytes() for x in ids], pa.binary()),
                                                  pa.nulls(len(n), pa.binary())], names)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()),
                                          pa.array([counts.astype("<i8").tobytes()], pa.binary())], names)

    rows = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(apply, "doc_id long, n int, ids binary, counts binary")


def terms_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids and how often each occurs."""
    ordered = np.sort(ids, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[starts], np.diff(np.append(starts, len(ordered)))


def statistics(encoded: DataFrame) -> tuple[np.ndarray, int, float]:
    """Of every id the number of documents it is in; all documents; their mean length."""

    def explode(batches):
        for b in batches:
            for x in b.column(0).to_pylist():
                total = np.frombuffer(x, "<i8")
                ids = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(np.where(ids < len(total) - 2, ids, ids - len(total))), pa.array(total[ids])], ["id", "n"])

    counts = encoded.where("counts is not null").select("counts").mapInArrow(explode, "id long, n long")
    rows = counts.groupBy("id").agg(F.sum("n").alias("n")).toPandas()  # a row for each id of the vocabulary
    n = dict(zip(rows["id"].tolist(), rows["n"].tolist(), strict=True))
    docs, tokens = n.pop(-2, 0), n.pop(-1, 0)
    found = np.zeros(max(n, default=0) + 1, np.int64)
    found[list(n)] = list(n.values())
    return found, docs, tokens / max(docs, 1)


def inverse(found: np.ndarray, docs: int) -> np.ndarray:
    """The inverse document frequency of every id."""
    return np.log1p((docs - found + 0.5) / (found + 0.5)).astype(np.float32)


def weights(terms: np.ndarray, times: np.ndarray, length: int | np.ndarray, idf: np.ndarray, mean: float) -> np.ndarray:
    """BM25 weights of a document's terms."""
    return idf[terms] * (times * (K1 + 1) / (times + K1 * (1 - B + B * length / mean))).astype(np.float32)


class Shard:
    """An inverted index over documents: of each term the documents it is in and their weights."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        rows, times = zip(*map(terms_of, docs), strict=True)
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        self.ends = np.cumsum(sizes)
        self.own = np.concatenate(rows)
        self.own_weight = weights(self.own, np.concatenate(times), np.repeat(np.fromiter(map(len, docs), np.int64, len(docs)), sizes), idf, mean)
        order = np.argsort(self.own, kind="stable")
        ordered = self.own[order]
        starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        self.terms, self.bounds = ordered[starts], np.append(starts, len(ordered))
        self.doc, self.weight = np.repeat(np.arange(len(docs), dtype=np.int32), sizes)[order], self.own_weight[order]
        self.unused = np.ones(len(docs), bool)
        self.n = len(docs)

    def query(self, seed: int) -> np.ndarray:
        """The weightiest terms of a document."""
        span = slice(self.ends[seed - 1] if seed else 0, self.ends[seed])
        own, weight = self.own[span], self.own_weight[span]
        return own if len(own) <= TERMS else own[np.argpartition(-weight, TERMS)[:TERMS]]

    def neighbours(self, seed: int) -> np.ndarray:
        """The unused documents nearest to a seed, best first, ties by their place; at most ``NEIGHBOURS``."""
        at = np.searchsorted(self.terms, self.query(seed))
        spans = [slice(self.bounds[i], self.bounds[i + 1]) for i in at.tolist()]
        score = np.bincount(np.concatenate([self.doc[s] for s in spans]), np.concatenate([self.weight[s] for s in spans]), self.n)
        found = np.flatnonzero((score > 0) & self.unused)
        if len(found) > NEIGHBOURS:
            least = np.partition(score[found], len(found) - NEIGHBOURS)[len(found) - NEIGHBOURS]
            found = found[score[found] >= least]
        return found[np.argsort(-score[found], kind="stable")[:NEIGHBOURS]]


class Packer:
    """Fills windows; ``rows`` are the pieces of what is complete."""

    def __init__(self, first: int, window: int):
        self.sequence, self.window, self.open, self.filled, self.rows = first, window, [], 0, []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """A whole document, cut wherever a window ends."""
        start = 0
        while start < len(ids):
            length = min(len(ids) - start, self.window - self.filled)
            self.open.append((doc_id, start, ids[start:start + length], len(ids)))
            self.filled += length
            start += length
            if self.filled == self.window:
                self._emit(self.open)
                self.open, self.filled = [], 0

    def _emit(self, pieces) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids), total, self.sequence, offset, ids.astype("<u4").tobytes()))
            offset += len(ids)
        self.sequence += 1

    def finish(self) -> None:
        """What is left goes into sequences of a power of two."""
        rest, self.open = self.open, []
        while self.filled:
            room, pieces = 1 << self.filled.bit_length() - 1, []
            self.filled -= room
            while room:
                doc_id, start, ids, total = rest.pop(0)
                pieces.append((doc_id, start, ids[:room], total))
                if len(ids) > room:
                    rest.insert(0, (doc_id, start + room, ids[room:], total))
                room -= len(pieces[-1][2])
            self._emit(pieces)


def fill(shard: Shard, ids: list[np.ndarray], names: list, packer: Packer):
    """Every document of a shard into windows; yields after each. A window's seed is what it begins with: the rest of
    the document cut last, or the shard's next one."""
    following, seed, last, asked, queue = 0, None, None, None, []
    while True:
        if last is not None and packer.sequence != asked:
            seed, queue, asked = last if packer.filled else None, [], packer.sequence
        if not queue and seed is not None:
            queue = shard.neighbours(seed)[::-1].tolist()
        if queue:
            last = queue.pop()
        else:
            while following < shard.n and not shard.unused[following]:
                following += 1
            if following == shard.n:
                return
            seed = last = following
        shard.unused[last] = False
        packer.add(names[last], ids[last])
        yield


def keyed(encoded: DataFrame, idf: np.ndarray, found: np.ndarray, kind: str) -> DataFrame:
    """Documents with their two rarest terms among those in at least ``KEYED`` documents (-1: none)."""
    shared = encoded.sparkSession.sparkContext.broadcast(np.where(found >= KEYED, idf, 0).astype(np.float32))

    def apply(batches):
        idf = shared.value
        for b in batches:
            keys = []
            for x in b.column(1).to_pylist():
                ids = np.frombuffer(x, kind)
                w = idf[ids]
                first = w.argmax()
                best = [int(ids[first]) if w[first] > 0 else -1]
                w[ids == ids[first]] = 0
                second = w.argmax()
                keys.append(best + [int(ids[second]) if w[second] > 0 else -1])
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array([k[i] for k in keys], pa.int32()) for i in (0, 1)]], ["doc_id", "ids", "first", "second"])

    return encoded.where("counts is null").select("doc_id", "ids").mapInArrow(apply, "doc_id long, ids binary, first int, second int")


def pack(df: DataFrame, tokenizer: str, end: int, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """The pieces of all documents: doc_id, start (its document's ids before it), length, doc_tokens, sequence_id,
    offset (in the sequence) and the ids as little-endian unsigned 32-bit integers."""
    spark = df.sparkSession
    kind = _id_type(tokenizer, end)
    path = scratch(spark, "packing-ids")
    encode(df, tokenizer, end, text, doc_id).write.options(**{"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}).parquet(path)
    encoded = spark.read.parquet(path)
    found, docs, mean = statistics(encoded)
    idf = inverse(found, docs)
    path = scratch(spark, "packing-keys")  # the range shuffle below reads its input twice
    keyed(encoded, idf, found, kind).write.parquet(path)
    shared = spark.sparkContext.broadcast((idf, mean))  # a number for each id of the vocabulary
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    kinds = [pa.int64()] * 6 + [pa.binary()]

    def batch(packer):
        rows, packer.rows = packer.rows, []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def apply(batches):
        from pyspark import TaskContext
        idf, mean = shared.value
        packer = Packer(TaskContext.get().partitionId() << 32, window)
        owners, ids, tokens = [], [], 0

        def close():
            for _ in fill(Shard(ids, idf, mean), ids, owners, packer):
                if len(packer.rows) >= ROWS:
                    yield batch(packer)

        for b in batches:
            for doc, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                owners.append(doc)
                ids.append(np.frombuffer(x, kind))
                tokens += len(ids[-1])
                if len(ids) >= SHARD_DOCS or tokens >= SHARD_TOKENS:
                    yield from close()
                    owners, ids, tokens = [], [], 0
        if ids:
            yield from close()
        packer.finish()
        if packer.rows:
            yield batch(packer)

    by = ["first", "second", "doc_id", F.xxhash64("ids")]
    dealt = spark.read.parquet(path).repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by)
    return dealt.select("doc_id", "ids").mapInArrow(apply, PIECES)
