"""Word sequences of a fixed length that stand more than once in a corpus, by fixed-block anchors.

With windows of W words and blocks of B = (W + 1) // 2 words, any window holds exactly one of the
non-overlapping blocks of its text (those that start at multiples of B). So if a window stands twice, a
rolling block of the one equals an anchor block of the other. The work has three scans of the texts:

1. Every text sends its anchors and all rolling blocks as probes to ranges of the hash. A range keeps
   the probes with an anchor and another place. Blocks that stand twice in the sending task's own rows
   are found there and sent on once, so a passage in every document is no hot key.
2. Texts with hits extend each of them over the windows around it and exchange the windows' hashes in
   the same way; a hash seen twice is a repeat. Overlapping windows merge to maximal exact repeats.
3. Texts take out the words that repeated windows cover.

Messages are arrays of hashes for many documents, not rows. Step 1 only selects, so it sends 32 bits
besides the range. Step 2 decides and compares 64 bits besides the range, which comes from a second hash:
with 10**12 windows in 10**5 ranges one pair of different windows in about 10**0 corpora is taken for equal.
No group is collected by key, no pair is formed; all steps are linear in the words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmart.llm.common import partitions, pieces, words_of

WINDOW = 35
#: Words after which a task sends what it has gathered; bounds its memory.
BLOCK_WORDS = 500_000
_M = np.uint64(0x9E3779B97F4A7C15)
_ODD = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
_NO_ID = -(1 << 63)
_MESSAGE = "bucket int, keys binary, counts binary, hashes binary, known binary, anchors binary"


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def rolling(h: np.ndarray, n: int, odd: np.uint64) -> np.ndarray:
    """A polynomial hash of every run of ``n`` values, by doubling."""
    out, have, run, step = None, 0, h, 1
    power = odd
    left = n
    while left:
        if left & 1:
            if out is None:
                out, have = run, step
            else:  # the part found so far, then a run behind it
                m = len(h) - have - step + 1
                if m <= 0:
                    return np.zeros(0, np.uint64)
                out, have = out[:m] * power + run[have:have + m], have + step
        left >>= 1
        if left:
            m = len(run) - step
            if m <= 0:
                return np.zeros(0, np.uint64)
            run = run[:m] * power + run[step:step + m]
            power = np.uint64(int(power) ** 2 & 0xFFFFFFFFFFFFFFFF)
            step *= 2
    out = (out ^ (out >> np.uint64(31))) * _M
    return out ^ (out >> np.uint64(29))


class Gathered:
    """Hashes of a task's rows until they are sent; two places in them settle a hash at once."""

    def __init__(self, buckets: int, width: str):
        self.buckets, self.width = buckets, width
        self.clear()

    def clear(self):
        self.rows, self.hashes, self.ranges, self.marks, self.places, self.words = [], [], [], [], [], 0

    def add(self, key: int, digest: bytes, n: int, hashes: np.ndarray, ranges: np.ndarray, anchors: np.ndarray | None = None,
            places: np.ndarray | None = None):
        """Hashes of a text's ``n`` places, or of some of them, the range of each, and which are anchors."""
        self.rows.append((key, digest, n))
        self.hashes.append(hashes)
        self.ranges.append(ranges)
        self.marks.append(np.zeros(len(hashes), bool) if anchors is None else anchors)
        self.places.append(np.arange(n) if places is None else places)
        self.words += n

    def send(self, salt: int):
        """A message per range, and one (bucket below 0) with the places of each row that are settled."""
        if not self.rows:
            return
        sizes = [len(x) for x in self.hashes]
        h, r, marks, places = map(np.concatenate, (self.hashes, self.ranges, self.marks, self.places))
        row = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort((r.astype(np.uint64) << np.uint64(32) | h) if self.width == "<u4" else h)
        hs, rs = h[order], r[order]
        start = np.flatnonzero(np.concatenate([[True], (hs[1:] != hs[:-1]) | (rs[1:] != rs[:-1])]))
        size = np.diff(np.append(start, len(hs)))
        settled = np.zeros(len(h), bool)
        settled[order] = np.repeat(size > 1, size)
        anchored = np.maximum.reduceat(marks[order].astype(np.uint8), start) > 0
        by_range = np.argsort(rs[start].astype(np.uint16 if self.buckets < 1 << 16 else np.int32), kind="stable")
        start, size, anchored = start[by_range], size[by_range], anchored[by_range]
        keys = np.array([x[0] for x in self.rows], np.int64)
        edges = np.searchsorted(rs[start], np.arange(self.buckets + 1))
        out = []
        for b in range(self.buckets):
            i, j = edges[b], edges[b + 1]
            if i == j:
                continue
            values, twice = hs[start[i:j]].astype(self.width), size[i:j] > 1
            single = row[order[start[i:j][~twice]]]
            by_row = np.argsort(single, kind="stable")
            rows, counts = np.unique(single, return_counts=True)
            out.append((b, keys[rows].tobytes(), counts.astype(np.int32).tobytes(), values[~twice][by_row].tobytes(),
                        values[twice].tobytes(), values[anchored[i:j]].tobytes()))
        begin = np.concatenate([[0], np.cumsum(sizes)])
        rows, bits = np.unique(row[settled]), []
        for k in rows:
            own = slice(begin[k], begin[k + 1])
            place = np.zeros(self.rows[k][2], bool)
            place[places[own][settled[own]]] = True
            bits.append(self.rows[k][1] + np.packbits(place).tobytes())
        if bits:
            counts = np.array([len(x) for x in bits], np.int32)
            out.append((-1 - salt % self.buckets, keys[rows].tobytes(), counts.tobytes(), b"".join(bits), b"", b""))
        self.clear()
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32())] + [
            pa.array([x[k] for x in out], pa.binary()) for k in range(1, 6)], ["bucket", "keys", "counts", "hashes", "known", "anchors"])


_ANSWER = "dest int, bucket int, keys binary, sizes binary, found binary"


def _dest(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys.view(np.uint64) * _M >> np.uint64(40)) % np.uint64(parts)).astype(np.int32)


def _answers(messages: DataFrame, width: str, anchored: bool) -> DataFrame:
    """For each range the hashes that stand elsewhere too (with an anchor, if asked for), and under a
    negative bucket the bits of settled places, by document; one array for each part of the documents."""
    parts = partitions(messages.sparkSession)

    def answer(rows: list[dict]):
        u = np.concatenate([np.frombuffer(x["hashes"], width) for x in rows])
        twice = np.unique(np.concatenate([np.frombuffer(x["known"], width) for x in rows]))
        values, n = np.unique(np.concatenate([u, twice, twice]), return_counts=True)
        good = values[n > 1]
        if anchored:
            good = np.intersect1d(good, np.unique(np.concatenate([np.frombuffer(x["anchors"], width) for x in rows])))
        if not len(good):
            return
        keys = np.concatenate([np.frombuffer(x["keys"], np.int64) for x in rows])
        counts = np.concatenate([np.frombuffer(x["counts"], np.int32) for x in rows])
        ok = good[np.minimum(np.searchsorted(good, u), len(good) - 1)] == u
        row = np.repeat(np.arange(len(keys), dtype=np.int32), counts)[ok]
        values = u[ok]
        part = _dest(keys, parts)[row]
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        out = []
        for k in np.unique(part):
            own = order[edges[k]:edges[k + 1]]
            hit, sizes = np.unique(row[own], return_counts=True)
            out.append((int(k), rows[0]["bucket"], keys[hit].tobytes(), (sizes * values.itemsize).astype(np.int32).tobytes(), values[own].tobytes()))
        yield _batch(out)

    def settled(x: dict):
        keys, sizes = np.frombuffer(x["keys"], np.int64), np.frombuffer(x["counts"], np.int32)
        part, ends = _dest(keys, parts), np.cumsum(sizes)
        out = []
        for k in np.unique(part):
            own = np.flatnonzero(part == k)
            out.append((int(k), -1, keys[own].tobytes(), sizes[own].tobytes(), b"".join(x["hashes"][ends[i] - sizes[i]:ends[i]] for i in own)))
        yield _batch(out)

    def run(batches):
        now, held = None, []
        for b in pieces(batches):
            for x in b.to_pylist():
                if x["bucket"] < 0:
                    yield from settled(x)
                    continue
                if held and x["bucket"] != now:
                    yield from answer(held)
                    held = []
                now = x["bucket"]
                held.append(x)
        if held:
            yield from answer(held)

    spread = messages.repartition(parts, "bucket").sortWithinPartitions("bucket")
    return spread.mapInArrow(run, _ANSWER)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate(kinds)], ["dest", "bucket", "keys", "sizes", "found"])


def _met(texts: DataFrame, answers: DataFrame) -> DataFrame:
    """Texts (with dest) and answers in one part each, the answers first. As a join it would need a row
    for every document and range; here an array serves all documents of a part."""
    both = answers.withColumn("kind", F.lit(0)).unionByName(texts.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return both.repartition(partitions(texts.sparkSession), "dest").sortWithinPartitions("dest", "kind")


class Answers(dict):
    """key -> [(bucket, found)] of the part at hand."""

    dest = None

    def take(self, dest: int, bucket: int, keys: bytes, sizes: bytes, found: bytes):
        if dest != self.dest:
            self.clear()
            self.dest = dest
        at = 0
        for key, size in zip(np.frombuffer(keys, np.int64).tolist(), np.frombuffer(sizes, np.int32).tolist(), strict=True):
            self.setdefault(key, []).append((bucket, found[at:at + size]))
            at += size

    def of(self, dest: int, key: int) -> list[tuple[int, bytes]] | None:
        return self.get(key) if dest == self.dest else None


def _digest(text: str) -> bytes:
    """Tells rows with the same id apart where an answer names places."""
    return xxhash.xxh3_64_digest(text.encode("utf-8", "surrogatepass"))


def _marked(text: str, hashes: np.ndarray, ranges: np.ndarray, found: list[tuple[int, bytes]], width: str) -> np.ndarray:
    """Which places of a text an answer names, by hash and range or by place."""
    out = np.zeros(len(hashes), bool)
    named = [(bucket, np.frombuffer(x, width)) for bucket, x in found if bucket >= 0]
    for bucket, bits in found:
        if bucket < 0 and bits[:8] == _digest(text):
            out |= np.unpackbits(np.frombuffer(bits, np.uint8, offset=8))[:len(out)].astype(bool)
    if named:
        values = np.concatenate([x for _, x in named])
        buckets = np.repeat(np.array([k for k, _ in named], np.int32), [len(x) for _, x in named])
        if width == "<u4":
            values, hashes = (np.left_shift(r.astype(np.uint64), np.uint64(32)) | x for r, x in ((buckets, values), (ranges, hashes)))
        order = np.argsort(values)
        values, buckets = values[order], buckets[order]
        at = np.minimum(np.searchsorted(values, hashes), len(values) - 1)
        out |= (values[at] == hashes) & (buckets[at] == ranges)
    return out


def _blocks(h: np.ndarray, block: int, buckets: int):
    b = rolling(h, block, _ODD[0])
    return b.astype(np.uint32), ((b >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


def _windows(h: np.ndarray, window: int, buckets: int):
    return rolling(h, window, _ODD[0]), (rolling(h, window, _ODD[1]) % np.uint64(buckets)).astype(np.int32)


def _squeezed(rows: DataFrame) -> DataFrame:
    """The last column, a text, as compressed bytes, which the shuffles of texts carry, and dest of the key before it."""
    schema = T.StructType(rows.schema.fields[:-1] + [T.StructField("squeezed", T.BinaryType()), T.StructField("dest", T.IntegerType())])
    names, parts = schema.names, partitions(rows.sparkSession)

    def squeeze(batches):
        c = zstandard.ZstdCompressor(level=3)
        for b in pieces(batches):
            out = [None if x is None else c.compress(x.encode("utf-8", "surrogatepass")) for x in b.column(b.num_columns - 1).to_pylist()]
            dest = pa.array(_dest(b.column(b.num_columns - 2).to_numpy(), parts))
            yield pa.RecordBatch.from_arrays(b.columns[:-1] + [pa.array(out, pa.binary()), dest], names)

    return rows.mapInArrow(squeeze, schema)


def _text(data: bytes | None) -> str | None:
    return None if data is None else zstandard.decompress(data).decode("utf-8", "surrogatepass")


def _keyed(docs: DataFrame, doc_id: str, text: str, *more) -> DataFrame:
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("key"), F.col(text).cast("string").alias("text"), *more)


def _found(docs: DataFrame, window: int, doc_id: str, text: str) -> DataFrame:
    """The answers of step 2 for every document with a repeated window."""
    block, buckets = (window + 1) // 2, partitions(docs.sparkSession)

    def probes(batches):
        from pyspark import TaskContext
        gathered, salt = Gathered(buckets, "<u4"), TaskContext.get().partitionId()
        for b in pieces(batches):
            for key, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                h = word_hashes(words_of(x))
                if len(h) >= window:
                    low, ranges = _blocks(h, block, buckets)
                    anchors = np.zeros(len(low), bool)
                    anchors[::block] = True
                    gathered.add(key, _digest(x), len(low), low, ranges, anchors)
                    if gathered.words >= BLOCK_WORDS:
                        yield from gathered.send(salt := salt + 1)
        yield from gathered.send(salt)

    def windows(batches):
        from pyspark import TaskContext
        gathered, salt, answers = Gathered(buckets, "<u8"), TaskContext.get().partitionId(), Answers()
        for b in pieces(batches):
            for dest, bucket, keys, sizes, got, kind, key, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if kind == 0:
                    answers.take(dest, bucket, keys, sizes, got)
                    continue
                found = answers.of(dest, key)
                if not found:
                    continue
                x = _text(data)
                h = word_hashes(words_of(x))
                hits = _marked(x, *_blocks(h, block, buckets), found, "<u4")
                seen = np.concatenate([[0], np.cumsum(hits)])
                n = len(h) - window + 1  # a window holds the blocks that start at its first places
                near = np.flatnonzero(seen[window - block + 1:][:n] > seen[:n]) if n > 0 else ()
                if len(near):
                    w, ranges = _windows(h, window, buckets)
                    gathered.add(key, _digest(x), n, w[near], ranges[near], places=near)
                    if gathered.words >= BLOCK_WORDS:
                        yield from gathered.send(salt := salt + 1)
        yield from gathered.send(salt)

    rows = _keyed(docs, doc_id, text)
    hits = _answers(rows.mapInArrow(probes, _MESSAGE), "<u4", True)
    near = _met(_squeezed(rows), hits).select("dest", "bucket", "keys", "sizes", "found", "kind", "key", "squeezed")
    return _answers(near.mapInArrow(windows, _MESSAGE), "<u8", False)


def remove(docs: DataFrame, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id", more_text: bool = True) -> DataFrame:
    """Append n_words, removed (array of [start, end) word positions, maximal), n_removed and kept
    (the other words joined by one space, or the text as it is if nothing goes) to every row.

    A word goes if a window of ``window`` words over it stands anywhere else in the corpus, in the same text
    too; all copies go, the first included. Windows are judged on the input. Words are runs without
    ASCII white space, compared as they are. A null text has no words and stays null. Rows with
    equal or null ids are different places. Columns with the new names are replaced. Without
    ``more_text`` the input text is left out of the result and of the shuffle.
    """
    buckets = partitions(docs.sparkSession)
    fields = (T.StructType().add("n_words", "long").add("removed", T.ArrayType(T.ArrayType(T.LongType())))
              .add("n_removed", "long").add("kept", "string"))
    new = {f.name for f in fields} | (set() if more_text else {text.lower()})
    keep = [c for c in docs.columns if c.lower() not in new]
    rows = docs.select(F.struct(*[f"`{c}`" for c in keep]).alias("row"), F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("key"),
                       F.col(text).cast("string").alias("text"))
    both = _met(_squeezed(rows), _found(docs, window, doc_id, text)).select("row", "dest", "bucket", "keys", "sizes", "found", "kind", "key", "squeezed")
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), *fields.fields])
    names = schema.names

    def cut(batches):
        answers = Answers()
        for b in pieces(batches):
            out: list[list] = [[], [], [], []]
            places = []
            for at, (dest, bucket, keys, sizes, got, kind, doc, data) in enumerate(zip(*(c.to_pylist() for c in b.columns[1:]), strict=True)):
                if kind == 0:
                    answers.take(dest, bucket, keys, sizes, got)
                    continue
                places.append(at)
                x = _text(data)
                found, words = answers.of(dest, doc), words_of(x)
                gone = np.zeros(len(words), bool)
                if found and len(words) >= window:
                    w, ranges = _windows(word_hashes(words), window, buckets)
                    repeated = np.flatnonzero(_marked(x, w, ranges, found, "<u8"))
                    level = np.zeros(len(words) + 1, np.int64)
                    level[repeated] += 1
                    level[repeated + window] -= 1
                    gone = np.cumsum(level[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]).astype(np.int8)))
                out[0].append(len(words))
                out[1].append(edges.reshape(-1, 2).tolist())
                out[2].append(int(gone.sum()))
                stay = [0, *edges.tolist(), len(words)]
                out[3].append(b" ".join(w for i in range(0, len(stay), 2) for w in words[stay[i]:stay[i + 1]]).decode("utf-8", "surrogatepass")
                              if len(edges) else x)
            kinds = (pa.int64(), pa.list_(pa.list_(pa.int64())), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(places, pa.int64())), *(pa.array(v, k) for v, k in zip(out, kinds, strict=True))], names)

    return both.mapInArrow(cut, schema).select("row.*", *fields.names)
