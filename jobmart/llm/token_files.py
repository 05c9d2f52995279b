"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding.

Encoding. The tokenizers library gives each text its ids. Ids are replaced by their rank in the
corpus (the most frequent id is 0) and ranks are written in one to four little-endian bytes each. Two
bits per value say how many; those control bytes stand apart from the data bytes, so a reader turns
a whole block into integers with table lookups in numpy.

Files. A dataset is a Parquet table of blocks, range-partitioned and sorted by document: ``shard``
(ascending with the documents), ``block`` (ascending in a shard), ``before`` (ids of the shard's
earlier blocks), ``doc_ids``, ``lengths``, ``control``, ``data``; beside it ``ranks``, one row with the ids in rank order. The container is
Parquet so that any store Spark can write to will do.

The vocabulary bounds what is broadcast: one integer per id.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobmart.llm.common import partitions, scratch

#: Ids in a block before it is written; a document is never cut.
BLOCK = 1 << 18
#: Entries of each generation of a worker's memory of words.
MEMORY = 300_000
#: Fixed: of each control byte, the bytes that its four values take.
SIZES = np.array([[1 + (c >> 2 * i & 3) for i in range(4)] for c in range(256)], np.uint8)
#: White space on which libraries differ.
_ODD_SPACES = "\x1c\x1d\x1e\x1f\x85\xa0"
#: ASCII marks, and the tokenizer's pattern for ASCII words in lower case.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: What may stand beside "." and "," so that each is a piece of its own: no other character that is neither letter, digit nor space.
_BESIDE = {c for c in map(chr, range(256)) if c.isascii() and c.isalnum() or c > "\x7f" and c.isalpha() or c in " \t\n\v\f\r.,"}
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
#: Characters of the texts that are looked up together.
TOGETHER = 2_000_000

BLOCKS = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("block", T.IntegerType()),
    T.StructField("before", T.LongType()), T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("lengths", T.ArrayType(T.IntegerType())),
    T.StructField("control", T.BinaryType()), T.StructField("data", T.BinaryType())])


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, "<u4")
    more = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[:len(values)] = more
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= more[:, None]]
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The first ``n`` values: sizes by table, places by a running sum."""
    sizes = SIZES[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    at = np.cumsum(sizes, dtype=np.int64) - sizes
    out = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(sizes > k)
        if not len(longer):
            break
        out[longer] |= raw[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


class Words:
    """Word -> packed ids, in two generations for either kind of text: what is used again passes from the old one to the new.

    The file's normaliser and pattern treat words between blanks independently. In Latin-1 texts lower-casing
    changes no id, and the pattern's pieces of a word are plain: runs of letters, single digits, runs of marks.
    Runs of letters go to the library's model many at a time, joined by blanks; each has one token that ends a
    word, its last. All other pieces, and the words of other texts, go through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        for token, i in vocabulary.items():
            self.ends[i] = bool(suffix) and token.endswith(suffix)
        self.known: dict[bool, dict[str, bytes]] = {True: {"": b""}, False: {"": b""}}
        self.old: dict[bool, dict[str, bytes]] = {True: {}, False: {}}

    def library(self, words: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def joined(self, words: list[str], size: int = 256) -> list[bytes]:
        parts = [" ".join(words[i:i + size]) for i in range(0, len(words), size)]
        ids = np.concatenate([np.array(x.ids, "<u4") for x in self.letters.encode_batch_fast(parts, add_special_tokens=False)])
        last = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(last) != len(words):
            return self.library(words)
        data = ids.tobytes()
        return [data[i:j] for i, j in zip([0, *last], last, strict=False)]

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words of Latin-1 texts."""
        found, pieces = {}, {}
        letters = list(filter(str.isalpha, words))
        if letters:
            found.update(zip(letters, self.joined(letters), strict=True))
        for w in words:
            if not w.isalpha():
                base = w.rstrip(_MARKS)
                pieces[w] = [base, w[len(base):]] if base.isalpha() else _PIECES.findall(w) if w.isascii() else [w]
        need = {x for p in pieces.values() for x in p}.difference(found)
        letters, others = list(filter(str.isalpha, need)), [w for w in need if not w.isalpha()]
        if letters:
            found.update(zip(letters, self.joined(letters), strict=True))
        if others:
            found.update(zip(others, self.library(others), strict=True))
        found.update((w, b"".join(map(found.__getitem__, p))) for w, p in pieces.items() if p != [w])
        return found

    def lookup(self, lists: pa.ListArray, plain: bool) -> list[np.ndarray]:
        """The ids of each list of words; every distinct word is looked up once."""
        words = lists.flatten().dictionary_encode()
        every = words.dictionary.to_numpy(zero_copy_only=False).tolist()  # far quicker than to_pylist()
        known, old = self.known[plain], self.old[plain]
        ids = list(map(known.get, every))
        missing = [i for i, x in enumerate(ids) if x is None]
        if missing:
            known.update((w, old[w]) for i in missing if (w := every[i]) in old)
            if new := [w for i in missing if (w := every[i]) not in known]:
                known.update(self.learn(new) if plain else zip(new, self.library(new), strict=True))
            for i in missing:
                ids[i] = known[every[i]]
        if len(known) > MEMORY:
            self.old[plain], self.known[plain] = known, {"": b""}
        flat = np.frombuffer(b"".join(ids), "<u4")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(sizes) - sizes
        at = words.indices.to_numpy()
        sizes = sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        values = flat[np.arange(total) + np.repeat(starts[at] - ends + sizes, sizes)]
        bounds = np.concatenate([[0], ends])[lists.offsets.to_numpy()].tolist()
        return [values[i:j] for i, j in zip(bounds, bounds[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        groups: dict[bool, list[str]] = {True: [], False: []}
        kinds = []
        for x in texts:
            characters = set(x)
            plain = not characters or max(characters) <= "\xff" and characters.isdisjoint(_ODD_SPACES) and "<|" not in x
            kinds.append(plain)
            if plain:
                x = x.lower()
                if characters <= _BESIDE and not any(map(x.__contains__, ("..", ",,", ".,", ",."))):
                    x = x.replace(".", " . ").replace(",", " , ")  # each is a piece of its own
            else:  # the library itself decides on other white space
                x = x.replace("\n", " ")
            groups[plain].append(x)
        split = {True: pc.ascii_split_whitespace, False: lambda a: pc.split_pattern(a, " ")}
        rows = {k: iter(self.lookup(split[k](pa.array(x, pa.string())), k)) for k, x in groups.items()}
        return [next(rows[k]) for k in kinds]


_words: dict[str, Words] = {}


def _groups(column: pa.Array):
    group, size = [], 0
    for x in column.to_pylist():
        group.append(x or "")
        size += len(group[-1])
        if size >= TOGETHER:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode(df: DataFrame, path: str, end: int | None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n and the packed ids of each whole text; ``end`` closes every document. The last
    row of each task has nothing but the counts of its ids."""

    def apply(batches):
        if path not in _words:
            _words[path] = Words(path)
        words = _words[path]
        tail = np.array([] if end is None else [end], "<u4")
        total = np.zeros(max(len(words.ends), int(tail.max(initial=0)) + 1), np.int64)
        names = ["doc_id", "n", "control", "data", "counts"]
        for b in batches:
            n, control, data = [], [], []
            for texts in _groups(b.column(1)):
                rows = [x for own in words.encode(texts) for x in (own, tail)]
                together = np.concatenate(rows)
                total += np.bincount(together, minlength=len(total))
                at = 0
                for own in rows[::2]:
                    size = len(own) + len(tail)
                    c, d = pack(together[at:at + size])
                    at += size
                    n.append(size)
                    control.append(c)
                    data.append(d)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int32()), pa.array(control, pa.binary()), pa.array(data, pa.binary()),
                                              pa.nulls(len(n), pa.binary())], names)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                                          pa.array([total.astype("<i8").tobytes()], pa.binary())], names)

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(apply, "doc_id long, n int, control binary, data binary, counts binary")


def rank_order(encoded: DataFrame) -> np.ndarray:
    """Ids by descending count over all documents, ties by id, from each task's own counts."""

    def explode(batches):
        for b in batches:
            for x in b.column(0).to_pylist():
                total = np.frombuffer(x, "<i8")
                ids = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    counts = encoded.where("counts is not null").select("counts").mapInArrow(explode, "id long, n long")
    rows = counts.groupBy("id").agg(F.sum("n").alias("n")).toPandas()  # a row per id of the vocabulary
    rows = rows.sort_values(["n", "id"], ascending=[False, True])
    return rows["id"].to_numpy(np.uint32)


def write(df: DataFrame, out: str, tokenizer: str, end: int | None = None, text: str = "text",
          doc_id: str = "doc_id", shards: int | None = None) -> None:
    """Write a dataset in ascending doc_id order (null ids first, equal ids in a fixed order).

    A null text counts as empty; an empty table makes a dataset without blocks. Texts are tokenised
    once: a first table keeps them in the same coding under the vocabulary's own ids, from which the
    counts are taken.
    """
    spark = df.sparkSession
    first = scratch(spark, "token-ids")
    encode(df, tokenizer, end, text, doc_id).write.parquet(first)
    encoded = spark.read.parquet(first)
    order = rank_order(encoded)
    spark.createDataFrame([(order.astype(np.int64).tolist(),)], "ids array<long>").coalesce(1).write.parquet(f"{out}/ranks")
    ranks = np.zeros(int(order.max()) + 1 if len(order) else 0, np.uint32)
    ranks[order] = np.arange(len(order), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(ranks)

    def blocks(batches):
        from pyspark import TaskContext
        shard, block, before, ids, parts, size = TaskContext.get().partitionId(), 0, 0, [], [], 0

        def flush():
            control, data = pack(np.concatenate(parts) if parts else np.zeros(0, np.uint32))
            return pa.RecordBatch.from_pylist(
                [{"shard": shard, "block": block, "before": before, "doc_ids": ids, "lengths": list(map(len, parts)), "control": control, "data": data}],
                pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                           ("lengths", pa.list_(pa.int32())), ("control", pa.binary()), ("data", pa.binary())]))

        for b in batches:
            for doc, n, c, d in zip(*(col.to_pylist() for col in b.columns), strict=True):
                ids.append(doc)
                parts.append(shared.value[unpack(c, d, n)])
                size += n
                if size >= BLOCK:
                    yield flush()
                    block, before, ids, parts, size = block + 1, before + size, [], [], 0
        if ids:
            yield flush()

    order_by = [F.col("doc_id"), F.xxhash64("data")]
    encoded = encoded.where("counts is null").drop("counts")
    ordered = encoded.repartitionByRange(shards or partitions(spark), *order_by).sortWithinPartitions("doc_id", F.xxhash64("data"))
    ordered.mapInArrow(blocks, BLOCKS).write.parquet(f"{out}/blocks")


def read(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, the unsigned crc32 of the ids as
    little-endian 32-bit integers and, unless left out, the ids of every document of a dataset.

    Each block is decoded where it is read, without a shuffle; the driver adds up one number per shard.
    """
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    order = np.array(spark.read.parquet(f"{path}/ranks").first().ids, np.uint32)  # the vocabulary at most
    sizes = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    totals = blocks.groupBy("shard").agg(F.sum(sizes).alias("n")).collect()
    starts, at = {}, 0
    for shard, n in sorted(totals):
        starts[shard], at = at, at + n
    shared = spark.sparkContext.broadcast((order, starts))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids

    def documents(batches):
        order, starts = shared.value
        for b in batches:
            for row in b.to_pylist():
                n = np.array(row["lengths"], np.int64)
                all_ids = order[unpack(row["control"], row["data"], int(n.sum()))]
                ends = np.cumsum(n)
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(starts[row["shard"]] + row["before"] + ends - n),
                           pa.array(n), pa.array([crc32(all_ids[e - k:e]) for e, k in zip(ends, n, strict=True)], pa.int64())]
                if ids:
                    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(all_ids.view(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(columns)])

    return blocks.mapInArrow(documents, schema)


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
