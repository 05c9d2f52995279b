"""SimHash near-duplicates through a hierarchical index in Gray order.

Fingerprints. A text's words (A-Z in lower case) make shingles, each hashed by XXH64 with seed 42;
a bit of the fingerprint is 1 if it is set in over half of the hashes. Equal fingerprints are one
row from there on.

Dealing out. Two fingerprints with at most d differing bits agree on one of d+1 bands of bits, so each goes
to d+1 groups, by band and its bits. A group above ``GROUP`` fingerprints is dealt out again by the bands of its
other bits, which may differ in d places too; one that is still above it is cut into chunks, and
each pair of chunks becomes a group. No group is larger than two chunks, none is dropped.

Search. A group is sorted by Gray rank, so that neighbours share most bits. Above the sorted rows
stands a tree: each node has the bits on which all rows below agree (mask and pattern), and a child
only counts the bits that its parent didn't, so differences add up on the way down and a node is left with
all its rows once there are more than d. Rows linked to their neighbours in Gray order already, or
found in an earlier batch, form classes; a node whose rows are all in the query's class is left too.
A group gives the edges of a forest, never its pairs. Edges become components by alternating large-star
and small-star steps on tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.llm.common import partitions, pieces, stored, words_of

SHINGLE, BITS = 4, 4
#: Fingerprints of a group before it is dealt out again, and children of an index node.
GROUP, FANOUT = 20_000, 8
_BYTE = np.array([[b >> i & 1 for i in range(8)] for b in range(256)], np.int64)


def hashes(words: list[bytes], k: int, lower: bool = True) -> np.ndarray:
    """XXH64 (seed 42) of each run of ``k`` words joined by a space, of the whole if there are fewer."""
    if not words:
        return np.zeros(0, np.uint64)
    text = b" ".join(words)
    text = text.lower() if lower else text
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - k + 1)
    hash64 = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[min(k, len(words)) - 1:].tolist(), strict=True)
    return np.fromiter((hash64(text[a:b], 42) for a, b in spans), np.uint64, n)


def fingerprint(h: np.ndarray) -> int:
    """Unsigned 64-bit fingerprint of shingle hashes; 0 for none."""
    lanes = h.view(np.uint8)
    out = 0
    for i in range(8):
        ones = np.bincount(lanes[i::8], minlength=256) @ _BYTE
        out |= int((2 * ones > len(h)) @ (1 << np.arange(8))) << 8 * i
    return out


def fingerprints(docs: DataFrame, k: int = SHINGLE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and fingerprint (signed long) of each whole text; null and blank texts have 0."""

    def run(batches):
        for b in batches:
            out = np.array([fingerprint(hashes(words_of(x), k)) for x in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out.view(np.int64))], ["doc_id", "fingerprint"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Where a code word stands in the reflected Gray sequence."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


def join(c: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the classes ``c`` of linked rows: least label, with pointers cut short."""
    while len(a):
        low, high = np.minimum(c[a], c[b]), np.maximum(c[a], c[b])
        apart = low != high
        a, b, low, high = a[apart], b[apart], low[apart], high[apart]
        np.minimum.at(c, high, low)
        while (c[c] != c).any():
            c[:] = c[c]


class GrayIndex:
    """A tree over unsigned 64-bit fingerprints; ``classes`` labels those linked so far.

    With ``wide`` (rows x words), a link must also hold within ``wide_bits`` over all words.
    """

    def __init__(self, fps: np.ndarray, bits: int, wide: np.ndarray | None = None, wide_bits: int = 0):
        self.order = np.argsort(gray_rank(fps), kind="stable")
        self.fps, self.bits = fps[self.order], bits
        self.wide, self.wide_bits = None if wide is None else wide[self.order], wide_bits
        n = len(fps)
        self.levels = [(self.fps, np.full(n, ~np.uint64(0)))]
        every, some = self.fps, self.fps
        while len(every) > FANOUT:
            at = np.arange(0, len(every), FANOUT)
            every, some = np.bitwise_and.reduceat(every, at), np.bitwise_or.reduceat(some, at)
            mask = ~(every ^ some)
            self.levels.append((every & mask, mask))
        self.classes = np.arange(n)
        for step in range(1, min(n, FANOUT + 1)):
            near = np.flatnonzero(np.bitwise_count(self.fps[step:] ^ self.fps[:-step]) <= bits)
            self.join(*self.confirmed(near, near + step))

    def confirmed(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.wide is None or not len(a):
            return a, b
        ok = np.bitwise_count(self.wide[a] ^ self.wide[b]).sum(axis=1, dtype=np.int32) <= self.wide_bits
        return a[ok], b[ok]

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        join(self.classes, a, b)

    def pure(self) -> list[np.ndarray]:
        """The class of each node's rows, -1 if they have several."""
        out = [self.classes]
        low = high = self.classes
        for pattern, _ in self.levels[1:]:
            at = np.arange(0, len(low), FANOUT)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            out.append(np.where(low == high, low, -1))
        return out

    def search(self, queries: int = 1024, room: int = 1 << 19) -> np.ndarray:
        """Link all rows within ``bits``; the frontier is walked depth first in pieces of ``room``."""
        n, top = len(self.fps), len(self.levels) - 1
        for first in range(0, n, queries):
            pure = self.pure()
            pattern, mask = self.levels[top]
            q = np.repeat(np.arange(first, min(n, first + queries)), len(pattern))
            node = np.tile(np.arange(len(pattern)), min(n, first + queries) - first)
            stack = [(top, q, node, np.bitwise_count((self.fps[q] ^ pattern[node]) & mask[node]).astype(np.int8))]
            links = []
            while stack:
                level, q, node, differ = stack.pop()
                last = (node + 1) * FANOUT ** level  # only rows behind the query; pairs are met once
                ok = np.flatnonzero((differ <= self.bits) & (last > q + 1) & (pure[level][node] != self.classes[q]))
                if level == 0:
                    ok = ok[node[ok] > q[ok]]
                    links.append(self.confirmed(q[ok], node[ok]))
                    continue
                below, inner = self.levels[level - 1], self.levels[level][1]
                for piece in np.array_split(ok, max(1, -(-len(ok) * FANOUT // room))):
                    child = (node[piece, None] * FANOUT + np.arange(FANOUT)).ravel()
                    from_q, seen, so_far = (np.repeat(x[piece], FANOUT) for x in (q, node, differ))
                    real = child < len(below[0])
                    child, from_q, seen, so_far = child[real], from_q[real], seen[real], so_far[real]
                    more = np.bitwise_count((self.fps[from_q] ^ below[0][child]) & below[1][child] & ~inner[seen])
                    stack.append((level - 1, from_q, child, so_far + more.astype(np.int8)))
            for a, b in links:
                self.join(a, b)
        return self.classes


def _bands(bits: int, width: int = 64) -> list[tuple[int, int]]:
    """(shift, size) of bits + 1 bands that cover ``width`` bits."""
    edges = [i * width // (bits + 1) for i in range(bits + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _cut(value, shift: int, size: int):
    return F.shiftrightunsigned(value, shift).bitwiseAND(F.lit((1 << size) - 1))


def _without(value, shift: int, size: int):
    """The other bits, moved together."""
    low = value.bitwiseAND(F.lit((1 << shift) - 1)) if shift else F.lit(0).cast("long")
    high = F.shiftrightunsigned(value, shift + size) if shift + size < 64 else F.lit(0).cast("long")
    return low.bitwiseOR(F.shiftleft(high, shift))


def edges(rows: DataFrame, bits: int = BITS, group: int = GROUP, wide_bits: int | None = None) -> DataFrame:
    """(a, b): ids of linked rows, a forest in each group, with the components of all links.

    ``rows``: id, fingerprint and, with ``wide_bits``, word (which of several fingerprints this is) and
    wide (all of them, array<long>); rows link within one word.
    """
    fp, wide = F.col("fingerprint"), wide_bits is not None
    columns = ["id", "fingerprint", *(["word", "wide"] if wide else [])]
    out = ["id", "fingerprint", *(["wide"] if wide else [])]
    bands = _bands(bits)
    # At most words * (bits + 1) * 2**13 keys, so the large groups are few enough to broadcast.
    first = rows.select(*columns, F.explode(F.array(*[
        F.struct(F.lit(i).alias("band"), _cut(fp, *b).alias("value")) for i, b in enumerate(bands)])).alias("k"))
    key = ["word", "band", "value"] if wide else ["band", "value"]
    first = first.select(*columns, "k.*")
    large = first.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group)
    marked = first.join(F.broadcast(large), key, "left")
    whole = marked.where("n is null").select(*out, F.xxhash64(*key).alias("k"))
    rest = F.lit(None).cast("long")
    for i, b in enumerate(bands):
        rest = F.when(F.col("band") == i, _without(fp, *b)).otherwise(rest)
    again = marked.where("n is not null").withColumn("rest", rest)
    again = again.select(*out, *key, F.explode(F.array(*[
        F.struct(F.lit(i).alias("band2"), _cut(F.col("rest"), *b).alias("value2"))
        for i, b in enumerate(_bands(bits, 64 - min(s for _, s in bands)))])).alias("s"))
    again = again.select(*out, F.xxhash64(*key, "s.band2", "s.value2").alias("k"))
    sizes = again.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group)
    sized = again.join(sizes, "k", "left")
    parts = F.ceil(F.col("n") / F.lit(group // 2)).cast("int")
    # Chunk pairs: a row meets each chunk of its group once, in the group of the two.
    other = F.explode(F.when(F.col("n").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), parts - 1)))
    chunked = sized.withColumn("own", F.coalesce(F.pmod(F.xxhash64("id"), parts).cast("int"), F.lit(0))).withColumn("other", other)
    chunked = chunked.select(*out, F.xxhash64("k", F.least("own", "other"), F.greatest("own", "other")).alias("k"))
    return _search(whole.unionByName(chunked), bits, wide_bits)


def _search(rows: DataFrame, bits: int, wide_bits: int | None) -> DataFrame:
    def links(parts: list[list]) -> pa.RecordBatch | None:
        ids = np.concatenate([p[0] for p in parts])
        if len(ids) < 2:
            return None
        fps = np.concatenate([p[1] for p in parts]).view(np.uint64)
        wide = None if wide_bits is None else np.concatenate([p[2] for p in parts])
        index = GrayIndex(fps, bits, wide, wide_bits or 0)
        c, ids = index.search(), ids[index.order]
        far = np.flatnonzero(ids != ids[c])
        return pa.RecordBatch.from_arrays([pa.array(ids[far]), pa.array(ids[c[far]])], ["a", "b"]) if len(far) else None

    def run(batches):
        key, held = None, []
        for batch in batches:
            keys, ids, fps = (batch.column(i).to_numpy() for i in range(3))
            wide = None
            if wide_bits is not None:
                wide = batch.column(3).flatten().to_numpy().view(np.uint64).reshape(len(keys), -1)
            cuts = np.flatnonzero(np.diff(keys)) + 1
            for i, j in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if i == j:
                    continue
                if key != keys[i]:
                    if held and (found := links(held)) is not None:
                        yield found
                    key, held = keys[i], []
                held.append([ids[i:j], fps[i:j], None if wide is None else wide[i:j]])
        if held and (found := links(held)) is not None:
            yield found

    spread = rows.select("k", *[c for c in rows.columns if c != "k"]).repartition(partitions(rows.sparkSession), "k")
    return spread.sortWithinPartitions("k").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge table (a, b): its least reachable node.

    Alternating star steps; each is two aggregates with map-side combine and joins that adaptive
    execution splits at hubs. Steps are written to the shared folder, so nothing hangs on a lineage.
    """
    now = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")) \
                .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: neighbours above a node go to the least node around it
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct(), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        # small star: a node and its lower neighbours go to the least of them
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(
            least.select("a", F.col("m").alias("b")))
        now = stored(small.distinct(), "edges")


def classes(docs: DataFrame, k: int = SHINGLE, bits: int = BITS, text: str = "text", doc_id: str = "doc_id",
            group: int = GROUP) -> DataFrame:
    """doc_id, fingerprint (signed long) and component_id (least doc_id of the component) per document.

    Null and blank texts have fingerprint 0 and are linked like any other; repeated ids keep their
    rows; a null id never names a component that has others. An empty table gives an empty one.
    """
    own = stored(fingerprints(docs, k, text, doc_id), "fingerprints")
    fps = stored(own.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct")
    links = edges(fps.select(F.col("fingerprint").alias("id"), "fingerprint"), bits, group)
    named = _named(fps.select(F.col("fingerprint").alias("id"), "first"), links)
    return own.join(named, own["fingerprint"] == named["id"]).select("doc_id", "fingerprint", "component_id")


def _named(rows: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component_id) of every row (id, first): the least ``first`` of its component."""
    roots = stored(components(links), "roots")
    placed = rows.join(roots, rows["id"] == roots["node"], "left").select("id", "first", F.coalesce("root", "id").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    return placed.join(least, "root").select("id", "component_id")


#: For similar texts rather than equal fingerprints: five-word shingles, the least Jaccard similarity as a fraction, and
#: ``WORDS`` words of 64 SimHash bits, each cut into ``BANDS`` bands of ``BAND`` bits. Two sets of similarity 0.8 share 0.889 of
#: their hashes and differ in 15 % of the bits, so that a band is equal with probability 0.139, and one of all with 0.9999.
SIMILAR_SHINGLE, LEAST, WORDS, BANDS, BAND = 5, (4, 5), 13, 5, 12
#: Candidates differ in at most ``FAR`` bits of the first word and ``WIDE_FAR`` of the first ``WIDE`` words: four standard
#: deviations more than sets of similarity 0.8, and far less than the half by which others differ.
WIDE, FAR, WIDE_FAR = 4, 21, 62
#: Rows of a group that are compared as they stand; larger groups get an index.
SMALL = 64
#: Texts and characters of a chunk that are compared with each other and with those of one other chunk.
TEXTS, ROOM = 4_000, 20_000_000
_MIX = np.array([xxhash.xxh64_intdigest(i.to_bytes(4, "little"), 42) | 1 for i in range(WORDS)], np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct five-word shingle hashes of a text, ascending."""
    return np.unique(hashes(words_of(text), SIMILAR_SHINGLE))


def set_id(h: np.ndarray) -> int:
    """Signed 64-bit hash of a whole set."""
    return int(np.array(xxhash.xxh64_intdigest(np.ascontiguousarray(h, "<u8").tobytes(), 42), np.uint64).view(np.int64))


def simhash_words(h: np.ndarray, piece: int = 1024) -> np.ndarray:
    """``WORDS`` SimHash words of a set, each from another mixing of its hashes; zero for an empty set."""
    ones = np.zeros(64 * WORDS, np.int64)
    for i in range(0, len(h), piece):
        x = h[i:i + piece, None] * _MIX
        x ^= x >> np.uint64(31)
        x *= _MIX[::-1]
        x ^= x >> np.uint64(29)
        ones += np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)


def band_keys(h: np.ndarray) -> np.ndarray:
    """Per band its number and the bits of the set's SimHash words there; none for an empty set."""
    if not len(h):
        return np.zeros(0, np.int64)
    shifts = (np.arange(BANDS) * BAND).astype(np.uint64)
    values = (simhash_words(h)[:, None] >> shifts & np.uint64((1 << BAND) - 1)).ravel().astype(np.int64)
    return np.arange(WORDS * BANDS) << BAND | values


def near(wide: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the pairs (a, b) of rows are candidates."""
    ok = np.flatnonzero(np.bitwise_count(wide[a, 0] ^ wide[b, 0]) <= FAR)
    return ok[np.bitwise_count(wide[a[ok]] ^ wide[b[ok]]).sum(axis=1, dtype=np.int32) <= WIDE_FAR]


def _candidates(rows: DataFrame) -> DataFrame:
    """(a, b): ids of candidates, a forest in each group of ``rows``: key, id, wide (array<long>).

    Small groups lie side by side and are compared row by row with those behind; a larger one is
    searched by a tree in Gray order, and one above ``GROUP`` is cut into chunks that meet in pairs.
    """
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP)
    parts = F.ceil(F.col("n") / F.lit(GROUP // 2)).cast("int")
    sized = rows.join(F.broadcast(sizes), "key", "left")
    other = F.explode(F.when(F.col("n").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), parts - 1)))
    cut = sized.withColumn("own", F.coalesce(F.pmod(F.xxhash64("id"), parts).cast("int"), F.lit(0))).withColumn("other", other)
    whole = cut.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("k"), "id", "wide")

    def forest(ids: np.ndarray, classes: np.ndarray) -> pa.RecordBatch:
        far = np.flatnonzero(ids != ids[classes])
        return pa.RecordBatch.from_arrays([pa.array(ids[far]), pa.array(ids[classes[far]])], ["a", "b"])

    def small(keys: np.ndarray, ids: np.ndarray, wide: np.ndarray) -> pa.RecordBatch:
        classes = np.arange(len(ids))
        for step in range(1, SMALL):
            a = np.flatnonzero(keys[step:] == keys[:-step])
            if not len(a):
                break
            ok = near(wide, a, a + step)
            join(classes, a[ok], a[ok] + step)
        return forest(ids, classes)

    def large(ids: np.ndarray, wide: np.ndarray) -> pa.RecordBatch:
        index = GrayIndex(wide[:, 0], FAR, wide, WIDE_FAR)
        return forest(ids[index.order], index.search())

    def cuts(batches):
        """The rows of whole groups, about a batch at a time."""
        held = None
        for b in pieces(batches, 8192):
            wide = b.column(2).flatten().to_numpy().view(np.uint64).reshape(b.num_rows, -1)
            now = [b.column(0).to_numpy(), b.column(1).to_numpy(), wide]
            now = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
            ready = int(np.searchsorted(now[0], now[0][-1]))  # the last group may go on
            if ready:
                yield [x[:ready] for x in now]
            held = [x[ready:] for x in now]
        if held is not None and len(held[0]):
            yield held

    def run(batches):
        for keys, ids, wide in cuts(batches):
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            sizes = np.diff(np.append(first, len(keys)))
            few = np.repeat(sizes <= SMALL, sizes)
            yield small(keys[few], ids[few], wide[few])
            for i, n in zip(first[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
                yield large(ids[i:i + n], wide[i:i + n])

    spread = whole.repartition(partitions(rows.sparkSession), "k")
    return spread.sortWithinPartitions("k").mapInArrow(run, "a long, b long")


def similar_sets(sets: list[np.ndarray]) -> np.ndarray:
    """For each set the place of one of its class: sets of Jaccard similarity ``LEAST`` or more are linked.

    Every pair is compared unless its sizes exclude a link or both are in one class already.
    """
    sizes = np.array([len(h) for h in sets], np.int64)
    order = np.argsort(sizes, kind="stable")
    sizes, n = sizes[order], len(sets)
    values, codes = np.unique(np.concatenate([sets[k] for k in order]), return_inverse=True)
    codes, ends = codes.astype(np.int32), np.cumsum(sizes)
    starts, mark, c = ends - sizes, np.zeros(len(values), bool), np.arange(n)
    over, under = LEAST
    for i in range(n):
        most = int(np.searchsorted(sizes, sizes[i] * under // over, side="right"))
        others = i + 1 + np.flatnonzero(c[i + 1:most] != c[i])
        if not len(others) or not sizes[i]:
            continue
        own = codes[starts[i]:ends[i]]
        mark[own] = True
        if 4 * len(others) > most - i:
            others = np.arange(i + 1, most)
            theirs = codes[starts[i + 1]:ends[most - 1]]
        else:
            theirs = np.concatenate([codes[starts[j]:ends[j]] for j in others.tolist()])
        at = np.cumsum(sizes[others]) - sizes[others]
        shared = np.add.reduceat(mark[theirs], at, dtype=np.int64)
        mark[own] = False
        # shared / (own + theirs - shared) >= over / under
        near = others[(over + under) * shared >= over * (sizes[i] + sizes[others])]
        if len(near):
            labels = np.unique(np.append(c[near], c[i]))
            c[np.isin(c, labels)] = labels[0]
    out = np.empty(n, np.int64)
    out[order] = order[c]
    return out


def _links(rows: DataFrame) -> DataFrame:
    """(a, b): ids of linked sets, a forest in each group of ``rows``: k (the group), id, text."""

    def links(ids: list[int], sets: list[np.ndarray]) -> pa.RecordBatch | None:
        own = np.array(ids, np.int64)
        root = own[similar_sets(sets)]
        far = np.flatnonzero(own != root)
        return pa.RecordBatch.from_arrays([pa.array(own[far]), pa.array(root[far])], ["a", "b"]) if len(far) else None

    def run(batches):
        key, ids, sets = None, [], []
        for batch in pieces(batches):
            for k, i, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if key != k:
                    if len(ids) > 1 and (found := links(ids, sets)) is not None:
                        yield found
                    key, ids, sets = k, [], []
                ids.append(i)
                sets.append(shingle_set(text))
        if len(ids) > 1 and (found := links(ids, sets)) is not None:
            yield found

    spread = rows.select("k", "id", "text").repartition(partitions(rows.sparkSession), "k")
    return spread.sortWithinPartitions("k").mapInArrow(run, "a long, b long")


def similar(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", chunk: int = TEXTS, room: int = ROOM) -> DataFrame:
    """doc_id and component_id of every document, where texts of 0.8 similarity or more are linked.

    Two texts are candidates if a band of their SimHash words is equal and few bits of the first words differ;
    candidates' components are small beside the table. Inside each of them the sets themselves are compared,
    and only links of 0.8 or more make classes.
    Components above a chunk are dealt out by pairs of chunks. Texts without words link to each other.
    Ids should be unique and not null: rows without one are in no component and get null.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def code(batches):
        for b in pieces(batches):
            sets = [shingle_set(x) for x in b.column(1).to_pylist()]
            words = np.concatenate([np.zeros(0, np.uint64), *map(simhash_words, sets)]).view(np.int64)
            offsets = (np.arange(b.num_rows + 1) * WORDS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([set_id(h) for h in sets], pa.int64()), pa.array([len(h) for h in sets], pa.int64()),
                                              pa.ListArray.from_arrays(pa.array(offsets), pa.array(words))], ["doc_id", "id", "n", "words"])

    def name(batches):
        for b in pieces(batches):
            ids = [set_id(shingle_set(x)) for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), b.column(0)], ["id", "text"])

    own = stored(rows.mapInArrow(code, "doc_id long, id long, n long, words array<long>"), "sets").where("doc_id is not null")
    distinct = own.groupBy("id").agg(F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("words").alias("words"))
    distinct = stored(distinct, "distinct")
    bands = [F.lit((w * BANDS + i) << BAND).bitwiseOR(_cut(F.col("words")[w], i * BAND, BAND)) for w in range(WORDS) for i in range(BANDS)]
    banded = distinct.where("n > 0").select("id", F.slice("words", 1, WIDE).alias("wide"), F.explode(F.array(*bands)).alias("key"))
    links = _candidates(banded)
    candidates = stored(components(links), "candidates")
    # One text of each set; copies merge before the shuffle.
    texts = rows.where("doc_id is not null").select("text").mapInArrow(name, "id long, text string").groupBy("id").agg(F.first("text").alias("text"))
    texts = stored(texts.join(candidates, texts["id"] == candidates["node"]).select("id", "root", "text"), "candidate-texts")
    sizes = texts.groupBy("root").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / F.lit(chunk)), F.ceil(F.sum(F.length("text")) / F.lit(room))).cast("int").alias("parts"))
    sized = texts.join(sizes, "root").withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: (x != F.col("own")) | (F.col("parts") == 1))
    pairs = sized.select("id", "root", "text", "own", F.explode(others).alias("other"))
    groups = pairs.select("id", "text", F.xxhash64("root", F.least("own", "other"), F.greatest("own", "other")).alias("k"))
    named = _named(distinct.select("id", "first"), _links(groups))
    return rows.where("doc_id is null").select("doc_id", F.lit(None).cast("long").alias("component_id")).unionByName(
        own.join(named, "id").select("doc_id", "component_id"))


def hex64(fingerprint) -> F.Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")
