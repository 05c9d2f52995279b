"""Hard negatives by a multiway tree of split points with distance ranges.

Scores are inner products of vectors of integers. One more coordinate gives all rows the same length, so a score is
a Euclidean distance, and a window of scores an annulus around the anchor. A node of the tree has up to eight split points; each
row belongs to the nearest. For each pair of them the node keeps the least and the greatest distance from the one to
the rows of the other: a subtree is left out for an anchor if by some split point's range none of its rows can lie in the
annulus. Leaves are scored exactly.

The upper part of the tree is fitted on a bounded sample; all rows then go down it, and its ranges are those of all
rows. Its leaves, the cells, are dealt in parts of bounded size (a vector repeated a million times makes many parts of
one cell), each with a tree of its own. Anchors travel in blocks, sent only to the parts of cells that may hold
answers; a bound from the sample comes first, narrower ones while a part is searched. A task holds one part and one block. The positives
of all anchors are found first, then the negatives in the windows that they set.

A row with a null id, a null label, a null vector or a component that is null or not finite takes no part. Vectors of
unequal length count as filled up with zeros. Ids need not be unique: no row is an answer to an anchor of its own id,
and equal anchors (id, label and vector) are one. Ties go to the smaller id. Inner products must fit in 63 bits.
"""

from __future__ import annotations

import io
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jobmart.llm.common import partitions, stored

#: Rows that the upper tree is fitted on, the first by hash.
SAMPLE = 4096
#: Split points of a node, rows of a leaf (not fewer), candidates among which split points are chosen.
FAN, LEAF, CANDIDATES = 8, 64, 64
#: Rows of a part on average, anchors of a block, blocks that one copy of a part serves.
PART, QUERIES, BLOCKS = 8192, 512, 256
NONE = np.iinfo(np.int32).min


@dataclass
class Tree:
    """Nodes as arrays: ``child`` is a node, ``~leaf`` or NONE; ``low[n, i, j]`` and ``high`` range over the distances
    from split point i to the rows below child j."""

    root: int
    splits: np.ndarray
    low: np.ndarray
    high: np.ndarray
    child: np.ndarray

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, root=self.root, splits=self.splits, low=self.low, high=self.high, child=self.child)
        return out.getvalue()

    @staticmethod
    def unpacked(data: bytes) -> Tree:
        x = np.load(io.BytesIO(data), allow_pickle=False)
        return Tree(int(x["root"]), x["splits"], x["low"], x["high"], x["child"])

    def descend(self, points: np.ndarray, low: np.ndarray | None = None, high: np.ndarray | None = None) -> np.ndarray:
        """The leaf of each point; widens the ranges ``low`` and ``high`` by the points."""
        at = np.full(len(points), self.root, np.int64)
        while (nodes := np.unique(at[at >= 0])).size:
            for node in nodes.tolist():
                rows = np.flatnonzero(at == node)
                d = distances(points[rows], self.splits[node])
                near = np.where(self.child[node] == NONE, np.inf, d).argmin(1)
                at[rows] = self.child[node][near]
                if low is not None:
                    for j in np.unique(near).tolist():
                        own = d[near == j]
                        low[node, :, j] = np.minimum(low[node, :, j], own.min(0))
                        high[node, :, j] = np.maximum(high[node, :, j], own.max(0))
        return ~at


def distances(points: np.ndarray, splits: np.ndarray) -> np.ndarray:
    square = (points * points).sum(1)[:, None] + (splits * splits).sum(1) - 2 * (points @ splits.T)
    return np.sqrt(np.maximum(square, 0))


def choose(points: np.ndarray) -> np.ndarray:
    """Split points: of evenly spaced candidates, always the one farthest from those taken."""
    candidates = points[np.linspace(0, len(points) - 1, min(CANDIDATES, len(points))).astype(int)]
    taken = [0]
    nearest = distances(candidates, candidates[:1])[:, 0]
    while len(taken) < min(FAN, len(candidates)):
        taken.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(candidates, candidates[taken[-1:]])[:, 0])
    return candidates[taken]


def grow(points: np.ndarray, leaf: int) -> tuple[Tree, list[np.ndarray]]:
    """A tree over points (one row each) and the rows of its leaves; a node has more than ``leaf`` rows, at least FAN."""
    splits, low, high, child, leaves = [], [], [], [], []
    todo, root = [(np.arange(len(points)), -1, 0)], ~0
    while todo:
        rows, parent, slot = todo.pop()
        near = None
        if len(rows) > leaf:
            s = choose(points[rows])
            d = distances(points[rows], s)
            near = d.argmin(1)
        if near is None or (near == near[0]).all():
            leaves.append(rows)
            name = ~(len(leaves) - 1)
        else:
            name = len(splits)
            splits.append(s)
            low.append(np.full((FAN, FAN), np.inf))
            high.append(np.full((FAN, FAN), -np.inf))
            child.append(np.full(FAN, NONE, np.int64))
            for j in np.unique(near).tolist():
                low[-1][:, j], high[-1][:, j] = d[near == j].min(0), d[near == j].max(0)
                todo.append((rows[near == j], name, j))
        if parent < 0:
            root = name
        else:
            child[parent][slot] = name
    if not splits:
        return Tree(root, np.zeros((0, FAN, points.shape[1])), np.zeros((0, FAN, FAN)), np.zeros((0, FAN, FAN)), np.zeros((0, FAN), np.int64)), leaves
    return Tree(root, np.array(splits), np.array(low), np.array(high), np.array(child)), leaves


def search(tree: Tree, anchors: np.ndarray, longest: float, annulus: Callable, visit: Callable) -> None:
    """Calls ``visit(leaf, which)`` for each leaf and the anchors that it may hold answers for; ``annulus(which)`` gives
    their least and greatest distances as known by then."""
    square = (anchors * anchors).sum(1) + longest ** 2
    slack = 1e-6 * (1 + np.sqrt(square.max(initial=0)))
    everyone = np.arange(len(anchors))
    todo = [(tree.root, everyone, np.zeros(len(anchors)), np.full(len(anchors), np.inf))]
    while todo:
        node, which, least, most = todo.pop()
        inner, outer = annulus(which)
        alive = (least <= outer + slack) & (most >= inner - slack)
        which = which[alive]
        if not len(which):
            continue
        if node < 0:
            visit(~node, which)
            continue
        children = [j for j in range(FAN) if tree.child[node, j] != NONE]
        d = np.sqrt(np.maximum(square[which][:, None] - 2 * (anchors[which] @ tree.splits[node][:, :-1].T), 0))
        near = d.mean(0)
        for j in sorted(children, key=lambda j: -near[j]):  # the nearest is searched first
            lo, hi = tree.low[node, :, j], tree.high[node, :, j]
            todo.append((int(tree.child[node, j]), which, np.maximum(d - hi, lo - d).max(1), (d + hi).min(1)))


class Best:
    """The first ``k`` answers of each slot, by descending score, then ascending id."""

    def __init__(self, slots: int, k: int, bound: np.ndarray | None = None):
        self.k, self.bound = k, np.full(slots, -np.inf) if bound is None else bound
        self.kept, self.new, self.size = [np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)], [], 0

    def add(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        self.new.append((slots, scores, ids))
        self.size += len(slots)
        if self.size > max(4096, 2 * len(self.kept[0])):
            self.first()

    def first(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slots, scores, ids = (np.concatenate(x) for x in zip(self.kept, *self.new, strict=True))
        order = np.lexsort((ids, -scores, slots))
        slots, scores, ids = slots[order], scores[order], ids[order]
        starts = np.searchsorted(slots, slots)
        place = np.arange(len(slots)) - starts
        last = place == self.k - 1
        self.bound[slots[last]] = np.maximum(self.bound[slots[last]], scores[last])
        keep = place < self.k
        self.kept, self.new, self.size = [slots[keep], scores[keep], ids[keep]], [], 0
        return tuple(self.kept)


def products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of whole numbers; doubles hold them where ``exact``."""
    return a @ b.T if exact else (a.astype(np.int64) @ b.astype(np.int64).T)


@dataclass
class Space:
    """What is known of all rows: components of a vector, the greatest length, whether doubles hold every product."""

    dims: int
    longest: float
    exact: bool
    rows: int

    def augmented(self, vectors: np.ndarray) -> np.ndarray:
        x = vectors.astype(float)
        rest = np.sqrt(np.maximum(self.longest ** 2 - (x * x).sum(1), 0))
        return np.concatenate([x, rest[:, None]], 1)

    def matrix(self, data: list[bytes] | bytes) -> np.ndarray:
        raw = np.frombuffer(data if isinstance(data, bytes) else b"".join(data), "<i8").reshape(-1, max(self.dims, 1))
        return raw.astype(float) if self.exact else raw

    def annulus(self, square: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances of scores from ``low`` to ``high``; ``square``: the anchors' squared lengths."""
        square = square + self.longest ** 2
        return np.sqrt(np.maximum(square - 2 * high, 0)), np.sqrt(np.maximum(square - 2 * low, 0))


def whole(vector: Column) -> Column:
    """Whether every component is a finite number."""
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def prepare(df: DataFrame, vec_id: str, label: str | Column, vector: str, scale: int) -> DataFrame:
    """id, label and the components times ``scale``, rounded down, of the rows that take part."""
    numbers = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("id"), (F.col(f"`{label}`") if isinstance(label, str) else label).cast("long").alias("label"), numbers.alias("x"))
    return rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & whole(F.col("x"))).select(
        "id", "label", F.transform("x", lambda x: F.floor(scale * x)).alias("x"))


def _space(rows: DataFrame) -> Space:
    square = F.aggregate("x", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    largest = F.array_max(F.transform("x", lambda x: F.abs(x.cast("double"))))
    n, dims, most, longest = rows.agg(F.count("*"), F.max(F.size("x")), F.max(largest), F.max(square)).first()
    dims, most, longest = dims or 0, most or 0.0, longest or 0.0
    if dims * most * most >= 2 ** 63:
        raise ValueError("inner products of these vectors don't fit in 63 bits")
    return Space(dims, float(np.sqrt(longest)), dims * most * most < 2 ** 53, n)


def _filled(vector: pa.Array, dims: int) -> np.ndarray:
    """Vectors of a batch as rows of ``dims`` integers."""
    flat, bounds = vector.flatten().to_numpy(zero_copy_only=False), vector.offsets.to_numpy()
    bounds = bounds - bounds[0]
    sizes = np.diff(bounds)
    out = np.zeros((len(sizes), max(dims, 1)), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - bounds[row]] = flat
    return out


def _bytes(matrix: np.ndarray) -> list[bytes]:
    return [r.tobytes() for r in np.ascontiguousarray(matrix, "<i8")]


@dataclass
class Index:
    """``parts``: cell, salt, ids, labels, vectors and the tree of each part. ``upper``: the tree whose leaves are the cells."""

    space: Space
    parts: DataFrame
    upper: Tree
    counts: dict[int, int]
    sample: tuple[np.ndarray, np.ndarray, np.ndarray]


def fit(rows: DataFrame) -> Index:
    """Index all ``rows`` (stored: id, label, x)."""
    spark, space = rows.sparkSession, _space(rows)
    drawn = rows.orderBy(F.xxhash64("id", "label", "x"), "id").limit(SAMPLE).collect()
    vectors = np.zeros((len(drawn), max(space.dims, 1)), np.int64)
    for v, r in zip(vectors, drawn, strict=True):
        v[:len(r.x)] = r.x
    sample = np.array([r.id for r in drawn], np.int64), np.array([r.label for r in drawn], np.int64), vectors.astype(float) if space.exact else vectors
    upper, leaves = grow(space.augmented(vectors), max(16, SAMPLE * PART // max(space.rows, 1)) if space.rows > PART else SAMPLE)
    shared = spark.sparkContext.broadcast((space, upper))

    def assign(batches):
        from pyspark import TaskContext
        space, upper = shared.value
        low, high = np.full(upper.low.shape, np.inf), np.full(upper.high.shape, -np.inf)
        counts, place = np.zeros(len(leaves), np.int64), TaskContext.get().partitionId() << 40
        names = ["cell", "place", "id", "label", "vector", "low", "high", "counts"]
        for b in batches:
            x = _filled(b.column(2), space.dims)
            cells = upper.descend(space.augmented(x), low, high)
            counts += np.bincount(cells, minlength=len(leaves))
            n = len(cells)
            yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(np.arange(place, place + n)), b.column(0), b.column(1), pa.array(_bytes(x), pa.binary()),
                                              *[pa.nulls(n, pa.binary())] * 3], names)
            place += n
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int32()), *[pa.nulls(1, pa.int64())] * 3, pa.nulls(1, pa.binary()),
                                          *[pa.array([a.tobytes()], pa.binary()) for a in (low, high, counts)]], names)

    schema = "cell int, place long, id long, label long, vector binary, low binary, high binary, counts binary"
    assigned = stored(rows.select("id", "label", "x").mapInArrow(assign, schema), "gnat-cells")

    def ranges(batches):
        for b in batches:
            for low, high, counts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                low, high, counts = np.frombuffer(low), np.frombuffer(high), np.frombuffer(counts, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(low))), pa.array(low), pa.array(high), pa.nulls(len(low), pa.int64())], ["slot", "low", "high", "n"])
                yield pa.RecordBatch.from_arrays([pa.array(-1 - np.arange(len(counts))), pa.nulls(len(counts), pa.float64()), pa.nulls(len(counts), pa.float64()), pa.array(counts)],
                                                 ["slot", "low", "high", "n"])

    found = assigned.where("cell is null").select("low", "high", "counts").mapInArrow(ranges, "slot long, low double, high double, n long")
    counts = {}
    for r in found.groupBy("slot").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).collect():  # the upper tree's size
        if r.slot < 0:
            counts[-1 - r.slot] = r.n
        else:
            upper.low.reshape(-1)[r.slot], upper.high.reshape(-1)[r.slot] = r.low, r.high
    parts = F.create_map(*[F.lit(x) for c, n in counts.items() for x in (c, -(-n // PART) or 1)]) if counts else F.lit(None).cast("map<int,int>")
    salted = assigned.where("cell is not null").withColumn("salt", F.pmod(F.xxhash64("place"), F.element_at(parts, F.col("cell"))).cast("int"))
    dealt = salted.select("cell", "salt", "id", "label", "vector").repartition(partitions(spark), "cell", "salt").sortWithinPartitions("cell", "salt", "id", "label")

    def build(batches):
        space, _ = shared.value

        def part(key, ids, labels, vectors):
            x = space.matrix(vectors)
            tree, leaves = grow(space.augmented(x), LEAF)
            order, sizes = np.concatenate(leaves), np.array([len(v) for v in leaves], "<i8")
            ids, labels = np.array(ids, "<i8")[order], np.array(labels, "<i8")[order]
            raw = [ids.tobytes(), labels.tobytes(), np.ascontiguousarray(x[order], "<i8").tobytes(), sizes.tobytes(), tree.packed()]
            return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()) for k in key] + [pa.array([r], pa.binary()) for r in raw],
                                              ["cell", "salt", "ids", "labels", "vectors", "sizes", "tree"])

        key, rows = None, ([], [], [])
        for b in batches:
            for cell, salt, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if key != (cell, salt) and rows[0]:
                    yield part(key, *rows)
                    rows = ([], [], [])
                key = cell, salt
                for column, value in zip(rows, row, strict=True):
                    column.append(value)
        if rows[0]:
            yield part(key, *rows)

    made = dealt.mapInArrow(build, "cell int, salt int, ids binary, labels binary, vectors binary, sizes binary, tree binary")
    return Index(space, stored(made, "gnat-parts"), upper, counts, sample)


#: Blocks of anchors: ``low`` and ``high`` are the windows of each anchor, ``slots`` of them; without any, positives are wanted.
BLOCK = "block long, ids binary, labels binary, vectors binary, slots int, low binary, high binary"
FOUND = "anchor long, slot int, score long, id long"


class Wanted:
    """Anchors of a block and their answers: the first ``k`` of the same label, or in each window of other labels."""

    def __init__(self, space: Space, row: dict, k: int, bound: bytes | None = None):
        self.space, self.k = space, k
        self.block, self.ids, self.labels = row["block"], np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
        self.vectors, self.slots = space.matrix(row["vectors"]), row["slots"]
        n = len(self.ids)
        self.numbers = np.frombuffer(row["numbers"], "<i8") if "numbers" in row else np.arange(n, dtype=np.int64)
        self.square = (self.vectors.astype(float) ** 2).sum(1)
        self.low, self.high = (np.frombuffer(row[c]).reshape(n, -1) if self.slots else None for c in ("low", "high"))
        start = np.full(n * max(self.slots, 1), -np.inf) if bound is None else np.frombuffer(bound).copy()
        if self.slots and bound is None:
            start = self.low.reshape(-1).copy()
        self.best = Best(len(start), k, start)

    def annulus(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bound = self.best.bound.reshape(len(self.ids), -1)[which]
        if not self.slots:
            return np.zeros(len(which)), self.space.annulus(self.square[which], bound[:, 0], bound[:, 0])[1]
        open_ = bound <= self.high[which]
        low, high = np.where(open_, bound, np.inf).min(1), np.where(open_, self.high[which], -np.inf).max(1)
        with np.errstate(invalid="ignore"):
            inner, outer = self.space.annulus(self.square[which], low, high)
        shut = ~open_.any(1)
        return np.where(shut, np.inf, inner), np.where(shut, -np.inf, outer)

    def score(self, which: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        """Take in rows: their exact scores with the anchors ``which``."""
        scores = products(self.vectors[which], vectors, self.space.exact)
        bound = self.best.bound.reshape(len(self.ids), -1)
        same = self.labels[which][:, None] == labels
        other = self.ids[which][:, None] != ids
        if not self.slots:
            a, b = np.nonzero(same & other & (scores >= bound[which]))
            self.best.add(which[a], scores[a, b], ids[b])
            return
        other &= ~same
        for w in range(self.slots):
            a, b = np.nonzero(other & (scores >= bound[which, w][:, None]) & (scores <= self.high[which, w][:, None]))
            self.best.add(which[a] * self.slots + w, scores[a, b], ids[b])

    def answers(self) -> list[pa.Array]:
        slots, scores, ids = self.best.first()
        width = max(self.slots, 1)
        return [pa.array(self.block + self.numbers[slots // width]), pa.array((slots % width).astype(np.int32)), pa.array(scores.astype(np.int64)), pa.array(ids)]

    def subset(self, which: np.ndarray) -> list[bytes | None]:
        window = [np.ascontiguousarray(x[which]).tobytes() if self.slots else None for x in (self.low, self.high)]
        bound = self.best.bound.reshape(len(self.ids), -1)[which]
        return [self.ids[which].tobytes(), self.labels[which].tobytes(), np.ascontiguousarray(self.vectors[which], "<i8").tobytes(), *window,
                self.numbers[which].tobytes(), np.ascontiguousarray(bound).tobytes()]


def _answers(index: Index, blocks: DataFrame, k: int) -> DataFrame:
    """The first ``k`` answers (anchor, slot, score, id, rank) of all blocks' anchors in the whole index."""
    spark = blocks.sparkSession
    copies = max(1, -(-blocks.count() // BLOCKS))
    shared = spark.sparkContext.broadcast((index.space, index.upper, index.counts, index.sample))
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5, pa.int32(), *[pa.binary()] * 4]
    names = ["cell", "salt", "copy", "block", "ids", "labels", "vectors", "sizes", "tree", "slots", "low", "high", "numbers", "bound"]
    schema = "cell int, salt int, copy int, block long, ids binary, labels binary, vectors binary, sizes binary, tree binary, slots int, low binary, high binary, numbers binary, bound binary"

    def route(batches):
        space, upper, counts, (ids, labels, vectors) = shared.value
        for b in batches:
            for i in range(b.num_rows):
                wanted = Wanted(space, b.slice(i, 1).to_pylist()[0], k)
                wanted.score(np.arange(len(wanted.ids)), ids, labels, vectors)
                wanted.best.first()
                # Only the bound stays: the sample's rows are found again in their parts.
                goes = []
                search(upper, wanted.vectors.astype(float), space.longest, wanted.annulus, lambda cell, which, goes=goes: goes.append((cell, which)))
                for cell, which in goes:
                    own, own_labels, own_vectors, low, high, numbers, bound = wanted.subset(which)
                    for salt in range(-(-counts.get(cell, 0) // PART)):
                        row = [cell, salt, int(wanted.block >> 16) % copies, wanted.block, own, own_labels, own_vectors, None, None, wanted.slots, low, high, numbers, bound]
                        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names)

    def look(batches):
        space = shared.value[0]
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                if row["tree"] is not None:
                    ids, labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
                    vectors, tree = space.matrix(row["vectors"]), Tree.unpacked(row["tree"])
                    bounds = np.concatenate([[0], np.cumsum(np.frombuffer(row["sizes"], "<i8"))]).tolist()
                    continue
                wanted = Wanted(space, row, k, row["bound"])

                def visit(leaf, which, wanted=wanted, ids=ids, labels=labels, vectors=vectors, bounds=bounds):
                    rows = slice(bounds[leaf], bounds[leaf + 1])
                    wanted.score(which, ids[rows], labels[rows], vectors[rows])

                search(tree, wanted.vectors.astype(float), space.longest, wanted.annulus, visit)
                yield pa.RecordBatch.from_arrays(wanted.answers(), ["anchor", "slot", "score", "id"])

    routed = blocks.mapInArrow(route, schema)
    parts = index.parts.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    both = parts.unionByName(routed, allowMissingColumns=True).select(*names)
    dealt = both.repartition(partitions(spark), "cell", "salt", "copy").sortWithinPartitions("cell", "salt", "copy", F.col("tree").isNull(), "block")
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return dealt.mapInArrow(look, FOUND).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _gather(index: Index, anchors: DataFrame) -> DataFrame:
    """Blocks of anchors (id, label, x) that are near one another."""
    shared = anchors.sparkSession.sparkContext.broadcast((index.space, index.upper))

    def place(batches):
        space, upper = shared.value
        for b in batches:
            x = _filled(b.column(2), space.dims)
            yield pa.RecordBatch.from_arrays([pa.array(upper.descend(space.augmented(x)).astype(np.int32)), b.column(0), b.column(1), pa.array(_bytes(x), pa.binary())],
                                             ["cell", "id", "label", "vector"])

    def block(batches):
        from pyspark import TaskContext
        number, rows = TaskContext.get().partitionId() << 40, []

        def out():
            raw = [b"".join(np.int64(r[i]).tobytes() for r in rows) for i in (0, 1)] + [b"".join(r[2] for r in rows)]
            columns = [pa.array([number]), *[pa.array([r], pa.binary()) for r in raw], pa.array([0], pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["block", "ids", "labels", "vectors", "slots", "low", "high"])

        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                rows.append(row)
                if len(rows) == QUERIES:
                    yield out()
                    number, rows = number + (1 << 16), []
        if rows:
            yield out()

    placed = anchors.dropDuplicates(["id", "label", "x"]).mapInArrow(place, "cell int, id long, label long, vector binary")
    by = ["cell", "id", "label", "vector"]
    n = max(1, -(-index.space.rows // (100 * QUERIES)))
    return stored(placed.repartitionByRange(min(n, partitions(anchors.sparkSession)), *by).sortWithinPartitions(*by).mapInArrow(block, BLOCK), "gnat-anchors")


def mine(rows: DataFrame, anchors: Column, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """For each anchor among ``rows`` (prepared) and each of its first ``positives``: the first ``negatives`` rows of
    another label whose score is from ``low`` to ``high`` per cent of the positive's.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score. An empty table gives no row.
    """
    rows = stored(rows, "gnat-rows")
    index = fit(rows)
    blocks = _gather(index, rows.where(anchors))
    near = stored(_answers(index, blocks, positives), "gnat-positives")

    def windows(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                n = len(row["ids"]) // 8
                lower, upper = np.full((n, positives), np.inf), np.full((n, positives), -np.inf)
                for p in row["found"] or []:
                    at = p["anchor"] - row["block"], p["rank"] - 1
                    if -(-low * p["score"] // 100) <= high * p["score"] // 100:
                        lower[at], upper[at] = -(-low * p["score"] // 100), high * p["score"] // 100
                columns = [row["block"], row["ids"], row["labels"], row["vectors"], positives, lower.tobytes(), upper.tobytes()]
                kinds = [pa.int64(), *[pa.binary()] * 3, pa.int32(), *[pa.binary()] * 2]
                yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(columns, kinds, strict=True)],
                                                 ["block", "ids", "labels", "vectors", "slots", "low", "high"])

    told = near.groupBy(F.expr("anchor - anchor % 65536").alias("block")).agg(F.collect_list(F.struct("anchor", "rank", "score")).alias("found"))  # a block's at most
    asked = stored(blocks.join(told, "block", "left").select("block", "ids", "labels", "vectors", "found").mapInArrow(windows, BLOCK), "gnat-windows")
    found = _answers(index, asked, negatives).select("anchor", (F.col("slot") + 1).alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))

    def names(batches):
        for b in batches:
            for block, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = np.frombuffer(ids, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(block, block + len(ids))), pa.array(ids)], ["anchor", "anchor_id"])

    who = blocks.select("block", "ids").mapInArrow(names, "anchor long, anchor_id long")
    pairs = near.select("anchor", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).join(who, "anchor")
    return found.join(pairs, ["anchor", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
