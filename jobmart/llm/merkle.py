"""Merkle manifest of a dataset: a hash tree per group of rows, and one tree over their roots.

Leaves of a group ascend by key; every eight consecutive nodes hash to one until one is left. A tree is stored
as aligned blocks of four levels above their leaves. Inside a block the nodes lie in van Emde Boas order: the
subtree's upper half of levels first, then each lower subtree, every one laid out in the same way. Addresses
come from arithmetic on level and index alone, in building and in looking siblings up. The roots of a table of
blocks are the leaves of the next table, so a billion rows take three tables.

Spark ranks the rows by a range shuffle of digests (texts are hashed where they are read), deals whole blocks
to tasks, and joins each block with the path above it; a task holds one block at a time.

Nulls: a null field is written as `-`. A null group is a group, the first. Rows with a null key come first in
theirs, rows with equal keys by their digest. An empty table has no rows in its proofs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jobmart.llm.common import partitions, stored

#: Nodes hashed together, and levels of a block above its leaves.
FAN = 8
HEIGHT = 4
LEAVES = FAN ** HEIGHT
DIGEST = 32

#: ``tree`` is the group; ``block`` the block's place in its table; ``total`` the leaves of the tree in this table.
BLOCKS = "tree string, block long, total long, height int, ids array<long>, claims array<binary>, n int, nodes binary, top binary"


def size(height: int) -> int:
    return (FAN ** (height + 1) - 1) // (FAN - 1)


@cache
def addresses(height: int) -> list[np.ndarray]:
    """For each depth of a full tree of that height, the places of its nodes from left to right."""
    levels = height + 1
    if levels == 1:
        return [np.zeros(1, np.int64)]
    upper = levels // 2
    top, below = addresses(upper - 1), addresses(levels - upper - 1)
    starts = size(upper - 1) + np.arange(FAN ** upper, dtype=np.int64) * size(levels - upper - 1)
    return top + [(starts[:, None] + part).reshape(-1) for part in below]


@cache
def _listed(height: int) -> list[list[int]]:
    return [a.tolist() for a in addresses(height)]


def height_of(total: int) -> int:
    height = 0
    while FAN ** height < total:
        height += 1
    return height


def build(leaves: list[bytes], height: int) -> bytes:
    """The nodes of a block in van Emde Boas order; places without a node are zero."""
    nodes = np.zeros((size(height), DIGEST), np.uint8)
    places = addresses(height)
    level = b"".join(leaves)
    for depth in range(height, -1, -1):
        nodes[places[depth][:len(level) // DIGEST]] = np.frombuffer(level, np.uint8).reshape(-1, DIGEST)
        if depth:
            text, step = level.hex().encode(), 2 * DIGEST * FAN
            level = b"".join(sha256(text[i:i + step]).digest() for i in range(0, len(text), step))
    return nodes.tobytes()


def path(nodes: bytes, height: int, n: int, i: int) -> bytes:
    """From leaf ``i`` of a block with ``n`` leaves to its root, for each level: the place in the run, the number
    of siblings, the siblings."""
    out = []
    for depth in range(height, 0, -1):
        first = i - i % FAN
        run = _listed(height)[depth][first:min(first + FAN, n)]
        place = i - first
        out.append(bytes((place, len(run) - 1)))
        out += [nodes[DIGEST * a:DIGEST * (a + 1)] for k, a in enumerate(run) if k != place]
        i, n = i // FAN, -(-n // FAN)
    return b"".join(out)


def steps(way: bytes):
    """(place, siblings) of each level of a path."""
    at = 0
    while at < len(way):
        place, others = way[at], way[at + 1]
        yield place, way[at + 2:at + 2 + DIGEST * others]
        at += 2 + DIGEST * others


def fold(leaf: bytes, way: bytes) -> bytes:
    """The root that a leaf and a path lead to."""
    for place, siblings in steps(way):
        run = siblings[:DIGEST * place] + leaf + siblings[DIGEST * place:]
        leaf = sha256(run.hex().encode()).digest()
    return leaf


def digest(*fields: Column) -> Column:
    """Of values written as byte count, colon and value; integers in decimal."""
    texts = [f.cast("string") for f in fields]
    told = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*told).cast("binary"), 256))


def _ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` (stored) with their ``position`` in the tree and its ``total``.

    The place within a partition comes from one sorted pass, what lies before it from counts per tree and partition.
    """
    spark = rows.sparkSession
    by = ["tree", *order]
    ordered = rows.repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by)
    ordered = stored(ordered.withColumn("at", F.monotonically_increasing_id()), "merkle-order").withColumn("part", F.shiftright("at", 33))
    runs = ordered.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    tree = Window.partitionBy("tree")
    runs = runs.select(F.col("tree").alias("run_tree"), F.col("part").alias("run_part"), "first",
                       (F.sum("n").over(tree.orderBy("part")) - F.col("n")).alias("before"), F.sum("n").over(tree).alias("total"))
    same = F.col("tree").eqNullSafe(F.col("run_tree")) & (F.col("part") == F.col("run_part"))
    return ordered.join(runs, same).withColumn("position", F.col("before") + F.col("at") - F.col("first"))


def _blocks(leaves: DataFrame) -> DataFrame:
    """A row for each block of ``leaves`` (tree, position, total, id, claim, digest)."""

    def block(key, rows):
        total = rows[0][0]
        height = min(HEIGHT, height_of(total))
        nodes = build([r[3] for r in rows], height)
        return *key, total, height, [r[1] for r in rows], [r[2] for r in rows], len(rows), nodes, nodes[:DIGEST]

    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.int32(), pa.binary(), pa.binary()]
    names = ["tree", "block", "total", "height", "ids", "claims", "n", "nodes", "top"]

    def apply(batches):
        key, rows = None, []
        for b in batches:
            for tree, at, *rest in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                if (tree, at) != key and rows:
                    yield _batch([block(key, rows)], names, kinds)
                    rows = []
                key = tree, at
                rows.append(rest)
        if rows:
            yield _batch([block(key, rows)], names, kinds)

    dealt = leaves.select("tree", F.expr(f"position div {LEAVES}").alias("block"), "total", "id", "claim", "digest", "position")
    dealt = dealt.repartition(partitions(leaves.sparkSession), "tree", "block").sortWithinPartitions("tree", "block", "position")
    return stored(dealt.drop("position").mapInArrow(apply, BLOCKS), "merkle-blocks")


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _grow(leaves: DataFrame, most: int) -> list[DataFrame]:
    """The tables of blocks over trees of at most ``most`` leaves, lowest first."""
    tables = [_blocks(leaves)]
    while most > LEAVES:
        most = -(-most // LEAVES)
        roots = tables[-1].where(f"total > {LEAVES}").select(
            "tree", F.col("block").alias("position"), F.expr(f"(total + {LEAVES - 1}) div {LEAVES}").alias("total"),
            F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("claim"), F.col("top").alias("digest"))
        tables.append(_blocks(roots))
    return tables


def _roots(tables: list[DataFrame]) -> DataFrame:
    """tree and the digest of its root."""
    found = [t.where(f"total <= {LEAVES}").select("tree", F.col("top").alias("digest")) for t in tables]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _most(leaves: DataFrame) -> int:
    return leaves.agg(F.max("total")).first()[0] or 0


@dataclass
class Manifest:
    """``leaves``: id, tree, position, digest. ``lower``: the tables of blocks of all groups' trees. ``groups``: tree,
    position, digest of each group's root. ``upper``: the tables of blocks over those roots."""

    leaves: DataFrame
    lower: list[DataFrame]
    groups: DataFrame
    upper: list[DataFrame]

    def root(self) -> bytes | None:
        """The digest of the whole dataset; None for an empty one."""
        found = _roots(self.upper).first()
        return bytes(found.digest) if found else None


def manifest(rows: DataFrame, fields: list[str], tree: str, key: str, claim: Column | None = None) -> Manifest:
    """The hash trees of ``rows``: one per value of column ``tree``, its leaves ordered by the integer column ``key``.

    A leaf is the digest of ``fields`` in that order. ``claim``, a digest for some rows (else null), goes along for
    ``proofs`` to check in the leaf's place.
    """
    hashed = stored(rows.select(F.col(tree).cast("string").alias("tree"), F.col(key).cast("long").alias("id"), digest(*[F.col(f"`{f}`") for f in fields]).alias("digest"),
                                (F.lit(None) if claim is None else claim).cast("binary").alias("claim")), "merkle-leaves")
    leaves = _ranked(hashed, "id", "digest", "claim")
    lower = _grow(leaves, _most(leaves))
    roots = _roots(lower).select(F.lit(None).cast("string").alias("tree"), F.col("tree").alias("name"), "digest")
    groups = _ranked(stored(roots, "merkle-roots"), "name")
    upper = _grow(groups.withColumns({"id": F.lit(None).cast("long"), "claim": F.lit(None).cast("binary")}), _most(groups))
    return Manifest(leaves.select("id", "tree", "position", "digest"), lower, groups.select(F.col("name").alias("tree"), "position", "digest"), upper)


def _climb(tables: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest blocks, each with ``way``, the path of its root to the very top, and the columns beside it in
    ``above`` (up_tree, way, ...), a row for each tree."""
    more = [c for c in above.columns if c != "up_tree"]
    ways = None
    for table in reversed(tables):
        whole = table.where(f"total <= {LEAVES}").join(above, F.col("tree").eqNullSafe(F.col("up_tree")))
        joined = whole.select(*table.columns, *more)
        if ways is not None:
            same = F.col("tree").eqNullSafe(F.col("up_tree")) & (F.col("block") == F.col("up_block"))
            joined = joined.unionByName(table.where(f"total > {LEAVES}").join(ways, same).select(*table.columns, *more))
        if table is tables[0]:
            return joined
        ways = _paths(joined, more)
    raise ValueError("a manifest has at least one table")


def _paths(blocks: DataFrame, more: list[str]) -> DataFrame:
    """(up_tree, up_block, way, ...) of each leaf of ``blocks``: its own path and its block's."""

    def apply(batches):
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                n = r["n"]
                ways = [path(r["nodes"], r["height"], n, k) + r["way"] for k in range(n)]
                rest = [pa.array([r[c]] * n, b.schema.field(c).type) for c in more if c != "way"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["tree"]] * n, pa.string()), pa.array(np.arange(n, dtype=np.int64) + r["block"] * LEAVES), pa.array(ways, pa.binary()), *rest],
                    ["up_tree", "up_block", "way", *[c for c in more if c != "way"]])

    rest = [c for c in more if c != "way"]
    schema = "up_tree string, up_block long, way binary" + "".join(f", {c} binary" for c in rest)
    return blocks.select("tree", "block", "height", "n", "nodes", *more).mapInArrow(apply, schema)


def proofs(tree: Manifest, siblings: bool = True) -> DataFrame:
    """id, tree, leaf, subroot, root, the SHA-256 of the siblings' digests in hex from the leaf's level up, the root
    that the claim (else the leaf) folds to, whether that is the root and, unless left out, the path itself."""
    top = _climb(tree.upper, _roots(tree.upper).select(F.col("tree").alias("up_tree"), F.lit(b"").alias("way"), F.col("digest").alias("root")))
    ways = _paths(top, ["way", "root"]).drop("up_tree")
    above = tree.groups.join(ways, F.col("position") == F.col("up_block")).select(
        F.col("tree").alias("up_tree"), "way", "root", F.col("digest").alias("subroot"))
    blocks = _climb(tree.lower, stored(above, "merkle-above"))
    names = ["id", "tree", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "way"][:9 if siblings else 8]
    kinds = [pa.int64(), pa.string(), *[pa.binary()] * 5, pa.bool_(), pa.binary()][:len(names)]

    def apply(batches):
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                nodes, height, n, up = r["nodes"], r["height"], r["n"], r["way"]
                at = _listed(height)[height]
                above = b"".join(s for _, s in steps(up))
                rows = []
                for k in range(n):
                    way = path(nodes, height, n, k)
                    leaf = nodes[DIGEST * at[k]:DIGEST * (at[k] + 1)]
                    inner = b"".join(s for _, s in steps(way)) + above
                    folded = fold(r["claims"][k] or leaf, way + up)
                    rows.append((r["ids"][k], r["tree"], leaf, r["subroot"], r["root"], sha256(inner.hex().encode()).digest(),
                                 folded, folded == r["root"], way + up)[:len(names)])
                yield _batch(rows, names, kinds)

    wanted = ["tree", "height", "n", "ids", "claims", "nodes", "way", "root", "subroot"]
    schema = "id long, tree string, leaf binary, subroot binary, root binary, proof_sha256 binary, folded_root binary, verified boolean"
    return blocks.select(*wanted).mapInArrow(apply, schema + ", way binary" * siblings)
