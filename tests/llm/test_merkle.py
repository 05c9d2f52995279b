"""The manifest against a plain recursive tree, on groups of many sizes, with nulls, repeats and clashing columns."""

from __future__ import annotations

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from jobmart.llm import merkle


def h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def climb(nodes: list[str]) -> tuple[str, list[str]]:
    """Root and, for each leaf, its siblings' digests joined."""
    ways, owners = [""] * len(nodes), [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, above = [], []
        for i in range(0, len(nodes), 8):
            run = nodes[i:i + 8]
            for k, mine in enumerate(owners[i:i + 8]):
                for d in mine:
                    ways[d] += "".join(run[:k] + run[k + 1:])
            up.append(h("".join(run)))
            above.append(sum(owners[i:i + 8], []))
        nodes, owners = up, above
    return nodes[0], ways


def plain(rows):
    """(id, leaf, subroot, root, proof) of (id, group, text), ids ascending in each group."""
    told = [f"{len(str(i).encode())}:{i}" if i is not None else "-" for i, _, _ in rows]
    said = ["-" if t is None else f"{len(t.encode())}:{t}" for _, _, t in rows]
    leaves = [(g, i, h(a + b)) for (i, g, _), a, b in zip(rows, told, said, strict=True)]
    groups = {}
    for g, i, leaf in sorted(leaves, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2])):
        groups.setdefault(g, []).append((i, leaf))
    trees = [climb([leaf for _, leaf in g]) for g in groups.values()]
    root, tops = climb([t[0] for t in trees])
    return sorted(((i, leaf, sub, root, h(way + top)) for g, (sub, ways), top in zip(groups.values(), trees, tops, strict=True)
                   for (i, leaf), way in zip(g, ways, strict=True)), key=repr)


def proofs(df, **more):
    tree = merkle.manifest(df, ["id", "text"], tree="group", key="id", **more)
    rows = merkle.proofs(tree).collect()
    got = sorted(((r.id, r.leaf.hex(), r.subroot.hex(), r.root.hex(), r.proof_sha256.hex()) for r in rows), key=repr)
    return tree, rows, got


@pytest.mark.parametrize("fan_height", [4, 1, 2])
def test_manifest_against_a_plain_tree(spark, monkeypatch, fan_height):
    monkeypatch.setattr(merkle, "HEIGHT", fan_height)  # small blocks make several tables
    monkeypatch.setattr(merkle, "LEAVES", merkle.FAN ** fan_height)
    sizes = {None: 1, "": 2, "a": 8, "b": 9, "é": 64, "Z": 65, "zz": 150, "~": 1}
    rows = [(1000 * k + i, g, f"text {i} É") for k, (g, n) in enumerate(sizes.items()) for i in range(n)]
    rows += [(None, "a", "no id"), (None, "a", "no id"), (2000, "a", None), (2000, "a", ""), (2000, "a", None), (7, "b", "long " * 50_000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "id long, group string, text string, TREE string, digest int").repartition(5)
    changed = F.when(F.col("id") % 3 == 0, merkle.digest(F.col("id"), F.upper("text")))
    tree, found, got = proofs(df, claim=changed)
    assert got == plain(rows)
    assert tree.root().hex() == got[0][3]
    for r in found:
        tampered = r.id is not None and r.id % 3 == 0 and r.leaf.hex() not in {h(f"{len(str(r.id))}:{r.id}-"), h(f"{len(str(r.id))}:{r.id}0:")}
        assert r.verified == (not tampered) == (r.folded_root == r.root)
        assert merkle.fold(r.leaf, r.way) == r.root


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(5, None, None)], "id long, group string, text string")
    _, rows, got = proofs(one)
    assert got == plain([(5, None, None)]) and rows[0].proof_sha256.hex() == h("") and rows[0].root == rows[0].leaf
    tree, rows, _ = proofs(one.where("false"))
    assert rows == [] and tree.root() is None


def test_addresses_fill_the_block_and_halve_it():
    for height in range(5):
        levels = merkle.addresses(height)
        assert [len(x) for x in levels] == [8 ** d for d in range(height + 1)]
        assert sorted(a for x in levels for a in x.tolist()) == list(range(merkle.size(height)))
    levels = merkle.addresses(3)  # two levels on top, then 64 / 8 subtrees of two levels each
    assert levels[0][0] == 0 and levels[1].tolist() == list(range(1, 9))
    assert levels[2][:3].tolist() == [9, 18, 27] and levels[3][:9].tolist() == [*range(10, 18), 19]
