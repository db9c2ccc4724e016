"""Merkle manifest of a dataset, with a proof per row and the root folded again from a (tampered) row.

A leaf is the hash of a row's fields, made in column functions; texts go no further. Leaves of one language
are numbered over ranges. A superblock is ``2**LEVELS`` consecutive nodes of one tree: its lower levels need
no other node. The roots of the superblocks make the next, 4096 times smaller table of nodes, and so on until
a tree is one block; the roots of the languages are the leaves of the last tree. On the way back the nodes
of a superblock are cogrouped with the one row that it needs from outside, its siblings up to the root, and
one function finishes the local reduction, joins the proofs and folds. A task holds one superblock, whatever
the size of a language or the number of languages.

Where a row is tampered with, ``n_chars`` grows by one; null stays null. Null fields are hashed as ``-``; a
null language is a tree of its own, before the others. Rows with one id stand in the order of their leaves.
An empty table gives an empty result. Columns beyond the five fields are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.operators.order import RANGE_ROWS, global_index, group_index
from docsift.operators.stored import stored

LEVELS = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
_TOP = "tree string, place long, n long, node string"
_OUTER = "tree string, block long, up array<string>, root string"


def hashed(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(**changed: Column) -> Column:
    """The hash of a row's fields: each its length in bytes, a colon and the value, or ``-``."""

    def field(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[field(f) for f in FIELDS]), 256)


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    return (n - 1).bit_length()


def reduce_levels(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of every level, from the given one to ``levels`` above; an odd last node is hashed alone."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([hashed("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return out


def siblings(levels: list[list[str]], at: int) -> list[str]:
    """Per level below the top one: the other node of the run with the side it stands on, or nothing."""
    out = []
    for nodes in levels[:-1]:
        other = at ^ 1
        out.append(("<" if at & 1 else ">") + nodes[other] if other < len(nodes) else "")
        at >>= 1
    return out


def fold(node: str, path: list[str]) -> str:
    """The root that a node and its siblings give."""
    for step in path:
        node = hashed(step[1:] + node if step[:1] == "<" else node + step[1:])
    return node


def proof(path: list[str]) -> str:
    """One hash of the siblings, from the lowest level to the highest."""
    return hashed("".join(step[1:] for step in path))


def _block_roots(nodes: DataFrame, levels: int) -> DataFrame:
    """tree, place, n, node of the superblocks' roots."""

    def root(block: pa.Table) -> pa.Table:
        rows = block.select(["place", "node"]).sort_by("place")
        n, first = block.column("n")[0].as_py(), rows.column("place")[0].as_py()
        local = min(levels, height(n))
        top = reduce_levels(rows.column("node").to_pylist(), local)[-1][0]
        return pa.table({"tree": block.column("tree")[:1], "place": [first >> levels], "n": [-(-n >> levels)], "node": [top]})

    keyed = nodes.select("tree", "place", "n", "node", F.shiftright("place", levels).alias("block"))
    return keyed.groupBy("tree", "block").applyInArrow(root, _TOP)


def _with_outer(nodes: DataFrame, outer: DataFrame, finish: Callable[[pa.Table, int, list[str], str], pa.Table], schema: str, levels: int) -> DataFrame:
    """Cogroups every superblock with its siblings up to the root; ``finish`` gets it in the order of its nodes."""

    def both(block: pa.Table, above: pa.Table) -> pa.Table:
        local = min(levels, height(block.column("n")[0].as_py()))
        return finish(block.sort_by("place"), local, above.column("up")[0].as_py(), above.column("root")[0].as_py())

    keyed = nodes.withColumn("block", F.shiftright("place", levels))
    return keyed.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInArrow(both, schema)


def outer_nodes(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """tree, block, up, root: for every node of every tree, its siblings up to the root of the tree.

    ``nodes`` has tree, place, n (nodes of the tree) and node; ``block`` is the place.
    """

    def listed(block: pa.Table, local: int, up: list[str], root: str) -> pa.Table:
        reduced = reduce_levels(block.column("node").to_pylist(), local)
        paths = [siblings(reduced, i) + up for i in range(block.num_rows)]
        return pa.table({"tree": block.column("tree"), "block": block.column("place"), "up": pa.array(paths, pa.list_(pa.string())), "root": [root] * block.num_rows})

    tops = stored(_block_roots(nodes, levels))
    most = tops.agg(F.max("n")).first()[0] or 0
    if most > 1:
        above = outer_nodes(tops, levels)
    else:  # every tree is one block, whose root is the tree's
        above = tops.select("tree", F.col("place").alias("block"), F.array().cast("array<string>").alias("up"), F.col("node").alias("root"))
    return stored(_with_outer(nodes, above, listed, _OUTER, levels))


def manifest(docs: DataFrame, tampered: Column | None = None, levels: int = LEVELS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of ``docs``.

    Rows where ``tampered`` holds are folded from a leaf whose ``n_chars`` is one more.
    """
    changed = F.coalesce(F.lit(False) if tampered is None else tampered, F.lit(False))
    rows = docs.select(
        "doc_id", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"), leaf().alias("node"),
        F.when(changed, leaf(n_chars=F.col("n_chars") + 1)).alias("changed"),
    )
    leaves = group_index(rows, ["tree"], ["doc_id", "node"], "place", total="n", range_rows=range_rows)
    tops = stored(_block_roots(leaves, levels))
    inner = outer_nodes(tops, levels)
    subroots = inner.where("block = 0").select(F.col("tree").alias("of"), F.col("root").alias("node"))
    langs = stored(global_index(subroots, ["of"], "place", total="n", range_rows=range_rows)).withColumn("tree", F.lit(""))
    last = outer_nodes(langs.select("tree", "place", "n", "node"), levels)
    over = langs.join(last.select(F.col("block").alias("place"), F.col("up").alias("over"), F.col("root").alias("all")), "place")
    outer = inner.join(over.select(F.col("of").alias("tree"), "over", "all"), "tree").select(
        "tree", "block", F.concat("up", "over").alias("up"), F.concat("root", "all").alias("root")
    )

    def finish(block: pa.Table, local: int, up: list[str], roots: str) -> pa.Table:
        subroot, root = roots[:64], roots[64:]
        nodes, tampered_nodes = block.column("node").to_pylist(), block.column("changed").to_pylist()
        reduced = reduce_levels(nodes, local)
        paths = [siblings(reduced, i) + up for i in range(len(nodes))]
        folded = [fold(c or node, path) for node, c, path in zip(nodes, tampered_nodes, paths)]
        return pa.table(
            {
                "doc_id": block.column("doc_id"), "leaf": nodes, "subroot": [subroot] * len(nodes), "root": [root] * len(nodes),
                "proof_sha256": [proof(p) for p in paths], "folded_root": folded, "verified": [f == root for f in folded],
            }
        )

    return _with_outer(leaves, outer, finish, RESULT, levels)
