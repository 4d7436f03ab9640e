"""Merkle manifest of a dataset, with a proof for every row.

Rows are leaves.  The leaves of one tree are in order; every ``FAN`` consecutive
nodes become one node of the next level, the last run as many as are left, until
one node remains.  The trees' roots, in the order of their names, are the leaves
of one more tree.

Trees are reduced by superblocks, the subtrees of ``FAN ** DEPTH`` consecutive
nodes: leaves to superblock roots, these to the roots of larger superblocks, and
so on, until one node is left for each tree.  The way back hands each superblock
the outer nodes of its proofs: superblocks and the siblings on the path above
them are cogrouped, and each group adds the siblings inside.  The last cogroup
gets the leaves with the outer nodes of their superblock; it reduces the leaves
once more, joins the proofs and folds them.  No group is larger than a
superblock, however many leaves a tree has.

Digests are SHA-256, as lowercase hex text wherever they are hashed again.
Fields of a row are written as ``-`` if null, else as the number of bytes, ``:``
and the value.  Null ids and null tree names come first and are values of their
own; equal ids are ordered by their leaf; equal rows are separate, equal leaves.
An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paralex.llm.common import stored
from paralex.operators.sharding import join_null_safe, number_rows

FAN = 8
DEPTH = 4  # levels of a superblock
HEX = 64  # characters of a digest


def leaf(*fields: Column) -> Column:
    """Digest of a row's fields."""
    written = [
        F.when(f.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")))
        for f in fields
    ]
    return F.sha2(F.concat(*written), 256)


def lower_ascii(text: Column) -> Column:
    """A text with A-Z in lower case and all else unchanged."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, capitals, capitals.lower())


def _hash(digests: Sequence[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def _levels(nodes: list[str], depth: int, last: bool) -> list[list[str]]:
    """The levels of a superblock, its nodes first.  A superblock of a larger
    tree is reduced ``depth`` times, a whole tree until one node remains."""
    levels = [nodes]
    while len(levels) <= depth and not (last and len(levels[-1]) == 1):
        levels.append([_hash(levels[-1][i : i + FAN]) for i in range(0, len(levels[-1]), FAN)])
    return levels


def _paths(levels: list[list[str]]) -> Iterator[tuple[str, list[int]]]:
    """For every node of a superblock: the siblings, level by level, one after
    another, and a number for each level that holds the place of the path's node
    in its run and the length of the run."""
    for i in range(len(levels[0])):
        siblings, places = [], []
        for level in levels[:-1]:
            first = i - i % FAN
            run = level[first : first + FAN]
            places.append((i - first) * FAN + len(run) - 1)
            del run[i - first]
            siblings += run
            i //= FAN
        yield "".join(siblings), places


def fold(digest: str, proof: str, places: Sequence[int]) -> str:
    """The root that a leaf and its proof lead to."""
    at = 0
    for place in places:
        mine, others = divmod(place, FAN)
        here, at = at + HEX * mine, at + HEX * others
        digest = sha256((proof[here - HEX * mine : here] + digest + proof[here:at]).encode()).hexdigest()
    return digest


def _block(depth: int) -> Column:
    return F.shiftright("pos", depth * (FAN.bit_length() - 1)).alias("block")


def _reduced(nodes: DataFrame, depth: int) -> DataFrame:
    """Roots of all superblocks, as nodes: ``tree``, ``pos``, ``n`` (nodes of
    the tree at that level) and ``digest``."""

    def reduce(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        tree, pos, n = map(int, block[["tree", "pos", "n"]].iloc[0])
        top = _levels(block["digest"].tolist(), depth, n <= FAN**depth)[-1]
        return pd.DataFrame({"tree": [tree], "pos": [pos // FAN**depth], "n": [-(-n // FAN**depth)], "digest": top})

    return nodes.groupBy("tree", _block(depth)).applyInPandas(reduce, "tree long, pos long, n long, digest string")


def _climbed(nodes: DataFrame, depth: int) -> list[DataFrame]:
    """Nodes, roots of their superblocks, roots of those, until every tree is
    one node.  The number of steps is the logarithm of the largest tree."""
    steps = [nodes]
    while (steps[-1].agg(F.max("n")).first()[0] or 0) > 1:
        steps.append(stored(_reduced(steps[-1], depth), "nodes"))
    return steps


OUTER = "tree long, pos long, proof string, places array<int>, subroot string, root string"


def _inside(block: pd.DataFrame, outer: pd.DataFrame, depth: int) -> tuple[pd.DataFrame, list[str], list[list[int]]]:
    """Sorted nodes of a superblock, and the whole proofs of each: siblings
    inside it, then the outer nodes of the superblock."""
    block = block.sort_values("pos")
    levels = _levels(block["digest"].tolist(), depth, int(block["n"].iloc[0]) <= FAN**depth)
    above, steps = outer["proof"].iloc[0], list(outer["places"].iloc[0])
    paths = list(_paths(levels))
    return block, [p + above for p, _ in paths], [s + steps for _, s in paths]


def _handed_down(nodes: DataFrame, outer: DataFrame, depth: int) -> DataFrame:
    """The outer nodes of every node, from those of its superblock."""

    def join(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block, proofs, places = _inside(block, above, depth)
        return pd.DataFrame({
            "tree": block["tree"].to_numpy(), "pos": block["pos"].to_numpy(), "proof": proofs, "places": places,
            "subroot": above["subroot"].iloc[0], "root": above["root"].iloc[0],
        })

    return nodes.groupBy("tree", _block(depth)).cogroup(outer.groupBy("tree", "pos")).applyInPandas(join, OUTER)


def _outer_of_trees(roots: DataFrame, depth: int) -> DataFrame:
    """The outer nodes of each tree's root: the tree above them all."""
    total = roots.count()
    top = roots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("pos"), F.lit(total).cast("bigint").alias("n"), "digest")
    steps = _climbed(top, depth)
    nothing = [F.lit("").alias("proof"), F.array().cast("array<int>").alias("places"), F.lit(None).cast("string").alias("subroot")]
    outer = steps[-1].select("tree", "pos", *nothing, F.col("digest").alias("root"))
    for nodes in steps[-2::-1]:
        outer = _handed_down(nodes, outer, depth)
    own = roots.select(F.col("tree").alias("pos"), F.col("digest").alias("own"))
    return stored(
        outer.join(own, "pos").select(
            F.col("pos").alias("tree"), F.lit(0).cast("bigint").alias("pos"), "proof", "places", F.col("own").alias("subroot"), "root"
        ), "outer",
    )


def manifest(rows: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The manifest of ``rows`` with ``doc_id``, ``tree`` (its name), ``leaf``
    and ``shown``, the leaf that the row has when it is verified.

    Returns these with ``subroot``, ``root``, ``proof`` (siblings from the leaf
    up to the root, left to right, one after another), ``places`` (of the path
    in its runs, for :func:`fold`), ``folded_root`` and ``verified``.  Leaves
    are in the order of ``doc_id``.
    """
    # Written first: sorting would read, and hash, whole texts twice.  The row number
    # lets equal rows lie apart.
    kept = stored(rows.select("doc_id", "tree", "leaf", "shown"), "leaves")
    placed = number_rows(kept.withColumn("nth", F.monotonically_increasing_id()), ["doc_id", "leaf", "nth"], ["tree"]).drop("nth")
    placed = stored(placed.withColumnsRenamed({"total": "n", "leaf": "digest", "tree": "name"}), "placed")
    names = number_rows(placed.select("name").distinct(), ["name"], []).select("name", F.col("pos").alias("tree"))
    leaves = stored(join_null_safe(placed, stored(names, "trees"), ["name"]), "numbered-leaves")

    steps = _climbed(leaves.select("tree", "pos", "n", "digest"), depth)
    outer = _outer_of_trees(steps[-1], depth)
    for nodes in steps[-2:0:-1]:
        outer = stored(_handed_down(nodes, outer, depth), "outer")
    kinds = [(c, leaves.schema[c].dataType.simpleString()) for c in ("doc_id", "name")]
    returns = ", ".join(f"{c} {k}" for c, k in kinds) + (
        ", leaf string, shown string, subroot string, root string, proof string, places array<int>, folded_root string, verified boolean"
    )

    def verify(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block, proofs, places = _inside(block, above, depth)
        root = above["root"].iloc[0]
        folded = list(map(fold, block["shown"], proofs, places))
        return pd.DataFrame({
            "doc_id": block["doc_id"].to_numpy(), "name": block["name"].to_numpy(), "leaf": block["digest"].to_numpy(),
            "shown": block["shown"].to_numpy(), "subroot": above["subroot"].iloc[0], "root": root, "proof": proofs,
            "places": places, "folded_root": folded, "verified": [f == root for f in folded],
        })

    verified = leaves.groupBy("tree", _block(depth)).cogroup(outer.groupBy("tree", "pos")).applyInPandas(verify, returns)
    return verified.withColumnRenamed("name", "tree")
