"""Merkle manifest of a dataset: a digest of every row, one tree for each source, one over the sources.

A node is the hash of up to ``FAN`` consecutive ones; rows of a source stand in
the order of their id. Rows are numbered by range partitions that are written
once, so no task sorts a source. ``FAN ** levels`` consecutive rows are an aligned
block, a subtree that one task builds. The tops of blocks are
numbered alike and climb in further rounds of blocks, until each source has one
node; these are one more tree's leaves. What a block needs of the levels above
it, its siblings there, comes back down the rounds, one row a block.

Trees are persistent: changing a leaf gives a version that shares all nodes but
the leaf's ancestors. In its block a version copies only those (``Block.copies``);
above, the copied block top goes on through the siblings of the block
(``climbed``). Versions never meet: each stays with the row it belongs to,
however many there are, and no group is larger than a block.

Edge cases: null ids come first in their source, equal ids in the order of
their digests (equal rows are interchangeable); null is a source of its own and
the first one; an empty table gives an empty manifest; other columns, whatever
their names, are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindsight.llm.work import stage

FAN = 3
#: Levels of a block: 729 nodes below its top.
LEVELS = 6


def sha(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else the byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(values: Sequence[Column]) -> Column:
    """Hash of a row's fields."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


class Block:
    """The nodes of an aligned block, level by level; ``levels`` of them stand above its leaves."""

    def __init__(self, leaves: list[str], levels: int):
        self.nodes = [leaves]
        for _ in range(levels):
            below = self.nodes[-1]
            self.nodes.append([sha(below[i : i + FAN]) for i in range(0, len(below), FAN)])

    @property
    def top(self) -> str:
        return self.nodes[-1][0]

    def siblings(self, leaf: int) -> str:
        """Digests beside the path from a leaf to the top, level by level, left to right."""
        out = []
        for row in self.nodes[:-1]:
            first = leaf - leaf % FAN
            out += [d for i, d in enumerate(row[first : first + FAN], first) if i != leaf]
            leaf //= FAN
        return "".join(out)

    def copies(self, leaf: int, changed: str) -> dict[tuple[int, int], str]:
        """The version in which a leaf is changed: its own nodes by (level, place); all others are shared."""
        own = {(0, leaf): changed}
        for level, row in enumerate(self.nodes[:-1]):
            first = leaf - leaf % FAN
            run = [own.get((level, i), d) for i, d in enumerate(row[first : first + FAN], first)]
            leaf //= FAN
            own[level + 1, leaf] = sha(run)
        return own


def climbed(node: str, place: int, n: int, siblings: str) -> str:
    """The top over ``n`` nodes, of which ``node`` is the one at ``place``."""
    at = 0
    while n > 1:
        first = place - place % FAN
        beside = min(FAN, n - first) - 1
        run = [siblings[at + 64 * i : at + 64 * (i + 1)] for i in range(beside)]
        node = sha([*run[: place - first], node, *run[place - first :]])
        at, place, n = at + 64 * beside, place // FAN, -(-n // FAN)
    return node


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``place`` in the order within ``tree``, from 0, and ``n``, the tree's rows; keeps no other order.

    Partitions are ranges of (tree, order): a large tree spreads over many.
    """
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    # Written, since a row's partition must be the same wherever it is used.
    slices = stage(ranged.withColumns({"slice": F.spark_partition_id(), "nth": F.monotonically_increasing_id()}), "slices")
    counts = slices.groupBy("tree", "slice").agg(F.count("*").alias("rows"), F.min("nth").alias("first"))
    by_slice = Window.partitionBy("tree").orderBy("slice")
    before = F.coalesce(F.sum("rows").over(by_slice.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(
        F.col("tree").alias("tree_"), F.col("slice").alias("slice_"), "first", before.alias("before"), F.sum("rows").over(Window.partitionBy("tree")).alias("n")
    )
    placed = slices.join(counts, F.col("tree").eqNullSafe(F.col("tree_")) & (F.col("slice") == F.col("slice_")))
    return placed.select(*rows.columns, (F.col("before") + F.col("nth") - F.col("first")).alias("place"), "n")


def in_blocks(nodes: DataFrame, kept: Sequence[str], levels: int) -> DataFrame:
    """One row a block: (tree, n, block, nodes), the nodes in order, each (place, *kept); at most ``FAN ** levels``."""
    block = F.floor(F.col("place") / FAN**levels).alias("block")
    return nodes.groupBy("tree", "n", block).agg(F.sort_array(F.collect_list(F.struct("place", *kept))).alias("nodes"))


def climb(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(tree, place, siblings, top) of nodes (tree, place, n, digest): what stands beside each on its way up."""
    span = FAN**levels

    def build(batches):
        for batch in batches:
            made = []
            for tree, n, number, held in zip(batch["tree"], batch["n"], batch["block"], batch["nodes"]):
                block = Block([x["digest"] for x in held], min(levels, height(n)))
                made.append((tree, n, number, block.top, [{"place": x["place"], "siblings": block.siblings(i)} for i, x in enumerate(held)]))
            yield pd.DataFrame(made, columns=["tree", "n", "block", "top", "paths"], dtype=object)

    kind = nodes.schema["tree"].dataType.simpleString()
    made = in_blocks(nodes, ["digest"], levels).mapInPandas(
        build, f"tree {kind}, n long, block long, top string, paths array<struct<place: long, siblings: string>>"
    )
    made = stage(made, "blocks")
    if (made.agg(F.max("n")).first()[0] or 0) > span:
        above = climb(made.select("tree", F.col("block").alias("place"), F.ceil(F.col("n") / span).alias("n"), F.col("top").alias("digest")), levels)
        above = above.toDF("tree_", "block_", "above", "top_")
        made = made.join(above, F.col("tree").eqNullSafe(F.col("tree_")) & (F.col("block") == F.col("block_")))
        made = made.withColumns({"top": F.col("top_")})
    else:
        made = made.withColumn("above", F.lit(""))
    return made.select("tree", "above", "top", F.inline("paths")).select("tree", "place", F.concat("siblings", "above").alias("siblings"), "top")


def manifest(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Of leaves (id, tree, leaf, changed): (id, tree, place, n, tree_place, trees, leaf, siblings, subroot, root, folded).

    ``siblings`` are the digests beside the path from a leaf to the root.
    ``folded`` is the root of the version in which the leaf is ``changed``, or
    the root itself where that is null or no change.
    """
    placed = numbered(stage(leaves.select("id", F.col("tree").cast("string").alias("tree"), "leaf", "changed"), "leaves"), ["id", "leaf"])
    ids = leaves.schema["id"].dataType.simpleString()
    kept = ["id", "leaf", "changed"]
    span = FAN**levels

    def tops(batches):
        for batch in batches:
            found = [Block([x["leaf"] for x in held], min(levels, height(n))).top for n, held in zip(batch["n"], batch["nodes"])]
            yield batch.assign(top=found)

    held = f"array<struct<place: long, id: {ids}, leaf: string, changed: string>>"
    blocks = stage(in_blocks(placed, kept, levels).mapInPandas(tops, f"tree string, n long, block long, nodes {held}, top string"), "blocks")
    tree_top = climb(blocks.select("tree", F.col("block").alias("place"), F.ceil(F.col("n") / span).alias("n"), F.col("top").alias("digest")), levels)
    tree_top = stage(tree_top, "paths")
    # The trees' tops are the leaves of one more tree.
    roots = tree_top.where(F.col("place") == 0).select(F.lit(0).alias("tree"), F.col("tree").alias("name"), F.col("top").alias("digest"))
    roots = stage(numbered(roots, ["name"]), "roots")
    forest = climb(roots.drop("name"), levels).toDF("_", "tree_place", "tree_siblings", "root")
    roots = roots.select("name", F.col("place").alias("tree_place"), F.col("n").alias("trees")).join(forest, "tree_place")
    above = tree_top.join(roots, F.col("tree").eqNullSafe(F.col("name")))
    above = above.select(
        F.col("tree").alias("tree_"), F.col("place").alias("block_"), F.col("siblings").alias("above"), F.col("top").alias("subroot"),
        "tree_place", "trees", "tree_siblings", "root",
    )
    whole = blocks.drop("top").join(above, F.col("tree").eqNullSafe(F.col("tree_")) & (F.col("block") == F.col("block_"))).drop("tree_", "block_")

    def prove(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                block = Block([x["leaf"] for x in row.nodes], min(levels, height(row.n)))
                upper = row.above + row.tree_siblings
                out = []
                for i, x in enumerate(row.nodes):
                    folded = row.root
                    if x["changed"] is not None and x["changed"] != x["leaf"]:
                        version = block.copies(i, x["changed"])
                        top = version[len(block.nodes) - 1, 0]
                        subroot = climbed(top, row.block, -(-row.n // span), row.above)
                        folded = climbed(subroot, row.tree_place, row.trees, row.tree_siblings)
                    out.append((x["id"], row.tree, x["place"], row.n, row.tree_place, row.trees, x["leaf"], block.siblings(i) + upper, row.subroot, row.root, folded))
                yield pd.DataFrame(out, columns=NAMES, dtype=object)

    types = f"id {ids}, tree string, place long, n long, tree_place long, trees long, leaf string, siblings string, subroot string, root string, folded string"
    return whole.mapInPandas(prove, types)


NAMES = ["id", "tree", "place", "n", "tree_place", "trees", "leaf", "siblings", "subroot", "root", "folded"]


def holds(leaf: str, place: int, n: int, tree_place: int, trees: int, siblings: str, root: str) -> bool:
    """Whether a leaf's proof leads to the root."""
    split, m, p = 0, n, place
    while m > 1:
        first = p - p % FAN
        split, p, m = split + 64 * (min(FAN, m - first) - 1), p // FAN, -(-m // FAN)
    return climbed(climbed(leaf, place, n, siblings[:split]), tree_place, trees, siblings[split:]) == root


def documents(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The manifest of documents and of their versions without line ends, made where crc32 of the decimal id is even."""
    rest = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    torn = even & F.contains(text, F.lit("\n"))
    leaves = docs.select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("tree"),
        digest([*rest, text]).alias("leaf"),
        F.when(torn, digest([*rest, F.replace(text, F.lit("\n"), F.lit(""))])).alias("changed"),
    )
    return manifest(leaves, levels)
