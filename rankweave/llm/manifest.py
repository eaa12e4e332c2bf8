"""Merkle manifest of a table: one tree per language, one tree over their roots, a proof for every row.

A tree's leaves are numbered by rank. Aligned subtrees of ``BLOCK_LEVELS`` levels are the blocks: one group of at most
2**BLOCK_LEVELS digests each, however many rows a language has. A block is one binary value whose digests lie in van
Emde Boas order: the tree is cut at half its height, the top half comes first, then the bottom trees from left to
right, each laid out by the same rule. ``places`` computes a node's address in that order; building a block and
reading the siblings of its leaves both go through it. The roots of the blocks are the leaves of the next level of
blocks, until a tree has one block left; the roots of the trees are the leaves of one more such tree.

Digests are lowercase hex sha256 where they are inputs of another digest and 32 bytes where they are stored.

Defined results: a null field is ``-``, an empty text ``0:``; a null language is a tree of its own, before all others;
null ids come first in their tree and are never tampered with; repeated rows are one leaf each and, as rows with one
id, lie in the order of their digests; a null ``n_chars`` stays null when tampered with; texts of any length are
hashed whole, on the JVM; an empty table gives no rows. Columns besides ``FIELDS`` are not part of a leaf and may have any name.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.plans.bounds import lookup_join
from rankweave.plans.ordered import rank_in_groups
from rankweave.session import cut_lineage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# A block has up to 2**10 leaves: 64 kB of digests.
BLOCK_LEVELS = 10
# A step of a path: on which side the sibling is (none, right, left), and its digest.
NONE, RIGHT, LEFT = 0, 1, 2
STEP = 33
TREE = "tree string, block long, total long, laid binary, root binary"


def places(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Addresses, in van Emde Boas order, of the nodes ``index`` at ``depth`` of a perfect tree of ``levels`` levels."""
    index = index.astype(np.int64)
    place = np.zeros(len(index), np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        below = depth - top
        levels -= top
        place += (1 << top) - 1 + (index >> below) * ((1 << levels) - 1)
        index = index & ((1 << below) - 1)
        depth = below
    return place


def height_of(total: int, block_levels: int) -> int:
    """Height of a block of a tree with ``total`` leaves: its own where it is the only one."""
    return min(block_levels, max(total - 1, 0).bit_length())


def parent(*digests: bytes) -> bytes:
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def laid_out(leaves: np.ndarray, height: int) -> np.ndarray:
    """The (nodes, 32) digests of a block, in van Emde Boas order; nodes that do not exist are zero."""
    laid = np.zeros(((2 << height) - 1, 32), np.uint8)
    row = [x.tobytes() for x in leaves]
    for depth in range(height, -1, -1):
        laid[places(depth, np.arange(len(row)), height + 1)] = np.frombuffer(b"".join(row), np.uint8).reshape(-1, 32)
        row = [parent(*row[k : k + 2]) for k in range(0, len(row), 2)]
    return laid


def steps(laid: np.ndarray, n: int, height: int, at: np.ndarray) -> np.ndarray:
    """(len(at), height, STEP): the way from the leaves ``at`` of a block of ``n`` leaves to its root."""
    out = np.zeros((len(at), height, STEP), np.uint8)
    index, count = at.astype(np.int64), n
    for up in range(height):
        sibling = index ^ 1
        there = sibling < count
        side = np.where(there, np.where(index & 1, LEFT, RIGHT), NONE)
        out[:, up, 0] = side
        out[there, up, 1:] = laid[places(height - up, sibling[there], height + 1)]
        index, count = index >> 1, (count + 1) >> 1
    return out


def fold(digest: bytes, path: bytes) -> bytes:
    """The root that a leaf's digest gives along its path."""
    for k in range(0, len(path), STEP):
        other = path[k + 1 : k + STEP]
        if path[k] == NONE:
            digest = parent(digest)
        else:
            digest = parent(digest, other) if path[k] == RIGHT else parent(other, digest)
    return digest


def siblings(path: bytes) -> list[bytes]:
    return [path[k + 1 : k + STEP] for k in range(0, len(path), STEP) if path[k] != NONE]


def digests_of(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


@dataclass(frozen=True)
class Forest:
    """``levels``: blocks (tree, block, total, laid, root) of each level, lowest first; ``roots``: (tree, digest)."""

    levels: list[DataFrame]
    roots: DataFrame
    block_levels: int


def forest(nodes: DataFrame, block_levels: int = BLOCK_LEVELS) -> Forest:
    """Trees over ``nodes`` (tree, pos from 0, digest, total leaves of the tree)."""

    def kernel(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        total = table["total"][0].as_py()
        laid = laid_out(digests_of(table["digest"]), height_of(total, block_levels))
        return pa.table(
            {
                "tree": table["tree"][:1], "block": table["block"][:1], "total": table["total"][:1],
                "laid": pa.array([laid.tobytes()]), "root": pa.array([laid[0].tobytes()]),
            }
        )

    levels, size = [], 1 << block_levels
    while True:
        placed = nodes.select("tree", "pos", "digest", "total", F.shiftright("pos", block_levels).alias("block"))
        blocks = cut_lineage(placed.groupBy("tree", "block").applyInArrow(kernel, TREE), "blocks")
        levels.append(blocks)
        rest = blocks.where(F.col("total") > size)
        if rest.isEmpty():
            break
        total = F.ceil(F.col("total") / F.lit(size)).cast("long")
        nodes = rest.select("tree", F.col("block").alias("pos"), F.col("root").alias("digest"), total.alias("total"))
    done = [x.where(F.col("total") <= size).select("tree", F.col("root").alias("digest")) for x in levels]
    return Forest(levels, reduce(DataFrame.unionByName, done), block_levels)


def lowest_blocks(trees: Forest, starts: DataFrame) -> DataFrame:
    """The blocks of the lowest level with ``above``, the path from each one's root; ``starts`` is (tree, above) of the trees."""
    size, above = 1 << trees.block_levels, None
    for k in range(len(trees.levels) - 1, -1, -1):
        blocks = trees.levels[k]
        tops = lookup_join(blocks.where(F.col("total") <= size), starts, ["tree"])
        if above is not None:
            tops = tops.unionByName(blocks.where(F.col("total") > size).join(above, ["tree", "block"]))
        if k == 0:
            return tops
        below = trees.levels[k - 1].where(F.col("total") > size)
        members = below.select("tree", F.col("block").alias("pos"), F.shiftright("block", trees.block_levels).alias("block"))
        above = members.groupBy("tree", "block").cogroup(tops.groupBy("tree", "block")).applyInArrow(
            _paths(trees.block_levels), "tree string, block long, above binary"
        )
        above = cut_lineage(above, "above")


def _found(table: pa.Table, blocks: pa.Table, block_levels: int) -> tuple[pa.Table, list[bytes]]:
    """Members of one block in order, and the path of each one to the top."""
    table = table.sort_by("pos")
    total = blocks["total"][0].as_py()
    height = height_of(total, block_levels)
    at = table["pos"].to_numpy() & ((1 << block_levels) - 1)
    n = min(total - (blocks["block"][0].as_py() << block_levels), 1 << block_levels)
    laid = np.frombuffer(blocks["laid"][0].as_py(), np.uint8).reshape(-1, 32)
    above = blocks["above"][0].as_py()
    return table, [x.tobytes() + above for x in steps(laid, n, height, at)]


def _paths(block_levels: int):
    def kernel(table: pa.Table, blocks: pa.Table) -> pa.Table:
        table, paths = _found(table, blocks, block_levels)
        return pa.table({"tree": table["tree"], "block": table["pos"], "above": pa.array(paths, pa.binary())})

    return kernel


def proven(nodes: DataFrame, trees: Forest, starts: DataFrame, kept: str) -> DataFrame:
    """``kept`` columns (SQL types) of ``nodes`` with the digest of their siblings and the root their ``shown`` digest gives."""
    names = [x.split()[0] for x in kept.split(", ")]
    blocks = lowest_blocks(trees, starts).select("tree", "block", "total", "laid", "above")
    placed = nodes.withColumn("block", F.shiftright("pos", trees.block_levels))
    block_levels = trees.block_levels

    def kernel(table: pa.Table, held: pa.Table) -> pa.Table:
        table, paths = _found(table, held, block_levels)
        proof = [hashlib.sha256(b"".join(siblings(x)).hex().encode()).hexdigest() for x in paths]
        folded = [fold(x, path).hex() for x, path in zip(table["shown"].to_pylist(), paths)]
        return table.select(names).append_column("proof_sha256", pa.array(proof)).append_column("folded_root", pa.array(folded))

    grouped = placed.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block"))
    return grouped.applyInArrow(kernel, f"{kept}, proof_sha256 string, folded_root string")


def field(value: Column) -> Column:
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(x) for x in fields]), 256))


def tampered(docs: DataFrame) -> Column:
    """Whether the row counts as tampered with: 7 divides the crc32 of its id."""
    return F.coalesce(F.crc32(F.col(FIELDS[0]).cast("string")) % 7 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, tree, digest, shown): the leaf of each row, and the one that it shows when it is checked."""
    own = [F.col(f"`{c}`") for c in FIELDS]
    longer = F.col(FIELDS[3]).cast("decimal(20,0)") + 1
    forged = leaf([own[0], own[1], own[2], longer, own[4]])
    lang = own[2].cast("string")
    tree = F.when(lang.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), lang))
    made = docs.select(own[0], tree.alias("tree"), leaf(own).alias("digest"), F.when(tampered(docs), forged).alias("forged"))
    return made.select(FIELDS[0], "tree", "digest", F.coalesce("forged", "digest").alias("shown"))


@dataclass(frozen=True)
class Manifest:
    """``rows``: the numbered leaves; ``trees``: one per language; ``top``: the tree over their roots; ``root`` in hex."""

    rows: DataFrame
    trees: Forest
    top: Forest
    starts: DataFrame
    root: str | None


def build(docs: DataFrame, block_levels: int = BLOCK_LEVELS) -> Manifest:
    """Hash, number and lay out all rows; everything is written to the shared folder as Parquet."""
    ranked = rank_in_groups(leaves(docs), "tree", [F.col(FIELDS[0]), F.col("digest"), F.col("shown")], "pos", "long")
    ranked = cut_lineage(ranked.withColumn("pos", F.col("pos") - 1), "leaves")
    totals = ranked.groupBy("tree").agg(F.count("*").alias("total"))
    rows = lookup_join(ranked, totals, ["tree"])
    trees = forest(rows, block_levels)
    numbered = rank_in_groups(trees.roots.withColumn("all", F.lit("")), "all", [F.col("tree")], "pos", "long")
    over = cut_lineage(numbered.select(F.col("tree").alias("lang_tree"), F.col("all").alias("tree"), F.col("pos") - 1, "digest").toDF("lang_tree", "tree", "pos", "digest"), "subroots")
    n = over.count()
    top = forest(over.withColumn("total", F.lit(n).cast("long")), block_levels)
    nothing = docs.sparkSession.createDataFrame([("", b"")], "tree string, above binary")
    blocks = lowest_blocks(top, nothing).select("tree", "block", "total", "laid", "above")
    members = over.select("lang_tree", "tree", "pos", F.shiftright("pos", block_levels).alias("block"))

    def kernel(table: pa.Table, held: pa.Table) -> pa.Table:
        table, paths = _found(table, held, block_levels)
        return pa.table({"tree": table["lang_tree"], "above": pa.array(paths, pa.binary())})

    starts = members.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(kernel, "tree string, above binary")
    found = top.roots.first()
    return Manifest(rows, trees, top, cut_lineage(starts, "starts"), found["digest"].hex() if found else None)


def verified(docs: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """Every row with its leaf, its tree's root, the root of all, its proof, and whether what it shows folds to that root."""
    made = build(docs, block_levels)
    kind = docs.schema[FIELDS[0]].dataType.simpleString()
    rows = made.rows.select(FIELDS[0], "tree", "pos", "digest", "shown")
    checked = proven(rows, made.trees, made.starts, f"{FIELDS[0]} {kind}, tree string, digest binary")
    subroots = made.trees.roots.select("tree", F.lower(F.hex("digest")).alias("subroot"))
    root = F.lit(made.root).cast("string")
    return lookup_join(checked, subroots, ["tree"]).select(
        FIELDS[0], F.lower(F.hex("digest")).alias("leaf"), "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )
