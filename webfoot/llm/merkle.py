"""Merkle manifest of a table: subtrees in van Emde Boas layout, proofs and their verification.

Every row is a leaf.  The leaves of a tree (one for each value of a grouping
column) ascend by id; every ``ARITY`` consecutive nodes become their parent
until one is left, the tree's subroot.  The subroots, ordered by the grouping
value (null first, bytewise), form the top tree, whose root covers the table.

The manifest stores *aligned subtrees* as blocks: ``BLOCK_LEVELS`` levels below
a block root, so at most ``ARITY ** BLOCK_LEVELS`` leaves and one short row
each.  Inside a block the nodes lie in van Emde Boas order: the levels are
split at half their height, the upper half comes first, then the subtrees below
it from left to right, each laid out in the same way.  ``Layout.address`` is
that arithmetic; construction writes and sibling retrieval reads through it.
Block roots are the leaves of the next step, so construction recurses over
block roots (steps grow with the logarithm of the table) and retrieval walks
the steps downward, handing each block the path above its root.

Scale: texts never move, a leaf is hashed where its row is read.  Leaves are
numbered by a range sort of ids and digests and one count for each sorted part,
so a grouping value with a third of all rows lies in as many parts as it needs;
blocks are dealt by tree and block number.  A task holds one block.  The driver
gets the root and the size of the largest tree.

Defined cases: null values count as ``-`` in a leaf; rows with a null id come
first in their tree, rows that repeat an id follow each other by their leaf
(equal rows are interchangeable); a null grouping value is a tree of its own; an
empty table gives an empty result and no root; columns that are not asked for
are not read.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webfoot.llm.common import col, discard, materialize

ARITY = 8
BITS = 3  # of a node's place among its siblings
BLOCK_LEVELS = 3
DIGEST = 32


class Layout:
    """Addresses of the nodes of a complete tree of ``height + 1`` levels in van Emde Boas order."""

    def __init__(self, height: int):
        self.height = height
        self.size = self.nodes(height + 1)
        self.rows = [self.addresses(depth, np.arange(ARITY ** depth), height + 1) for depth in range(height + 1)]

    @staticmethod
    def nodes(levels: int) -> int:
        return (ARITY ** levels - 1) // (ARITY - 1)

    @classmethod
    def addresses(cls, depth: int, index: np.ndarray, levels: int) -> np.ndarray:
        """Addresses of the nodes ``index`` of level ``depth`` (the root's is 0) in a tree of so many levels."""
        if levels == 1:
            return np.zeros_like(index)
        upper = levels // 2
        if depth < upper:
            return cls.addresses(depth, index, upper)
        below = BITS * (depth - upper)  # the subtree, and the node's place in it
        inside = cls.addresses(depth - upper, index & ((1 << below) - 1), levels - upper)
        return cls.nodes(upper) + (index >> below) * cls.nodes(levels - upper) + inside

    def address(self, depth: int, index: int) -> int:
        return int(self.rows[depth][index])


@lru_cache
def layout(height: int) -> Layout:
    return Layout(height)


def height_of(size: int) -> int:
    """Levels above the leaves of a tree of so many leaves."""
    height = 0
    while ARITY ** height < size:
        height += 1
    return height


def parent(digests: bytes) -> bytes:
    """The parent of nodes whose digests stand one after another."""
    return sha256(digests.hex().encode()).digest()


class Block:
    """One aligned subtree: its nodes in van Emde Boas order, absent ones zero."""

    def __init__(self, height: int, count: int, nodes: bytes | bytearray):
        self.layout, self.count, self.nodes = layout(height), count, nodes

    @classmethod
    def build(cls, height: int, leaves: list[bytes]) -> Block:
        block = cls(height, len(leaves), bytearray(DIGEST * layout(height).size))
        for i, digest in enumerate(leaves):
            block._put(height, i, digest)
        for depth in range(height, 0, -1):
            for run in range(-(-block.width(depth) // ARITY)):
                block._put(depth - 1, run, parent(b"".join(block.run(depth, run))))
        return block

    def width(self, depth: int) -> int:
        """Nodes of a level."""
        return -(-self.count // ARITY ** (self.layout.height - depth))

    def _put(self, depth: int, index: int, digest: bytes) -> None:
        at = DIGEST * self.layout.address(depth, index)
        self.nodes[at:at + DIGEST] = digest

    def get(self, depth: int, index: int) -> bytes:
        at = DIGEST * self.layout.address(depth, index)
        return bytes(self.nodes[at:at + DIGEST])

    def run(self, depth: int, run: int) -> list[bytes]:
        """The siblings that have the node ``run`` of the level above as their parent."""
        return [self.get(depth, i) for i in range(run * ARITY, min((run + 1) * ARITY, self.width(depth)))]

    def path(self, index: int, memo: dict) -> list[tuple[bytes, bytes]]:
        """The hex digests left and right of leaf ``index`` and of the nodes above it, up to the block's root."""
        def level(depth: int, i: int) -> tuple[bytes, bytes]:
            run, own = self.run(depth, i >> BITS), i & (ARITY - 1)
            return b"".join(run[:own]).hex().encode(), b"".join(run[own + 1:]).hex().encode()

        def above(depth: int, i: int) -> list[tuple[bytes, bytes]]:
            if not depth:
                return []
            if (depth, i) not in memo:
                memo[depth, i] = [level(depth, i)] + above(depth - 1, i >> BITS)
            return memo[depth, i]

        height = self.layout.height
        return [level(height, index)] + above(height - 1, index >> BITS) if height else []


def packed(path: list[tuple[bytes, bytes]]) -> bytes:
    """A path as bytes: for each level the numbers of digests left and right, then these."""
    return b"".join([bytes([len(left) // (2 * DIGEST), len(right) // (2 * DIGEST)]) + bytes.fromhex((left + right).decode())
                     for left, right in path])


def unpacked(held: bytes) -> list[tuple[bytes, bytes]]:
    out, at = [], 0
    while at < len(held):
        middle = at + 2 + DIGEST * held[at]
        end = middle + DIGEST * held[at + 1]
        out.append((held[at + 2:middle].hex().encode(), held[middle:end].hex().encode()))
        at = end
    return out


def proof_digest(path: list[tuple[bytes, bytes]]) -> str:
    """The digest of all siblings, level by level, left to right."""
    return sha256(b"".join([left + right for left, right in path])).hexdigest()


def folded(leaf: bytes, path: list[tuple[bytes, bytes]]) -> str:
    """The root that follows from a leaf and the siblings of its path."""
    held = leaf.hex().encode()
    for left, right in path:
        held = sha256(left + held + right).hexdigest().encode()
    return held.decode()


def leaf_digest(fields: list[Column]) -> Column:
    """The leaf of a row: SHA-256 of its fields, each with its length in bytes, null as ``-``."""
    text = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                                     for t in text]), 256))


def tree_key(group: Column) -> Column:
    """The grouping value as a key that is never null and keeps the order, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows(tree, ...)`` with ``position`` in their tree by ``order`` and the tree's ``size``."""
    dealt = materialize(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
                        .withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33)  # the sorted part that holds the row
    counts = dealt.groupBy("tree", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")  # one row for each sorted part of a tree
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("tree", "part", F.sum("n").over(tree).alias("size"),
                            (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return dealt.withColumn("part", part).join(offsets, ["tree", "part"]).withColumn(
        "position", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def in_blocks(nodes: DataFrame) -> DataFrame:
    """``nodes`` with the number of their ``block``, one block's rows together in order."""
    return (nodes.withColumn("block", F.shiftright("position", BITS * BLOCK_LEVELS))
            .repartition("tree", "block").sortWithinPartitions("tree", "block", "position"))


def assemble(nodes: DataFrame) -> DataFrame:
    """``(tree, size, block, count, nodes)`` for ``(tree, size, position, digest)``: the aligned subtrees."""
    def run(batches):
        key, held = None, []

        def finished():
            tree, size, number = key
            block = Block.build(min(BLOCK_LEVELS, height_of(size)), held)
            return tree, size, number, len(held), bytes(block.nodes)

        for batch in batches:
            out = []
            for *k, digest in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key:
                    if held:
                        out.append(finished())
                    key, held = k, []
                held.append(digest)
            yield _rows(out)
        if held:
            yield _rows([finished()])

    def _rows(out):
        columns = list(zip(*out)) or [[]] * 5
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                          names=["tree", "size", "block", "count", "nodes"])

    return in_blocks(nodes).select("tree", "size", "block", "digest").mapInArrow(
        run, "tree string, size long, block long, count long, nodes binary")


class Forest(NamedTuple):
    """The blocks of all trees, one table a step from the leaves up."""
    steps: list[DataFrame]
    largest: int

    @property
    def roots(self) -> DataFrame:
        """``(tree, step, digest)``: the root of each tree and the step whose single block holds it."""
        out = None
        for s, blocks in enumerate(self.steps):
            held = blocks.where(F.col("size") <= ARITY ** BLOCK_LEVELS).select(
                "tree", F.lit(s).alias("step"), F.substring("nodes", 1, DIGEST).alias("digest"))
            out = held if out is None else out.unionByName(held)
        return out


def plant(nodes: DataFrame, name: str) -> Forest:
    """Blocks over ``(tree, size, position, digest)``, then over their roots until each tree has one."""
    largest = nodes.agg(F.max("size")).first()[0] or 0
    steps, fan = [], ARITY ** BLOCK_LEVELS
    left = largest
    while True:
        blocks = materialize(assemble(nodes), f"{name}-step{len(steps)}")
        steps.append(blocks)
        if left <= fan:
            return Forest(steps, largest)
        left = -(-left // fan)
        nodes = blocks.where(F.col("size") > fan).select(
            "tree", F.ceil(F.col("size") / fan).alias("size"), F.col("block").alias("position"),
            F.substring("nodes", 1, DIGEST).alias("digest"))


def paths_above(forest: Forest, heads: DataFrame) -> DataFrame:
    """``(tree, block, path)``: for each block of the first step the path from its root up.

    ``heads(tree, path)`` continues the path above each tree's root.
    """
    def run(batches):
        for batch in batches:
            for tree, size, number, count, nodes, path in zip(*(c.to_pylist() for c in batch.columns)):
                block, memo = Block(min(BLOCK_LEVELS, height_of(size)), count, nodes), {}
                first = number << (BITS * BLOCK_LEVELS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * count, pa.string()), pa.array(range(first, first + count), pa.int64()),
                     pa.array([packed(block.path(i, memo)) + path for i in range(count)], pa.binary())],
                    names=["tree", "block", "path"])

    tops = forest.roots.join(heads, "tree").withColumn("block", F.lit(0).cast("long"))
    above = None
    for s in range(len(forest.steps) - 1, -1, -1):
        here = tops.where(F.col("step") == s).select("tree", "block", "path")
        above = here if above is None else here.unionByName(above)
        if s:
            above = materialize(forest.steps[s].join(above, ["tree", "block"]).select(
                "tree", "size", "block", "count", "nodes", "path").mapInArrow(
                    run, "tree string, block long, path binary"), f"paths-step{s}")
    return above


class Manifest(NamedTuple):
    leaves: DataFrame  # (tree, size, position, doc_id, digest, changed)
    forest: Forest
    top: Forest | None
    subroots: DataFrame | None  # (tree, size, position, digest) in the order of the top tree
    root: str | None


def manifest(docs: DataFrame, fields: list[str], id_col: str = "doc_id", group_col: str = "lang",
             changed: dict[str, Column] | None = None, where: Column | None = None) -> Manifest:
    """The manifest of ``docs``; ``fields`` make a leaf, in this order.

    ``changed`` gives other values for some fields; with it each row where
    ``where`` holds also carries the leaf it would have with these.
    """
    leaf = leaf_digest([col(f) for f in fields])
    other = F.lit(None).cast("binary")
    if changed:
        other = leaf_digest([changed.get(f, col(f)) for f in fields])
        other = F.when(where, other) if where is not None else other
    hashed = materialize(docs.select(tree_key(col(group_col)).alias("tree"), col(id_col).cast("long").alias("doc_id"),
                                     leaf.alias("digest"), other.alias("changed")), "leaves")
    leaves = materialize(numbered(hashed, ["doc_id", "digest", "changed"], "leaves-sorted"), "leaves-numbered")
    discard(hashed)
    forest = plant(leaves.select("tree", "size", "position", "digest"), "trees")
    if not forest.largest:
        return Manifest(leaves, forest, None, None, None)
    subroots = materialize(numbered(forest.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"),
                                    ["name"], "subroots-sorted"), "subroots")
    top = plant(subroots.select("tree", "size", "position", "digest"), "top")
    return Manifest(leaves, forest, top, subroots, bytes(top.roots.first()["digest"]).hex())


def proofs(held: Manifest) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` for each leaf.

    A row's proof is the siblings of its path; its root is folded anew from the
    changed leaf where there is one.
    """
    schema = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
              "verified boolean")
    root = held.root
    if root is None:
        return held.leaves.select("doc_id", *[F.lit("").alias(c) for c in (
            "leaf", "subroot", "root", "proof_sha256", "folded_root")], F.lit(False).alias("verified"))
    spark = held.leaves.sparkSession
    # The top tree's paths: its blocks of the first step hold the subroots.
    crown = paths_above(held.top, spark.createDataFrame([("", b"")], "tree string, path binary"))
    names = held.subroots.select("name", "position", F.col("digest").alias("subroot"),
                                 F.shiftright("position", BITS * BLOCK_LEVELS).alias("block"))
    blocks = held.top.steps[0].join(crown, ["tree", "block"]).select("size", "block", "count", "nodes", F.col("path").alias("above"))

    def climb(batches):
        key = block = memo = None
        for batch in batches:
            out = []
            for name, place, number, subroot, size, count, nodes, above in zip(*(c.to_pylist() for c in batch.columns)):
                if number != key:
                    key, block, memo = number, Block(min(BLOCK_LEVELS, height_of(size)), count, nodes), {}
                out.append((name, subroot, packed(block.path(place & (ARITY ** BLOCK_LEVELS - 1), memo)) + above))
            columns = list(zip(*out)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.binary(), pa.binary()))],
                                             names=["tree", "subroot", "path"])

    heads = materialize(names.join(blocks, "block").select(
        "name", "position", "block", "subroot", "size", "count", "nodes", "above").mapInArrow(
            climb, "tree string, subroot binary, path binary"), "heads")

    first = held.forest.steps[0].join(paths_above(held.forest, heads.select("tree", "path")), ["tree", "block"]).join(
        heads.select("tree", "subroot"), "tree")
    # Each block's row comes before its leaves.
    width = BITS * BLOCK_LEVELS
    none = {"doc_id": "long", "digest": "binary", "changed": "binary"}
    rows = (held.leaves.withColumn("block", F.shiftright("position", width)).select(
        "tree", "block", "position", "doc_id", "digest", "changed",
        *[F.lit(None).cast(t).alias(c) for c, t in (("size", "long"), ("count", "long"), ("nodes", "binary"),
                                                     ("path", "binary"), ("subroot", "binary"))])
            .unionByName(first.select("tree", "block", F.lit(-1).cast("long").alias("position"),
                                      *[F.lit(None).cast(t).alias(c) for c, t in none.items()],
                                      "size", "count", "nodes", "path", "subroot"))
            .repartition("tree", "block").sortWithinPartitions("tree", "block", "position"))

    def fold(batches):
        block = memo = above = subroot = None
        for batch in batches:
            out = []
            for _, _, place, doc_id, leaf, changed, size, count, nodes, path, top in zip(*(c.to_pylist() for c in batch.columns)):
                if place < 0:
                    block, memo = Block(min(BLOCK_LEVELS, height_of(size)), count, nodes), {}
                    above, subroot = unpacked(path), top.hex()
                    continue
                way = block.path(place & (ARITY ** BLOCK_LEVELS - 1), memo) + above
                result = folded(changed if changed is not None else leaf, way)
                out.append((doc_id, leaf.hex(), subroot, root, proof_digest(way), result, result == root))
            columns = list(zip(*out)) or [[]] * 7
            types = [pa.int64()] + [pa.string()] * 5 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[
                "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return rows.mapInArrow(fold, schema)
