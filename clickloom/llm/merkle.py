"""Merkle manifest of a table: an eight-fold hash tree for each group of rows and one above them.

Trees are cut into aligned blocks of four levels above their lowest nodes, at most 4,096 of them.
A block is one row with its digests in van Emde Boas order: the upper half of its levels, then
the subtrees below it, one after the other, each laid out the same way. Wherever a cache line or
page ends, a path from leaf to root so touches few of them. Addresses are computed, never stored.
The roots of a level's blocks are the lowest nodes of the next level's blocks, until one is left.

Proofs come back down the same way: a block hands the siblings of each of its lowest nodes, up to
the root, to the block below that node, one row for each block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clickloom.operators.lookup import HOT_ROWS, rank_lookup
from clickloom.operators.ordering import with_row_index
from clickloom.session import col, freeze, ship_package

#: Bits of a node's number among its siblings; edges of a block from its lowest nodes to its root.
BITS, HEIGHT = 3, 4
FANOUT, LOWEST = 1 << BITS, 1 << BITS * HEIGHT
#: Bytes of a digest.
SIZE = 32
#: Groups whose first row numbers are broadcast.
BROADCAST_GROUPS = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK = "k string, block bigint, n int, nodes binary, root binary"


def nodes_in(levels: int) -> int:
    """Nodes of a complete tree of so many levels."""
    return ((1 << BITS * levels) - 1) // (FANOUT - 1)


def address(levels: int, depth: int, index: int) -> int:
    """Place of node ``index`` of depth ``depth`` in the layout of a tree of ``levels`` levels."""
    base = 0
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        below = BITS * (depth - upper)
        base += nodes_in(upper) + (index >> below) * nodes_in(levels - upper)
        index &= (1 << below) - 1
        depth, levels = depth - upper, levels - upper
    return base


def height_of(block: int, n: int) -> int:
    """Edges of a block: only the first of a level can be lower than the others."""
    if block > 0:
        return HEIGHT
    height = 0
    while 1 << BITS * height < n:
        height += 1
    return height


def counts_of(n: int, height: int) -> list[int]:
    """Nodes of a block by depth, the root first."""
    counts = [n]
    for _ in range(height):
        counts.append(-(-counts[-1] // FANOUT))
    return counts[::-1]


def digest(texts: str) -> str:
    return hashlib.sha256(texts.encode()).hexdigest()


class Block:
    """A block's digests, read and written by computed address."""

    def __init__(self, height: int, n: int, nodes: bytes | None = None):
        self.height, self.counts = height, counts_of(n, height)
        self.nodes = bytearray(nodes) if nodes is not None else bytearray(SIZE * nodes_in(height + 1))

    def get(self, depth: int, index: int) -> str:
        at = SIZE * address(self.height + 1, depth, index)
        return self.nodes[at : at + SIZE].hex()

    def put(self, depth: int, index: int, value: str) -> None:
        at = SIZE * address(self.height + 1, depth, index)
        self.nodes[at : at + SIZE] = bytes.fromhex(value)

    def run(self, depth: int, index: int) -> list[str]:
        """The digests that become one with that of a node, itself among them."""
        first = index >> BITS << BITS
        return [self.get(depth, i) for i in range(first, min(first + FANOUT, self.counts[depth]))]

    @classmethod
    def of(cls, height: int, lowest: Sequence[str]) -> Block:
        block = cls(height, len(lowest))
        for i, value in enumerate(lowest):
            block.put(height, i, value)
        for depth in range(height - 1, -1, -1):
            for i in range(block.counts[depth]):
                block.put(depth, i, digest("".join(block.run(depth + 1, i << BITS))))
        return block


#: A step of a proof: the digests left and right of a node among those that become one with it.
Step = tuple[str, str]


def steps_within(block: Block) -> list[list[Step]]:
    """For each lowest node its steps up to the block's root."""
    above: list[list[Step]] = [[]]
    for depth in range(1, block.height + 1):
        now = []
        for first in range(0, block.counts[depth], FANOUT):
            run = block.run(depth, first)
            up = above[first >> BITS]
            for i in range(len(run)):
                now.append([("".join(run[:i]), "".join(run[i + 1 :])), *up])
        above = now
    return above


def folded(value: str, steps: Sequence[Step]) -> str:
    """The root that follows from a node's digest and its steps."""
    for left, right in steps:
        value = digest(left + value + right)
    return value


def _packed(steps: Sequence[Step]) -> list[dict]:
    return [{"l": a, "r": b} for a, b in steps]


def _unpacked(steps: list[dict] | None) -> list[Step]:
    return [(s["l"], s["r"]) for s in steps or []]


def _table(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held) if held else None


def _made(rows: list[tuple], fields: T.StructType) -> Iterator[pa.RecordBatch]:
    arrow = to_arrow_schema(fields)
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)


def _blocks(nodes: DataFrame, payload: str = "") -> DataFrame:
    """One row for each block of nodes (k, index, digest[, payload columns]); columns of
    ``payload`` become arrays in the order of the nodes."""
    names = [p.split()[0] for p in payload.split(", ") if p]
    arrays = "".join(f", {n} array<{p.split()[1]}>" for n, p in zip(names, payload.split(", ")))
    schema = T.StructType.fromDDL(BLOCK + arrays)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _table(batches)
        if rows is None:
            return
        rows = rows.sort_by("index")
        block = rows.column("block")[0].as_py()
        made = Block.of(height_of(block, rows.num_rows), [d.hex() for d in rows.column("digest").to_pylist()])
        row = [rows.column("k")[0].as_py(), block, rows.num_rows, bytes(made.nodes), bytes.fromhex(made.get(0, 0))]
        yield from _made([(*row, *[rows.column(n).to_pylist() for n in names])], schema)

    cut = nodes.withColumn("block", F.expr(f"index div {LOWEST}"))
    return cut.groupBy("k", "block").applyInArrow(run, schema)


@dataclass(frozen=True)
class Trees:
    """Blocks (k, block, n, nodes, root, ...) level by level, and the root (k, digest) of each tree."""

    levels: list[DataFrame]
    roots: DataFrame


def grow(nodes: DataFrame, payload: str = "") -> Trees:
    """The trees over nodes (k, index, digest), one for each k, indexes gapless from 0."""
    ship_package(nodes.sparkSession)
    levels = [freeze(_blocks(nodes, payload))]
    while not levels[-1].where("block > 0").isEmpty():
        roots = levels[-1].select("k", F.col("block").alias("index"), F.col("root").alias("digest"))
        levels.append(freeze(_blocks(roots)))
    return Trees(levels, levels[-1].select("k", F.col("root").alias("digest")))


STEPS = "array<struct<l: string, r: string>>"


def _handed_down(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """(k, block, steps, subroot) for the block below each lowest node of ``blocks``, given the
    steps from each block's root up. ``subroot`` is handed on as it is."""
    schema = T.StructType.fromDDL(f"k string, block bigint, steps {STEPS}, subroot string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _table(batches)
        if rows is None:
            return
        r = rows.to_pylist()[0]
        up = _unpacked(r["steps"])
        block = Block(height_of(r["block"], r["n"]), r["n"], r["nodes"])
        first = r["block"] * LOWEST
        yield from _made(
            [(r["k"], first + i, _packed([*s, *up]), r["subroot"]) for i, s in enumerate(steps_within(block))],
            schema,
        )

    joined = blocks.select("k", "block", "n", "nodes").join(above, ["k", "block"])
    return joined.groupBy("k", "block").applyInArrow(run, schema)


def steps_down(trees: Trees, above: DataFrame) -> DataFrame:
    """(k, block, steps, subroot) for the blocks of the lowest level, given (k, steps, subroot)
    above each root."""
    at = above.select("k", F.lit(0).cast("bigint").alias("block"), "steps", "subroot")
    for blocks in reversed(trees.levels[1:]):
        at = _handed_down(blocks, at)
    return at


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: each value as text after its length in bytes, ``-`` for NULL."""
    texts = [f.cast("string") for f in fields]
    shown = [F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*shown), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(k, index, doc_id, digest, forged): rows numbered within their lang by doc_id.

    ``k`` stands for the lang and sorts like it, NULL first. ``forged`` is the digest after
    tampering, NULL where the row is not tampered with.
    """
    fields = {c: col(c) for c in FIELDS}
    forged = {**fields, "text": F.translate("text", UPPER, LOWER)}
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    keyed = docs.select(
        F.coalesce(F.concat(F.lit("+"), "lang"), F.lit("")).alias("k"), "doc_id",
        F.unhex(leaf_digest(list(fields.values()))).alias("digest"),
        F.when(tampered, F.unhex(leaf_digest(list(forged.values())))).alias("forged"),
        # tells repeated rows apart, so that they can be spread
        F.monotonically_increasing_id().alias("turn"),
    )
    numbered = with_row_index(keyed, ["k", "doc_id", "digest", "turn"], "number")
    starts = freeze(numbered.groupBy("k").agg(F.min("number").alias("start"), F.count("*").alias("n")))
    groups, rows = starts.agg(F.count("*"), F.sum("n")).first()
    # of groups with a thousandth of the rows there are at most a thousand
    ranked = starts.withColumn("rank", F.when(F.col("n") * HOT_ROWS > F.lit(rows), 0).otherwise(HOT_ROWS))
    placed = rank_lookup(numbered, F.col("k"), ranked, "k", "start", "rank", groups, BROADCAST_GROUPS, "start")
    return placed.select("k", (F.col("number") - F.col("start")).alias("index"), "doc_id", "digest", "forged")


@dataclass(frozen=True)
class Manifest:
    """The trees of all groups, the tree over their roots, and its root (NULL without rows)."""

    groups: Trees
    top: Trees
    root: str | None

    def table(self) -> DataFrame:
        """(tree, level, k, block, n, nodes, root): all blocks; level 0 holds the leaves."""
        rows = [
            t.select(F.lit(name).alias("tree"), F.lit(i).alias("level"), "k", "block", "n", "nodes", "root")
            for name, trees in (("groups", self.groups), ("top", self.top))
            for i, t in enumerate(trees.levels)
        ]
        return reduce(DataFrame.unionByName, rows)


def manifest(docs: DataFrame) -> Manifest:
    """Hash trees over the rows of ``docs`` (columns FIELDS; others are not read).

    Rows of one lang ascend by doc_id, NULL first, equal ids by digest. A repeated row is a leaf
    each. NULL lang is a group of its own.
    """
    groups = grow(leaves(docs), "doc_id bigint, digest binary, forged binary")
    ordered = with_row_index(groups.roots, ["k"], "index").select(
        F.lit("").alias("k"), F.col("k").alias("name"), "index", "digest"
    )
    top = grow(ordered, "name string")
    root = top.roots.first()
    return Manifest(groups, top, root.digest.hex() if root else None)


PROOF = """doc_id bigint, leaf string, subroot string, root string, proof_sha256 string,
    folded_root string, verified boolean"""


def proofs(made: Manifest) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every leaf.

    The proof is the digests beside the leaf's path, from the leaf up to the root, left to right.
    ``folded_root`` follows from it and the forged leaf, or the leaf where there is none.
    """
    root, fields = made.root, T.StructType.fromDDL(PROOF)
    below = T.StructType.fromDDL(f"k string, steps {STEPS}, subroot string")

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _table(batches)
        if rows is None:
            return
        r = rows.to_pylist()[0]
        up = _unpacked(r["steps"])
        block = Block(height_of(r["block"], r["n"]), r["n"], r["nodes"])
        steps = steps_within(block)
        yield from _made(
            [(name, _packed([*s, *up]), block.get(block.height, i)) for i, (name, s) in enumerate(zip(r["name"], steps))],
            below,
        )

    start = made.top.roots.select(
        "k", F.array().cast(STEPS).alias("steps"), F.lit(None).cast("string").alias("subroot")
    )
    down = steps_down(made.top, start).drop("subroot")
    above = (
        made.top.levels[0].join(down, ["k", "block"]).groupBy("k", "block")
        .applyInArrow(named, below)
    )

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _table(batches)
        if rows is None:
            return
        r = rows.to_pylist()[0]
        up = _unpacked(r["steps"])
        block = Block(height_of(r["block"], r["n"]), r["n"], r["nodes"])
        beside = "".join(a + b for a, b in up)
        out, known = [], {}
        for i, (doc, forged, steps) in enumerate(zip(r["doc_id"], r["forged"], steps_within(block))):
            leaf = block.get(block.height, i)
            value = leaf if forged is None else forged.hex()
            # the block's root is the same for all leaves that are as they were
            reached = folded(value, steps)
            if reached not in known:
                known[reached] = folded(reached, up)
            found = known[reached]
            proof = digest("".join(a + b for a, b in steps) + beside)
            out.append((doc, leaf, r["subroot"], root, proof, found, found == root))
        yield from _made(out, fields)

    blocks = made.groups.levels[0].select("k", "block", "n", "nodes", "doc_id", "forged")
    joined = blocks.join(steps_down(made.groups, above), ["k", "block"])
    return joined.groupBy("k", "block").applyInArrow(prove, fields)


def merkle_proofs(docs: DataFrame) -> DataFrame:
    """``proofs`` of the manifest of ``docs``; an empty table gives no rows."""
    return proofs(manifest(docs))
