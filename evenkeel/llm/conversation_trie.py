"""Prefix trie of conversations, grouped by blocks of turns before single turns.

A node is a distinct sequence of first turns; its members are the conversations that
begin with it. Turns become digests at once, so texts are never shuffled.

1.  A conversation is streamed in the order of its turns and cut into blocks of
    ``BLOCK`` turns. A block's key chains the key above it with the digests of its
    turns, so equal keys are equal prefixes, and so are the keys of the turns within.
2.  Conversations are grouped by (key above, key of the block): one row for every
    ``BLOCK`` turns, combined before the shuffle.
3.  Where all members below a key go on with one block, its turn boundaries have the
    members of the block. Only where siblings diverge, the blocks are opened and their
    turns grouped by their own keys.
4.  Sums over subtrees go up by doubling: a node hands what it has gathered to the
    ancestor 1, 2, 4, ... levels above, so rounds grow with the logarithm of the depth.

What a task holds is a block of turns. Keys have 128 bits.

Defined results: a null role or text is empty. Turns are in the order of ``turn``, null
first; equal ones by role and then by digest; a repeated row is a turn of its own. Rows
without a conv_id belong to no conversation. A conversation that is only in
``conversations`` has no turns and is a member of the root. Without any conversation
there are no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.session import stage

BLOCK = 4               # turns of a block
ROOT = bytes(16)
ENDS_BYTES = 1 << 16    # of joined ids that are hashed at a time

NO_TURNS = hashlib.sha256(b"").hexdigest()


def digested(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, chars) of turns (conv_id, turn, role, text)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return turns.where("conv_id is not null").select(
        "conv_id", "turn", role.alias("role"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("digest"),
        F.char_length(text).cast("long").alias("chars"))


BLOCKS = "conv_id long, depth int, above binary, steps array<binary>, chars array<long>, last boolean"


class _Blocks:
    """Blocks of the conversation that is being read, in columns."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.conv = None

    def begin(self, conv: int) -> None:
        self.conv, self.depth, self.above = conv, 0, ROOT
        self.chain, self.steps, self.chars = hashlib.blake2b(ROOT, digest_size=16), [], []

    def turn(self, digest: bytes, chars: int) -> None:
        if len(self.steps) == BLOCK:
            self.close(False)
        self.chain.update(digest)
        self.steps.append(self.chain.digest())
        self.chars.append(chars)

    def close(self, last: bool) -> None:
        self.rows.append((self.conv, self.depth, self.above, self.steps, self.chars, last))
        if not last:
            self.depth, self.above = self.depth + len(self.steps), self.steps[-1]
            self.chain = hashlib.blake2b(self.above, digest_size=16)
            self.steps, self.chars = [], []

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        types = (pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.bool_())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)],
            names=["conv_id", "depth", "above", "steps", "chars", "last"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by conversation and turn; a row without a digest only names its conversation."""
    found = _Blocks()
    for batch in batches:
        for conv, digest, chars in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "digest", "chars"))):
            if conv != found.conv:
                if found.conv is not None:
                    found.close(True)
                found.begin(conv)
            if digest is not None:
                found.turn(digest, chars)
            if len(found.rows) >= 4096:
                yield found.batch()
    if found.conv is not None:
        found.close(True)
        yield found.batch()


def blocks(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The blocks of each conversation; turns (conv_id, turn, role, digest, chars)."""
    named = conversations.where("conv_id is not null").select("conv_id").distinct().select(
        "conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("digest"),
        F.lit(None).cast("long").alias("chars"))
    rows = turns.select("conv_id", F.lit(1).alias("part"), F.col("turn").cast("long"), "role", "digest", "chars")
    return rows.unionByName(named).repartition("conv_id").sortWithinPartitions(
        "conv_id", "part", "turn", "role", "digest").select("conv_id", "digest", "chars").mapInArrow(_cut, BLOCKS)


def _opened(groups: DataFrame) -> DataFrame:
    """A row for each turn boundary of the groups (above, steps, chars, depth, n, low)."""
    step = F.posexplode(F.arrays_zip("steps", "chars", F.concat(
        F.array("above"), "steps").alias("parents")))
    return groups.select("depth", "n", "low", step).select(
        F.col("col.steps").alias("node"), F.col("col.parents").alias("parent"),
        (F.col("depth") + F.col("pos") + 1).alias("depth"), "n", "low",
        F.col("col.chars").alias("chars")).where("node is not null")


def nodes(cut: DataFrame) -> DataFrame:
    """(node, parent, depth, n, low, chars): every node but the root; low is the least member."""
    groups = stage(cut.where(F.size("steps") > 0).groupBy(
        "above", F.element_at("steps", -1).alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"), F.first("depth").alias("depth"),
        F.first("steps").alias("steps"), F.first("chars").alias("chars")), "block-groups")
    forks = groups.groupBy("above").agg(F.count(F.lit(1)).alias("ways")).where("ways > 1").select("above")
    single = _opened(groups.join(forks, "above", "left_anti"))
    refined = _opened(groups.join(forks, "above", "left_semi")).groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.sum("n").alias("n"),
        F.min("low").alias("low"), F.first("chars").alias("chars"))
    return single.unionByName(refined)


def _subtrees(tree: DataFrame, deepest: int) -> DataFrame:
    """(node, leaves, saved) summed over subtrees, from tree (node, parent, leaves, saved)."""
    now, reach = tree.withColumnRenamed("parent", "up"), 1
    while reach <= deepest:
        given = now.where("up is not null").groupBy(F.col("up").alias("node")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        further = now.where("up is not null").select(F.col("node").alias("up"), F.col("up").alias("next"))
        now = stage(now.join(given, "node", "left").join(further, "up", "left").select(
            "node", F.col("next").alias("up"),
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "subtrees")
        reach *= 2
    return now.drop("up")


def trie(turns: DataFrame, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes, and (node, conv_id) of the conversations that end at each.

    turns as ``digested`` gives them; conversations (conv_id) names members. A node has:
    node, parent, depth, conv_id (least member), parent_conv_id, n_convs, n_children,
    n_leaves (nodes without children in its subtree), and saved_tokens: summed over its
    subtree, how many code points of last texts need not be stored again.
    """
    cut = stage(blocks(turns, conversations), "blocks")
    ends = cut.where("last").select(
        F.when(F.size("steps") > 0, F.element_at("steps", -1)).otherwise(F.lit(ROOT)).alias("node"), "conv_id")
    root = cut.where("last").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low")).where(
        "n > 0").select(F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"),
                        F.lit(0).alias("depth"), "n", "low", F.lit(0).cast("long").alias("chars"))
    tree = stage(nodes(cut).unionByName(root), "nodes")
    children = tree.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children"))
    full = stage(tree.join(children, "node", "left").fillna(0, ["n_children"]).join(
        tree.select(F.col("node").alias("parent"), F.col("low").alias("parent_conv_id")), "parent", "left"),
        "trie-nodes")
    deepest = full.agg(F.max("depth")).first()[0] or 0
    sums = _subtrees(full.select(
        "node", "parent", (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n") - 1) * F.col("chars")).alias("saved")), deepest)
    return full.join(sums, "node").select(
        "node", "parent", F.col("depth").cast("long").alias("depth"), F.col("low").alias("conv_id"),
        "parent_conv_id", F.col("n").alias("n_convs"), "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens")), ends


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids come by node and number; those of a node are joined by commas, in bounded pieces."""
    node, first, ids, size = None, None, [], 0

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([node], pa.binary()), pa.array([first], pa.int64()),
             pa.array([",".join(ids).encode()], pa.binary())], names=["node", "first", "ids"])

    for batch in batches:
        for n, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
            if n != node or size >= ENDS_BYTES:
                if ids:
                    yield piece()
                node, first, ids, size = n, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
    if ids:
        yield piece()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of a node, which come one after another."""
    node, digest, out = None, None, ([], [])

    def table() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.binary()), pa.array(out[1], pa.string())], names=["node", "ends_sha256"])

    for batch in batches:
        for n, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if n == node:
                digest.update(b"," + ids)
                continue
            if digest is not None:
                out[0].append(node)
                out[1].append(digest.hexdigest())
            node, digest = n, hashlib.sha256(ids)
        if out[0]:
            yield table()
            out = ([], [])
    if digest is not None:
        out[0].append(node)
        out[1].append(digest.hexdigest())
        yield table()


def ends_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): the hash of the ids that end at a node, ascending, joined by commas.

    A hash cannot be taken in parts, but its input can be made in parts: the ids of a large
    node are sorted and joined by many tasks, and one task reads some bytes an id.
    """
    dealt = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = dealt.mapInArrow(_joined, "node binary, first long, ids binary")
    return pieces.repartition("node").sortWithinPartitions("node", "first").select("node", "ids").mapInArrow(
        _hashed, "node binary, ends_sha256 string")
