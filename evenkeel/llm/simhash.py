"""SimHash near-duplicates through a hierarchical index in Gray order.

A document's fingerprint is the bitwise majority over the XXH64 of its word
shingles. Distinct fingerprints are sorted by Gray rank, in which neighbours share
most of their bits, and cut into blocks. A node of the index stands for a run of
the order and keeps the bits that all of the run share and its parent does not; the
differences from a query add up on the way down, and a node beyond the limit is
left with its whole group. The upper levels stand over the blocks and say which
blocks a group of neighbours must visit; each block then builds its own lower levels.

Exact copies share a fingerprint and meet in one row before any search. A
fingerprint has at most C(64, 1) + C(64, 2) others within two bits, and a block
answers with a spanning forest of the links it finds, so no group is expanded into
pairs.

Defined results: a null or blank text has fingerprint zero and is linked like any
other. A null doc_id takes part in links but never names a component; a component
of null ids only has a null component_id. Repeated rows each get a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from evenkeel.llm.common import packed, word_blocks
from evenkeel.llm.components import components
from evenkeel.session import stage

SEED = 42
FANOUT = 4
BLOCK = 16_384     # fingerprints a block has at least
MOST_BLOCKS = 65_536  # so that the upper levels, which every task holds, take a few MB
GROUP = 64         # neighbours that travel together
BATCH = 2_048      # queries searched at a time


def _majority(text: str | None, shingle: int) -> int:
    counts, total, carried = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest

    def add(shingles: list[bytes]) -> int:
        hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, len(shingles))
        for i in range(0, len(hashes), 65_536):
            part = hashes[i:i + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
            counts[:] += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        return len(hashes)

    for block in word_blocks(text, lower=True):
        found = carried + block
        if len(found) >= shingle:
            total += add([b" ".join(s) for s in zip(*(found[i:] for i in range(shingle)))])
        carried = found[-(shingle - 1):] if shingle > 1 else []
    if not total and carried:
        total = add([b" ".join(carried)])
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0]) if total else 0


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """64-bit SimHash of a text's lower-case (A-Z) word shingles, as a signed long."""
    @pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array(
            [_majority(t, shingle) for t in texts], np.uint64).view(np.int64))

    return run(text)


def gray_rank(code: Column) -> Column:
    """Position of a 64-bit code word in the reflected Gray order (as a signed long)."""
    for step in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, step))
    return code


class GrayIndex:
    """Index over runs of a Gray order, each given by the AND and the OR of its codes."""

    def __init__(self, ands: np.ndarray, ors: np.ndarray):
        levels = [(ands, ors)]
        while len(levels[-1][0]) > 1:
            cuts = np.arange(0, len(levels[-1][0]), FANOUT)
            levels.append((np.bitwise_and.reduceat(levels[-1][0], cuts),
                           np.bitwise_or.reduceat(levels[-1][1], cuts)))
        self.levels = []  # from the root down: bits a node adds to its parent's, and their pattern
        above = np.zeros(1, np.uint64)
        for low, high in reversed(levels):
            shared = ~(low ^ high)
            parents = above[np.arange(len(low)) // FANOUT] if self.levels else above
            self.levels.append((shared & ~parents, low & shared & ~parents))
            above = shared

    def search(self, codes: np.ndarray, within: int,
               known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Positions (of a code, of a run) whose shared bits differ in at most so many.

        Of a code that stands for a group, only the bits in ``known`` count.
        """
        if known is None:
            known = np.full(len(codes), ~np.uint64(0))
        query = np.arange(len(codes))
        node = np.zeros(len(codes), np.int64)
        apart = np.zeros(len(codes), np.uint8)
        for depth, (mask, pattern) in enumerate(self.levels):
            if depth:
                node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                query, apart = np.repeat(query, FANOUT), np.repeat(apart, FANOUT)
                there = node < len(mask)
                query, node, apart = query[there], node[there], apart[there]
            apart = apart + np.bitwise_count(
                (codes[query] ^ pattern[node]) & mask[node] & known[query])
            near = apart <= within
            query, node, apart = query[near], node[near], apart[near]
        return query, node


def _unsigned(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


class _Forest:
    """Links found in a block, kept as a forest over its entries."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def link(self, pairs: Iterator[tuple[int, int]]) -> None:
        for x, y in pairs:
            x, y = self.root(x), self.root(y)
            if x != y:
                self.parent[max(x, y)] = min(x, y)


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def _search_blocks(within: int):
    """Rows of a block are its entries, in order, and then the codes that visit it."""
    def visitors(codes: np.ndarray, index: GrayIndex, entries: np.ndarray, forest: _Forest):
        for i in range(0, len(codes), BATCH):
            part = codes[i:i + BATCH]
            query, found = index.search(part, within)  # in the order of the queries
            if len(query):
                first = np.r_[True, query[1:] != query[:-1]]
                heads = found[first]
                again = np.flatnonzero(~first)
                forest.link(zip(found[again].tolist(), heads[np.cumsum(first)[again] - 1].tolist()))
                yield _edges(part[query[first]], entries[heads])

    def own(entries: np.ndarray, index: GrayIndex, forest: _Forest) -> None:
        for i in range(0, len(entries), BATCH):
            query, found = index.search(entries[i:i + BATCH], within)
            later = found > query + i
            forest.link(zip((query[later] + i).tolist(), found[later].tolist()))

    def closed(entries: np.ndarray, forest: _Forest):
        roots = np.array([forest.root(x) for x in range(len(entries))], np.int64)
        rest = np.flatnonzero(roots != np.arange(len(entries)))
        if len(rest):
            yield _edges(entries[rest], entries[roots[rest]])

    def opened(held: list[np.ndarray]) -> tuple[np.ndarray, GrayIndex, _Forest]:
        entries = np.concatenate(held)
        index, forest = GrayIndex(entries, entries), _Forest(len(entries))
        own(entries, index, forest)
        return entries, index, forest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, entries, index, forest = None, [], None, None, None
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            visiting = batch.column("visits").to_numpy(zero_copy_only=False).astype(np.int8)
            codes = _unsigned(batch.column("codes").flatten())
            ends = np.r_[0, np.cumsum(pc.list_value_length(batch.column("codes")).to_numpy())]
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(visiting) != 0)) + 1
            for start, stop in zip(np.r_[0, cuts], np.r_[cuts, len(blocks)]):
                if start == stop:
                    continue
                if blocks[start] != block:
                    if held:
                        entries, index, forest = opened(held)
                    if forest is not None:
                        yield from closed(entries, forest)
                    block, held, forest = blocks[start], [], None
                part = codes[ends[start]:ends[stop]]
                if not visiting[start]:
                    held.append(part)
                else:
                    if held:
                        (entries, index, forest), held = opened(held), []
                    yield from visitors(part, index, entries, forest)
        if held:
            entries, index, forest = opened(held)
        if forest is not None:
            yield from closed(entries, forest)

    return run


def _visit_blocks(blocks: np.ndarray, upper: GrayIndex, within: int):
    """Groups of neighbours, as entries of their own block and as visitors of later ones.

    A block is left out for a whole group if the bits that all of the group share are
    too far from those that all of the block share.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home, codes = batch.column("block").to_numpy(), _unsigned(batch.column("code"))
            if not len(codes):
                continue
            new = np.r_[True, home[1:] != home[:-1]]
            place = np.arange(len(codes)) - np.maximum.accumulate(np.where(new, np.arange(len(codes)), 0))
            starts = np.flatnonzero(place % GROUP == 0)
            stops = np.r_[starts[1:], len(codes)]
            low, high = (f.reduceat(codes, starts) for f in (np.bitwise_and, np.bitwise_or))
            group, run_ = upper.search(low, within, ~(low ^ high))
            later = blocks[run_] > home[starts][group]
            group = np.r_[np.arange(len(starts)), group[later]]
            target = np.r_[home[starts], blocks[run_[later]]]
            sizes = (stops - starts)[group]
            ends = np.r_[0, np.cumsum(sizes)]
            values = np.repeat(starts[group] - ends[:-1], sizes) + np.arange(ends[-1])
            yield pa.RecordBatch.from_arrays([
                pa.array(target.astype(np.int32)),
                pa.array(np.arange(len(group)) >= len(starts)),
                pa.array(codes[starts][group].view(np.int64)),
                pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)),
                                         pa.array(codes[values].view(np.int64)))],
                names=["block", "visits", "first", "codes"])

    return run


def links(codes: DataFrame, within: int = 2) -> DataFrame:
    """Edges (a, b) that connect all distinct codes at most ``within`` bits apart.

    codes has one long column ``code`` without repeats. The edges are a spanning
    forest of the links in each block, not every link.
    """
    count = max(1, codes.count())
    size = max(BLOCK, -(-count // MOST_BLOCKS))
    cut = stage(
        codes.select("code", gray_rank(F.col("code")).alias("rank"))
        .repartitionByRange(-(-count // size), "rank").sortWithinPartitions("rank")
        .select("code", "rank", F.spark_partition_id().alias("block")), "gray-blocks")
    summary = cut.groupBy("block").agg(
        F.min("rank").alias("first"), F.bit_and("code").alias("low"),
        F.bit_or("code").alias("high")).orderBy("first").toPandas()
    if summary.empty:
        return cut.select(F.col("code").alias("a"), F.col("code").alias("b"))
    upper = GrayIndex(*(summary[c].to_numpy(np.int64).view(np.uint64) for c in ("low", "high")))
    groups = cut.select("block", "code").mapInArrow(
        _visit_blocks(summary["block"].to_numpy(np.int64), upper, within),
        "block int, visits boolean, first long, codes array<long>")
    return groups.repartition(len(summary), "block").sortWithinPartitions(
        "block", "visits", gray_rank(F.col("first"))).select("block", "visits", "codes").mapInArrow(
        _search_blocks(within), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, within: int = 2,
                    digest: bool = False) -> DataFrame:
    """(doc_id, code, component_id) of every row of docs (doc_id, text).

    With ``digest`` come the XXH64 of the text, to tell rows of one id apart, and the
    smallest code of the component as ``root``, since rows of one id may name several.
    """
    key = [F.xxhash64("text").alias("digest")] if digest else []
    prints = stage(docs.select("doc_id", *key, fingerprint(F.col("text"), shingle).alias("code")),
                   "fingerprints")
    codes = stage(prints.groupBy("code").agg(F.min("doc_id").alias("first")), "codes")
    groups = stage(components(links(codes.select("code"), within)), "components")
    linked = codes.join(groups, codes["code"] == groups["node"]).select("code", "component", "first")
    least = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    named = linked.join(least, "component").select("code", F.col("component").alias("root"),
                                                   "component_id")
    alone = codes.join(named.select("code"), "code", "left_anti").select(
        "code", F.col("code").alias("root"), F.col("first").alias("component_id"))
    classes = stage(named.unionByName(alone), "classes")
    return prints.join(classes, "code").select(
        *prints.columns, *(["root"] if digest else []), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, within: int = 2) -> DataFrame:
    """The documents without near-duplicates of earlier ones, with their columns.

    Of a component, the row with the smallest id stays; of rows that repeat this id,
    the one whose text has the smallest digest, and one of those that are the same.
    Of a component without any id, the row whose text has the smallest digest stays.
    """
    keyed = packed(docs, "doc_id", "text").withColumn("_digest", F.xxhash64("text"))
    found = stage(near_duplicates(docs, shingle, within, digest=True), "duplicates")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    kept = found.where(first).groupBy("root").agg(F.min("digest").alias("_least"))
    once = found.join(kept, "root").withColumn(
        "_stays", first & (F.col("digest") == F.col("_least")))
    gone = once.where("not _stays").select("doc_id", "digest").distinct()
    twice = once.where("_stays").groupBy("doc_id", "digest").agg(
        F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", "digest")

    def same(other: DataFrame) -> Column:
        return keyed["doc_id"].eqNullSafe(other["doc_id"]) & keyed["_digest"].eqNullSafe(other["digest"])

    repeats = keyed.join(twice, same(twice), "left_semi").dropDuplicates(["doc_id", "_digest"])
    rest = gone.unionByName(twice)
    single = keyed.join(rest, same(rest), "left_anti")
    return single.unionByName(repeats).select("_row.*")
