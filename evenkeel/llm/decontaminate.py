"""Benchmark passages in documents, by q-gram counting and banded alignment.

Two strings within k edits share at least m + 1 - q * (k + 1) of their q-grams, m
being the length of the item, and all of these lie within k + 1 neighbouring
diagonals (position in the document minus position in the item). The q-grams of a
document are looked up among those of the items and counted in diagonal bands that
overlap by half, so that some band holds any k + 1 neighbours; bands that reach the
bound are verified by an alignment within the band. Filtering loses nothing.

Texts and items are compared in lower case with runs of blanks as one space. Items
come in shards of bounded size, of which a task holds one; a benchmark of several
shards takes one pass over the documents for each, after another in ``clean``.

Defined results: a null or empty text has no passages; a null item, or one shorter
than ``min_item_chars``, is in no document. Repeated items each report. Every row
is judged by itself, so null and repeated ids are kept apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from evenkeel.session import stage

PASSAGES = "array<struct<item_id:bigint,start:int,stop:int,edits:int>>"
_PASSAGE_TYPE = pa.list_(pa.struct([
    ("item_id", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("edits", pa.int32())]))


@dataclass(frozen=True)
class Matching:
    q: int = 12
    edit_share: float = 0.05     # edits allowed, as a share of an item's characters
    min_item_chars: int = 20
    shard_chars: int = 4_000_000  # characters of items that a task holds at once


def _lower_table() -> np.ndarray:
    """Lower case by code point of the basic plane, where that is one character."""
    table = np.arange(65_536, dtype=np.uint32)
    for c in range(65_536):
        low = chr(c).lower()
        if len(low) == 1:
            table[c] = ord(low)
    for c in (9, 10, 11, 12, 13):
        table[c] = 32
    return table


class Normal:
    """Code points in lower case, one space for a run of blanks, and their places."""

    lower = _lower_table()

    def __init__(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.where(points < 65_536, self.lower[points & 65_535], points)
        blank = points == 32
        keep = np.r_[True, ~(blank[1:] & blank[:-1])] if len(points) else np.zeros(0, bool)
        self.places = np.flatnonzero(keep)
        self.points = points[keep]


def _grams(points: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit code for each q-gram."""
    n = len(points) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide = points.astype(np.uint64)
    code = np.zeros(n, np.uint64)
    for i in range(q):
        code *= np.uint64(0x9E3779B97F4A7C15)
        code += wide[i:n + i]
    return code ^ (code >> np.uint64(29))


def align(item: np.ndarray, text: np.ndarray, low: int, width: int, most: int):
    """Least edits of the item within the text, and where it starts and stops.

    Only cells of the diagonals from low to low + width count: row i of the item,
    place low + i + d of the text. Start and stop are free. None beyond ``most``.
    A cell carries its edits and its start in one number, edits first.
    """
    m, n, far, unit = len(item), len(text), np.int64(1) << 60, np.int64(1) << 32
    d = np.arange(width + 1)
    place = low + d  # places before which row 0 stands
    row = np.where((place >= 0) & (place <= n), np.maximum(place, 0), far).astype(np.int64)
    padded = np.r_[text, np.full(1, 0xFFFFFFFF, np.uint32)]
    for i in range(m):
        at = low + i + d
        there = (at >= 0) & (at < n)
        same = padded[np.where(there, at, n)] == item[i]
        best = np.where(there, row + np.where(same, 0, unit), far)   # substitute or take
        best[:-1] = np.minimum(best[:-1], row[1:] + unit)             # leave the item's character out
        stand = (at + 1 >= 0) & (at + 1 <= n)
        best = np.where(stand, best, far)
        best = np.minimum.accumulate(best - d * unit) + d * unit       # leave characters of the text out
        row = np.where(stand, best, far)
        if row.min() >= (most + 1) * unit:
            return None
    end = int(row.argmin())
    edits, start = int(row[end] >> 32), int(row[end] & 0xFFFFFFFF)
    return (edits, start, low + m + end) if edits <= most else None


class Items:
    """The q-grams of a shard of items."""

    FILTER_BITS = 22

    def __init__(self, items: list[tuple[int, str]], how: Matching):
        self.how, self.items = how, []
        for item_id, text in items:
            points = Normal((text or "").strip()).points
            m = len(points)
            if m >= max(how.min_item_chars, how.q):
                # No more edits than the lemma can tell from chance.
                edits = min(int(how.edit_share * m), m // how.q - 1)
                self.items.append((item_id, points, points.tobytes(), edits,
                                   m + 1 - how.q * (edits + 1)))
        codes = [_grams(x[1], how.q) for x in self.items]
        self.item = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        self.place = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.zeros(0, int)
        code = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        order = np.argsort(code, kind="stable")
        self.item, self.place, code = self.item[order], self.place[order], code[order]
        self.code, self.first, self.count = np.unique(code, return_index=True, return_counts=True)
        self.shift = np.uint64(64 - self.FILTER_BITS)
        self.seen = np.zeros(1 << self.FILTER_BITS, bool)
        self.seen[(self.code >> self.shift).astype(np.int64)] = True
        self.half = np.array([max(1, x[3]) for x in self.items], np.int64)
        self.least = np.array([x[4] for x in self.items], np.int64)

    def _hits(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, diagonal) of every q-gram that text and item share."""
        code = _grams(points, self.how.q)
        at = np.flatnonzero(self.seen[(code >> self.shift).astype(np.int64)])
        code = code[at]
        slot = np.searchsorted(self.code, code)
        slot[slot == len(self.code)] = 0
        real = self.code[slot] == code
        at, slot = at[real], slot[real]
        times = self.count[slot]
        # All places of the items that have the q-gram: runs first, first + 1, ...
        step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        entry = np.repeat(self.first[slot], times) + step
        return self.item[entry], np.repeat(at, times) - self.place[entry]

    def passages(self, text: str | None) -> list[dict]:
        if not text or not len(self.code):
            return []
        normal = Normal(text)
        item, diagonal = self._hits(normal.points)
        if not len(item):
            return []
        # Band b of half width h covers diagonals b * h to (b + 2) * h - 1.
        band = diagonal // self.half[item]
        key = np.concatenate([item, item]) << 40 | (np.concatenate([band, band - 1]) + (1 << 39))
        key, count = np.unique(key, return_counts=True)
        owner = key >> 40
        kept = count >= self.least[owner]
        found = {}
        for which, b in zip(owner[kept].tolist(), ((key[kept] & ((1 << 40) - 1)) - (1 << 39)).tolist()):
            item_id, points, raw, edits, _ = self.items[which]
            low, width = b * int(self.half[which]), 2 * int(self.half[which]) + 2 * edits
            hit = self._exact(normal.points, raw, low, width, len(points)) or align(
                points, normal.points, low - edits, width, edits)
            if hit and hit[2] > hit[1]:
                spot = (which, hit[1], hit[2])
                found[spot] = min(hit[0], found.get(spot, edits))
        return [{"item_id": self.items[which][0], "start": int(normal.places[start]),
                 "stop": int(normal.places[stop - 1]) + 1, "edits": edits}
                for (which, start, stop), edits in sorted(found.items())]

    @staticmethod
    def _exact(points: np.ndarray, raw: bytes, low: int, width: int, m: int):
        """The item as it is, which needs no alignment."""
        low = max(low, 0)
        region = points[low:max(0, low + width + m)].tobytes()
        at = region.find(raw)
        while at % 4 and at >= 0:
            at = region.find(raw, at + 1)
        return (0, low + at // 4, low + at // 4 + m) if at >= 0 else None


def _shards(benchmark: DataFrame, how: Matching) -> Iterator[list[tuple[int, str]]]:
    """Items in lists of about ``shard_chars``; one shard is held at a time on the way."""
    chars = benchmark.agg(F.sum(F.char_length("text"))).first()[0] or 0
    shards = -(-chars // how.shard_chars) or 1
    rows = benchmark.select("item_id", "text").where("text is not null")
    slot = F.pmod(F.xxhash64("item_id", "text"), F.lit(shards))
    for i in range(shards):
        yield [tuple(r) for r in rows.where(slot == i).orderBy("item_id", "text").collect()]


def _finder(shipped: Broadcast, how: Matching):
    @arrow_udf(PASSAGES)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = Items(shipped.value, how)
        for texts in batches:
            yield pa.array([index.passages(t) for t in texts.to_pylist()], _PASSAGE_TYPE)

    # Else a filter on what is found would align the texts once more.
    return run.asNondeterministic()


def matches(docs: DataFrame, benchmark: DataFrame, how: Matching = Matching()) -> DataFrame:
    """(doc_id, item_id, start, stop, edits) of every passage in docs (doc_id, text).

    Shards are branches of a union: their tasks are apart, and each holds its shard only.
    """
    context = benchmark.sparkSession.sparkContext
    found = [
        docs.select("doc_id", _finder(context.broadcast(items), how)("text").alias("_found")).select(
            "doc_id", F.inline("_found"))
        for items in _shards(benchmark, how)]
    return reduce(DataFrame.unionAll, found)


def clean(docs: DataFrame, benchmark: DataFrame, how: Matching = Matching()) -> DataFrame:
    """The documents that hold no benchmark passage, with their columns.

    What one shard leaves is written before the next is looked for, so that no task
    holds two.
    """
    context, left = benchmark.sparkSession.sparkContext, None
    for items in _shards(benchmark, how):
        docs = docs if left is None else stage(left, "decontaminated")
        left = docs.where(F.size(_finder(context.broadcast(items), how)("text")) == 0)
    return left
