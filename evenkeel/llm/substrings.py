"""Repeated word passages, by suffix automata over shards of reference text.

A word is removed if a window of ``window`` words around it also starts in a document
with a smaller id. Streaming every document past the automaton of every earlier one
would grow with the square of the corpus, so the reference text is sharded by anchor
and an automaton is sent only to the text that shares its anchor:

1.  The anchor of a window is the smallest digest among its ``gram``-word grams. A run
    of windows with one anchor is a segment. Equal windows have equal anchors, so they
    lie in segments of the same anchor; an anchor within one document needs no more.
2.  Equal segments are one reference, that of the smallest id. Any later document with
    the segment loses all of its windows; no automaton is needed for copies.
3.  The distinct segments of an anchor are a shard. They pass through the automaton of
    the shard in the order of their ids: matching statistics tell, for each window, the
    first document that has it, and then the segment is added.
4.  A shard of more than ``shard_segments`` distinct segments is halved by where the
    anchor stands in a window. Windows of either half have words in common on both sides
    of the anchor, which are the key of the half: equal windows meet again, and segments
    that only share the anchor part. A half is a shard of its own, with steps 2 and 3;
    after six halvings its windows are of one place and equal.
5.  The covered spans of a document are joined and cut from its words.

Digests of words have 64 bits and those of segments and shards 128, so that a mistaken
match is not to be expected. Texts are whole throughout; what a task holds is one
document, or one bounded shard.

Defined results: a null or blank text has no words; a text below the window keeps all
words. A null doc_id is smaller than no other and larger than none: such a row keeps
its words and is no reference. Rows that repeat an id are one document for the order,
and none of them is a reference for another; spans go with the digest of the text, so
each is cut by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import word_blocks
from evenkeel.session import stage


@dataclass(frozen=True)
class Passages:
    window: int = 50
    gram: int = 9
    shard_segments: int = 512


class Words:
    """The words of a text and 64-bit digests of them."""

    def __init__(self, text: str | None):
        self.words = [w for block in word_blocks(text) for w in block]
        digest = xxhash.xxh3_64_intdigest
        self.digests = np.fromiter((digest(w) for w in self.words), np.uint64, len(self.words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, by doubling."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[:len(x) - (width - done)], x[width - done:]) if done < width else x


def segments(digests: np.ndarray, how: Passages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, windows) of the runs of windows with one anchor."""
    if len(digests) < how.window:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    n = len(digests) - how.gram + 1
    grams = np.zeros(n, np.uint64)
    for i in range(how.gram):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + digests[i:n + i]
    anchors = _least(_mixed(grams), how.window - how.gram + 1)
    starts = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
    return anchors[starts].view(np.int64), starts, np.diff(np.r_[starts, len(anchors)])


def _key(digests: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(digests)


SEGMENTS = "anchor long, segment binary, doc_id long, digest long, first int, windows int"


def _segments(how: Passages):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], [], [], [], []]
            for doc_id, digest, text in zip(batch.column("doc_id").to_pylist(),
                                            batch.column("digest").to_pylist(), batch.column("text")):
                digests = Words(text.as_py()).digests
                anchors, starts, counts = segments(digests, how)
                out[0].append(anchors)
                out[1] += [_key(digests[s:s + c + how.window - 1]) for s, c in zip(
                    starts.tolist(), counts.tolist())]
                out[2].append(np.full(len(anchors), doc_id, np.int64))
                out[3].append(np.full(len(anchors), digest, np.int64))
                out[4].append(starts.astype(np.int32))
                out[5].append(counts.astype(np.int32))
            columns = [pa.array(c, pa.binary()) if i == 1 else pa.array(np.concatenate(c))
                       for i, c in enumerate(out)] if out[0] else None
            if columns:
                yield pa.RecordBatch.from_arrays(
                    columns, names=["anchor", "segment", "doc_id", "digest", "first", "windows"])

    return run


class Automaton:
    """Suffix automaton of several word sequences; a state knows its first document."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.first = [-1], [0], [None]

    def _state(self, length: int, first, follow: dict, link: int) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.first.append(first)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, before: int, word, state: int) -> int:
        """A copy of the state for its shorter sequences."""
        copy = self._state(self.length[before] + 1, self.first[state],
                           dict(self.next[state]), self.link[state])
        while before >= 0 and self.next[before].get(word) == state:
            self.next[before][word] = copy
            before = self.link[before]
        self.link[state] = copy
        return copy

    def add(self, words: list, doc) -> None:
        last = 0
        for word in words:
            ahead = self.next[last].get(word)
            if ahead is not None:
                short = self.length[ahead] > self.length[last] + 1
                last = self._split(last, word, ahead) if short else ahead
                continue
            new = self._state(self.length[last] + 1, doc, {}, 0)
            at = last
            while at >= 0 and word not in self.next[at]:
                self.next[at][word] = new
                at = self.link[at]
            if at >= 0:
                ahead = self.next[at][word]
                short = self.length[ahead] > self.length[at] + 1
                self.link[new] = self._split(at, word, ahead) if short else ahead
            last = new

    def first_with(self, words: list, window: int) -> list:
        """For each window of the sequence, the first document that has it, or None."""
        state, matched, found = 0, 0, []
        for place, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            while self.length[self.link[state]] >= window if state else False:
                state = self.link[state]
                matched = self.length[state]
            if place >= window - 1:
                found.append(self.first[state] if matched >= window else None)
        return found


def _runs(flags: list[bool]) -> list[tuple[int, int]]:
    """(first, count) of the runs of true flags."""
    edges = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    return list(zip(edges[::2].tolist(), (edges[1::2] - edges[::2]).tolist()))


SPANS = "doc_id long, digest long, first int, windows int"


def _spans(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      names=["doc_id", "digest", "first", "windows"])


def _match_shards(how: Passages):
    """Segments come by shard and, within it, by document; one automaton at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, automaton = None, None
        for batch in batches:
            rows = []
            for key, doc, digest, first, raw in zip(*(batch.column(c).to_pylist() for c in (
                    "shard", "doc_id", "digest", "first", "words"))):
                if automaton is None or key != shard:
                    shard, automaton = key, Automaton()
                words = np.frombuffer(raw, np.int64).tolist()
                seen = automaton.first_with(words, how.window)
                rows += [(doc, digest, first + s, n) for s, n in _runs([
                    x is not None and x < doc for x in seen])]
                automaton.add(words, doc)
            if rows:
                yield _spans(rows)

    return run


PIECES = "anchor long, hot boolean, doc_id long, digest long, first int, words binary"


def _pieces(how: Passages):
    """The digests of the asked segments of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, digest, text, asked in zip(
                    batch.column("doc_id").to_pylist(), batch.column("digest").to_pylist(),
                    batch.column("text"), batch.column("asked").to_pylist()):
                digests = Words(text.as_py()).digests
                for x in asked:
                    part = digests[x["first"]:x["first"] + x["windows"] + how.window - 1]
                    out.append((x["anchor"], x["hot"], doc_id, digest, x["first"], part.tobytes()))
            for i in range(0, len(out), 4_096):
                columns = zip(*out[i:i + 4_096])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (
                        pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                    names=["anchor", "hot", "doc_id", "digest", "first", "words"])

    return run


# A part of a segment: ``place`` is where the anchor stands in its words; windows have it
# between ``low`` and ``high`` places after their first word.
PARTS = ("shard binary, segment binary, doc_id long, digest long, first int, windows int, low int, high int, "
         "place int, words binary")
_PART_TYPES = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(),
               pa.int32(), pa.binary())


def _halves(words: np.ndarray, place: int, low: int, high: int, window: int) -> Iterator[tuple]:
    """(shard, segment, first window, windows, low, high, place, words) of the halves of a part."""
    middle = (low + high) // 2
    for a, b in ((low, middle), (middle + 1, high)):
        begin = max(0, place - b)
        end = min(len(words) - window, place - a)
        if a > b or begin > end:
            continue
        core = words[place - a:place - b + window].tobytes()  # what all windows of the half have
        part = words[begin:end + window]
        yield (xxhash.xxh3_128_digest(f"{a} {b} ".encode() + core),
               xxhash.xxh3_128_digest(f"{place - begin} ".encode() + part.tobytes()),
               begin, end - begin + 1, a, b, place - begin, part.tobytes())


def _placed(words: np.ndarray, anchor: int, how: Passages) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first window, place, words) of the runs of windows with the anchor's first gram at one place."""
    n = len(words) - how.gram + 1
    grams = np.zeros(n, np.uint64)
    for i in range(how.gram):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + words[i:n + i]
    places = np.flatnonzero(_mixed(grams).view(np.int64) == anchor)
    at = places[np.searchsorted(places, np.arange(len(words) - how.window + 1))]
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(at)]):
        yield s, int(at[s]) - s, words[s:e + how.window - 1]


def _split(how: Passages, whole: bool):
    """Halves of whole segments, or of their parts."""
    def halves(row: dict) -> Iterator[tuple]:
        words = np.frombuffer(row["words"], np.uint64)
        parts = ((s, p, w, 0, how.window - how.gram) for s, p, w in _placed(words, row["anchor"], how)) if whole else [
            (0, row["place"], words, row["low"], row["high"])]
        for start, place, own, low, high in parts:
            for shard, segment, begin, windows, *rest in _halves(own, place, low, high, how.window):
                yield (shard, segment, row["doc_id"], row["digest"], row["first"] + start + begin, windows, *rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [x for row in batch.to_pylist() for x in halves(row)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PART_TYPES)],
                                                 names=[x.split()[0] for x in PARTS.split(", ")])

    return run


def _matched(parts: DataFrame, how: Passages) -> DataFrame:
    return parts.select("shard", "doc_id", "digest", "first", "words").repartition("shard").sortWithinPartitions(
        "shard", "doc_id", "digest", "first").mapInArrow(_match_shards(how), SPANS)


def _met(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Copies of references, the references, and how many distinct segments a shard has.

    Copies lose all of their windows; a reference may stand several times in its document.
    """
    shared = rows.groupBy(key).agg(
        F.min("doc_id").alias("low_id"), F.max("doc_id").alias("high_id")).where("low_id < high_id")
    met = stage(rows.join(shared.select(key), key, "left_semi"), "shared-segments")
    lows = stage(met.groupBy(key, "segment").agg(F.min("doc_id").alias("_low")), "references")
    placed = met.join(lows, [key, "segment"])
    copies = placed.where("doc_id > _low").select("doc_id", "digest", "first", "windows")
    sizes = lows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return copies, placed.where("doc_id = _low").drop("_low"), sizes


def covered(docs: DataFrame, how: Passages = Passages()) -> DataFrame:
    """(doc_id, digest, first, windows): runs of windows that an earlier document has, too."""
    known = docs.where("doc_id is not null and text is not null").select(
        "doc_id", F.xxhash64("text").alias("digest"), "text")
    cut = stage(known.mapInArrow(_segments(how), SEGMENTS), "segments")
    found, references, sizes = _met(cut, "anchor")
    asked = references.select("anchor", "doc_id", "digest", "first", "windows").distinct().join(
        sizes, "anchor").groupBy("doc_id", "digest").agg(F.collect_list(F.struct(
            "anchor", "first", "windows", (F.col("n") > how.shard_segments).alias("hot"))).alias("asked"))
    pieces = stage(known.join(asked, ["doc_id", "digest"]).select("doc_id", "digest", "text", "asked").mapInArrow(
        _pieces(how), PIECES), "reference-pieces")
    found = found.unionByName(_matched(pieces.where("not hot").withColumn(
        "shard", F.col("anchor").cast("string").cast("binary")), how))
    large, whole = pieces.where("hot"), True
    while not large.isEmpty():
        parts = stage(large.mapInArrow(_split(how, whole), PARTS), "segment-halves")
        copies, references, sizes = _met(parts, "shard")
        sized = stage(references.join(sizes, "shard"), "half-references")
        found = found.unionByName(copies).unionByName(_matched(sized.where(F.col("n") <= how.shard_segments), how))
        large, whole = sized.where(F.col("n") > how.shard_segments).drop("n"), False
    return found


KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _cut(how: Passages, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, spans in zip(batch.column("doc_id").to_pylist(), batch.column("text"),
                                           batch.column("spans").to_pylist()):
                words = [w for block in word_blocks(text.as_py()) for w in block]
                n = len(words)
                if spans:
                    edges = np.zeros(n + 1, np.int64)
                    for x in spans:
                        edges[x["first"]] += 1
                        edges[x["first"] + x["windows"] + how.window - 1] -= 1
                    keep = np.cumsum(edges[:-1]) == 0
                    words = [w for w, k in zip(words, keep.tolist()) if k]
                raw = b" ".join(words)
                out.append((doc_id, n, n - len(words), hashlib.sha256(raw).hexdigest(),
                            raw.decode("utf-8", "surrogatepass") if with_text else None))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (
                        pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return run


def remove_passages(docs: DataFrame, how: Passages = Passages(), with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) of every row of docs (doc_id, text)."""
    spans = covered(docs, how).groupBy("doc_id", "digest").agg(
        F.collect_set(F.struct("first", "windows")).alias("spans"))
    return docs.select("doc_id", F.xxhash64("text").alias("digest"), "text").join(
        spans, ["doc_id", "digest"], "left").select("doc_id", "text", "spans").mapInArrow(_cut(how, with_text), KEPT)
