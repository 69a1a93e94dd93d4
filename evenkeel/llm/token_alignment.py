"""Two tokenizers aligned by bytes, and corpus-wide counts of linked pairs of their ids.

Both tokenizations of a text cover the same bytes, a space and the text. Where a token
of either ends, a boundary is; between two boundaries one token of side A overlaps one
of side B, which is a link. Where both end, a group ends. Both sides cut before a space
or a line break that no white space surrounds, so the pieces of a text between these
are aligned once each and kept; other texts are aligned as a whole.

How many documents hold a pair linked is counted outside memory:

1.  A task collects records (pair, document, links) of its documents. When it has
    ``run_records``, they are sorted by radix (low bits of the A id), A id, B id and
    document, and become one run: for each radix a zstd body of documents and links,
    and zstd blocks of (pair, documents). Runs are rows of a table, which Spark writes
    once, so a lost task leaves none.
2.  Blocks are merged: they come by radix and first pair, a heap holds those that are
    open, and what lies before the next block is added up. Beyond ``fan_in`` runs there
    are rounds, so a task holds that many blocks. The order is side-major: all pairs of
    an A id pass together, which gives their maximum with the counts.
3.  The counts stream back: the bodies of a radix, in slices of ``fan_in`` runs, meet its
    counts, and leave a sum for each document, added up over the radixes of a run.

A frequent id is spread over the runs, and a body meets each count once: no key gathers
the documents that have it. What a task holds is a run, ``fan_in`` blocks, or the
distinct pairs of a radix.

Defined results: a text that is null, empty, or whose tokens of a side are not the bytes
of a space and the text has no tokens: numbers are 0, and groups are the empty string.
Strings of special tokens are ordinary text. Rows that repeat an id, or have none, are
documents of their own.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.token_files import CHUNK, encoder_of
from evenkeel.session import stage


@dataclass(frozen=True)
class Counting:
    run_records: int = 4 << 20   # records of a run, or those of one document
    radix_bits: int = 5
    fan_in: int = 64             # runs that are merged at a time
    block_pairs: int = 1 << 16   # pairs of a block
    level: int = 1


RUN_DOCUMENTS = (1 << 16) - 1    # a body has 16 bits for the document of a record
KEPT_PIECES = 300_000            # pieces in a generation; the two last generations are kept
SPACE_MARK = "▁"


def _byte_of_character() -> dict[str, int]:
    """The published byte-level alphabet: printable Latin-1 stands for itself, other bytes from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_level_bytes(vocabulary: dict[str, int]) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary."""
    alphabet, found = _byte_of_character(), [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        if all(c in alphabet for c in token):
            found[i] = bytes(alphabet[c] for c in token)
    return found


def piece_bytes(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """Bytes of each id of a model with byte fallback."""
    found = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        found.append(bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE_MARK, " ").encode())
    return found


NO_TOKENS = (b"", b"", 0, 0, 0)


class Aligner:
    """Pairs and groups of texts under two tokenizers; pieces of text are kept."""

    def __init__(self, path_a: str, path_b: str):
        self.a = encoder_of(path_a, True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = byte_level_bytes(self.a.tokenizer.get_vocab())
        self.bytes_b = piece_bytes(self.b)
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        if any("\n" in p or SPACE_MARK in p.lstrip(SPACE_MARK) for p in map(
                self.b.id_to_piece, range(len(self.bytes_b)))):
            raise ValueError("tokens of B go across a space or a line break")
        self.lengths_a, self.lengths_b = (
            np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        # What an id adds to the text of its group, within its side and as the last of it.
        self.written = [f"{i}{mark}".encode() for n, last in (
            (len(self.bytes_a), "|"), (len(self.bytes_b), ";")) for i in range(n) for mark in (",", last)]
        self.kept: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}

    def align(self, ids_a: list[bytes], ids_b: list[list[int]], raw: list[bytes]) -> list[tuple | None]:
        """(pairs, groups, n_a, n_b, n_groups) of texts with these bytes; None where a side differs."""
        a = np.frombuffer(b"".join(ids_a), "<u4").astype(np.int64)
        n_a = np.array([len(x) // 4 for x in ids_a], np.int64)
        n_b = np.array([len(x) for x in ids_b], np.int64)
        b = np.fromiter((i for x in ids_b for i in x), np.int64, int(n_b.sum()))
        spelled_a = [self.bytes_a[i] for i in a.tolist()]
        spelled_b = [self.bytes_b[i] for i in b.tolist()]
        whole = b"".join(raw)
        if b"".join(spelled_a) != whole or b"".join(spelled_b) != whole:
            stop_a, stop_b = np.cumsum(n_a).tolist(), np.cumsum(n_b).tolist()
            good = [i for i, x in enumerate(raw)
                    if b"".join(spelled_a[stop_a[i] - len(ids_a[i]) // 4:stop_a[i]]) == x
                    and b"".join(spelled_b[stop_b[i] - len(ids_b[i]):stop_b[i]]) == x]
            found: list[tuple | None] = [None] * len(raw)
            if good:
                for i, x in zip(good, self.align(*([part[i] for i in good] for part in (ids_a, ids_b, raw)))):
                    found[i] = x
            return found
        end_a, end_b = np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])
        bounds = np.union1d(end_a, end_b)
        group_ends = np.intersect1d(end_a, end_b, assume_unique=True)
        pairs = (a[np.searchsorted(end_a, bounds)] << 16 | b[np.searchsorted(end_b, bounds)]).astype("<u4")
        ends = np.cumsum([len(x) for x in raw])
        pair_stops = np.searchsorted(bounds, ends, "right").tolist()
        n_groups = np.diff(np.searchsorted(group_ends, ends, "right"), prepend=0).tolist()
        group_a, group_b = np.searchsorted(group_ends, end_a), np.searchsorted(group_ends, end_b)
        code_a = 2 * a + (group_ends[group_a] == end_a)
        code_b = 2 * (b + len(self.bytes_a)) + (group_ends[group_b] == end_b)
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        written = list(map(self.written.__getitem__, np.concatenate([code_a, code_b])[order].tolist()))
        tokens = np.cumsum(n_a + n_b).tolist()
        packed, out, p, t = pairs.tobytes(), [], 0, 0
        for i, (stop, last) in enumerate(zip(pair_stops, tokens)):
            out.append((packed[4 * p:4 * stop], b"".join(written[t:last]), int(n_a[i]), int(n_b[i]), n_groups[i]))
            p, t = stop, last
        return out

    def _pieces(self, pieces: list[str]) -> list[tuple | None]:
        if len(self.kept) > KEPT_PIECES:
            self.kept, self.older = {}, self.kept
        kept, older = self.kept, self.older
        new = []
        for p in pieces:
            if p not in kept:
                if p in older:
                    kept[p] = older[p]
                else:
                    new.append(p)
        for i in range(0, len(new), 50_000):
            part = new[i:i + 50_000]
            # The mark before a line break is a token of its own, since no token of B has the break.
            ids_b = [x[1:] if p[:1] == "\n" else x for p, x in zip(part, self.b.encode(part, num_threads=1))]
            raw = [(p if p[:1] == "\n" else f" {p}").encode() for p in part]
            kept.update(zip(part, self.align(self.a.ids_of(part), ids_b, raw)))
            self.a.kept, self.a.older = {}, {}  # kept here
        return [kept[p] for p in pieces]

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, list[tuple]]:
        """All pairs of the texts, one after another, and (links, n_a, n_b, n_groups, groups hash) of each.

        texts has no null and no empty text.
        """
        uneven = self.a.uneven(texts)
        odd = texts.filter(pa.array(uneven)).to_pylist()
        whole = iter(self.align(self.a.whole([f" {t}" for t in odd]), [
            self.b.encode(t, num_threads=1) for t in odd], [f" {t}".encode() for t in odd]) if odd else [])
        split = pc.split_pattern(pc.replace_substring(texts.filter(pa.array(~uneven)), "\n", " \n"), " ")
        coded = split.flatten().dictionary_encode()
        known = self._pieces(coded.dictionary.to_pylist())
        bad = np.array([x is None for x in known], bool)
        known = [NO_TOKENS if x is None else x for x in known]
        groups = [x[1] for x in known]
        codes = coded.indices.to_numpy()
        stops = np.r_[0, np.cumsum(pc.list_value_length(split).to_numpy())]
        sums = [np.r_[0, np.cumsum(np.array(column, np.int64)[codes])] for column in (
            [len(x[0]) // 4 for x in known], [x[2] for x in known], [x[3] for x in known],
            [x[4] for x in known], bad)] if len(codes) else [np.zeros(1, np.int64)] * 5
        parts, found, at = [], [], 0
        for u in uneven.tolist():
            if u:
                x = next(whole)
                parts.append(b"" if x is None else x[0])
                found.append((0, 0, 0, 0, "") if x is None else (
                    len(x[0]) // 4, *x[2:], hashlib.sha256(x[1][:-1]).hexdigest()))
                continue
            begin, end = int(stops[at]), int(stops[at + 1])
            at += 1
            links, n_a, n_b, n_groups, wrong = (int(s[end] - s[begin]) for s in sums)
            if wrong:
                found.append((0, 0, 0, 0, ""))
                continue
            part = codes[begin:end].tolist()
            parts.append(b"".join([known[c][0] for c in part]))
            joined = b"".join([groups[c] for c in part])
            found.append((links, n_a, n_b, n_groups, hashlib.sha256(joined[:-1]).hexdigest()))
        return np.frombuffer(b"".join(parts), "<u4"), found


@functools.lru_cache(maxsize=1)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _pack(*columns: np.ndarray, level: int = 1) -> bytes:
    """Columns of one length, or of their own, as a frame; ``_unpack`` needs their types."""
    sizes = np.array([len(c) for c in columns], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=level).compress(sizes + b"".join(c.tobytes() for c in columns))


def _unpack(raw: bytes, *types: str) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(raw)
    at, out = 4 * len(types), []
    for n, kind in zip(np.frombuffer(data, "<u4", len(types)).tolist(), types):
        out.append(np.frombuffer(data, kind, n, at))
        at += out[-1].nbytes
    return out


def _blocks(codes: np.ndarray, counts: np.ndarray, how: Counting) -> Iterator[tuple[int, bytes]]:
    """(first code, block) of sorted codes with their counts."""
    for i in range(0, len(codes), how.block_pairs):
        part = codes[i:i + how.block_pairs]
        yield int(part[0]), _pack(np.diff(part, prepend=np.uint32(0)).astype("<u4"),
                                  counts[i:i + how.block_pairs].astype("<i8"), level=how.level)


def _block(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = _unpack(raw, "<u4", "<i8")
    return np.cumsum(steps, dtype=np.uint32), counts


class Run:
    """Records of one run in the making."""

    def __init__(self, how: Counting):
        self.how, self.name = how, int.from_bytes(os.urandom(8), "little") >> 1
        self.parts, self.records, self.documents = [], 0, 0

    def add(self, pairs: np.ndarray, links: list[int]) -> None:
        """Pairs of some documents, one after another; (pair, document) becomes one record."""
        bits = self.how.radix_bits
        a = pairs >> np.uint32(16)
        radix_first = (a & np.uint32((1 << bits) - 1)) << np.uint32(16 - bits) | a >> np.uint32(bits)
        codes = (radix_first << np.uint32(16) | pairs & np.uint32(0xFFFF)).astype(np.uint64)
        owner = np.repeat(np.arange(self.documents, self.documents + len(links), dtype=np.uint64), links)
        self.documents += len(links)
        keys, counts = np.unique(codes << np.uint64(32) | owner, return_counts=True)
        self.parts.append((keys, counts.astype(np.uint32)))
        self.records += len(keys)

    def rows(self) -> Iterator[tuple]:
        """(radix, first code or None, block or None, body or None)."""
        if not self.records:
            return
        keys = np.concatenate([k for k, _ in self.parts])
        counts = np.concatenate([c for _, c in self.parts])
        self.parts = []
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        codes = (keys >> np.uint64(32)).astype(np.uint32)
        documents = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint16)
        shift = np.uint32(32 - self.how.radix_bits)
        edges = np.searchsorted(codes >> shift, np.arange((1 << self.how.radix_bits) + 1))
        for radix, (begin, end) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            if begin == end:
                continue
            part, docs, links = codes[begin:end], documents[begin:end], counts[begin:end]
            starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            numbers = np.diff(np.r_[starts, len(part)])
            for first, block in _blocks(part[starts], numbers, self.how):
                yield radix, first, block, None
            small = np.minimum(links, 255).astype("u1")
            yield radix, None, None, _pack(
                np.diff(part[starts], prepend=np.uint32(0)).astype("<u4"), numbers.astype("<u4"),
                np.diff(docs, prepend=np.uint16(0)).astype("<u2"), small, links[small == 255].astype("<u4"),
                level=self.how.level)


SPILL = ("doc_id long, place int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
         "run long, documents int, radix int, first long, block binary, body binary")
_SPILL_TYPES = [pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.string(), pa.int64(), pa.int32(), pa.int32(),
                pa.int64(), pa.binary(), pa.binary()]
_SPILL_NAMES = [x.split()[0] for x in SPILL.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), _SPILL_TYPES)], names=_SPILL_NAMES)


def _spill(path_a: str, path_b: str, how: Counting):
    """Rows of documents, of blocks and of bodies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, now = _aligner(path_a, path_b), Run(how)

        def closed() -> Iterator[pa.RecordBatch]:
            for radix, first, block, body in now.rows():
                yield _batch([(None,) * 7 + (now.name, now.documents, radix, first, block, body)])

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            sizes = pc.binary_length(pc.fill_null(texts, "")).to_pylist()
            begin = 0
            while begin < len(ids):
                end, size = begin, 0
                while end < len(ids) and (end == begin or size + sizes[end] <= CHUNK):
                    size += sizes[end]
                    end += 1
                if now.records >= how.run_records or now.documents + end - begin > RUN_DOCUMENTS:
                    yield from closed()
                    now = Run(how)
                part, places = texts.slice(begin, end - begin), range(begin, end)
                full = [i for i in places if sizes[i]]
                pairs, found = aligner.texts(part.filter(pa.array([sizes[i] > 0 for i in places]))) if full else (
                    np.zeros(0, "<u4"), [])
                place, by_row = now.documents, dict(zip(full, found))
                rows = []
                for i in places:
                    links, n_a, n_b, n_groups, digest = by_row.get(i, (0, 0, 0, 0, ""))
                    rows.append((ids[i], place, n_a, n_b, n_groups, links, digest, now.name) + (None,) * 5)
                    place += 1
                now.add(pairs, [by_row[i][0] if i in by_row else 0 for i in places])
                yield _batch(rows)
                begin = end
        yield from closed()

    return run


def _merge(how: Counting, last: bool):
    """Blocks come by (radix, part, first); one row for each block of the merged counts.

    With ``last`` all blocks of an A id are together, and a flag tells its highest counts.
    """
    names = ["radix", "run", "first", "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, heap, ready, waiting, number = None, [], [], 0, 0
        held = (np.zeros(0, np.uint32), np.zeros(0, np.int64))

        def added(bound: int | None) -> None:
            """Moves what lies before the bound from the open blocks to ``ready``."""
            nonlocal heap, waiting
            whole = []
            while heap and (bound is None or heap[0][0] < bound):
                whole.append(heapq.heappop(heap)[2:])
            rest = []
            for stop, order, codes, counts in heap:
                cut = int(np.searchsorted(codes, np.uint32(bound)))
                whole.append((codes[:cut], counts[:cut]))
                rest.append((stop, order, codes[cut:], counts[cut:]))
            heap = rest
            heapq.heapify(heap)
            waiting = sum(len(x[2]) for x in heap)
            codes, counts = (np.concatenate([x[i] for x in whole]) for i in (0, 1)) if whole else held
            if len(codes):
                order = np.argsort(codes, kind="stable")
                codes = codes[order]
                starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
                ready.append((codes[starts], np.add.reduceat(counts[order], starts)))

        def out(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, ready
            codes, counts = (np.concatenate([x[i] for x in (held, *ready)]) for i in (0, 1))
            ready = []
            # The pairs of the last A id may go on.
            cut = len(codes) if final or not len(codes) else int(np.searchsorted(
                codes, codes[-1] & np.uint32(0xFFFF0000)))
            held = codes[cut:], counts[cut:]
            codes, counts = codes[:cut], counts[:cut]
            if last and len(codes):
                starts = np.flatnonzero(np.r_[True, np.diff(codes >> np.uint32(16)) != 0])
                most = np.repeat(np.maximum.reduceat(counts, starts), np.diff(np.r_[starts, len(codes)]))
                counts = counts << 1 | (counts == most)
            for first, block in _blocks(codes, counts, how):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], t) for x, t in zip((*key, first, block), (
                        pa.int32(), pa.int64(), pa.int64(), pa.binary()))], names=names)

        for batch in batches:
            for radix, part, first, raw in zip(*(batch.column(c).to_pylist() for c in (
                    "radix", "part", "first", "block"))):
                if (radix, part) != key:
                    if key is not None:
                        added(None)
                        yield from out(True)
                    key = radix, part
                elif waiting > how.fan_in * how.block_pairs:
                    added(first)
                    yield from out(False)
                codes, counts = _block(raw)
                number += 1
                heapq.heappush(heap, (int(codes[-1]), number, codes, counts))
                waiting += len(codes)
        if key is not None:
            added(None)
            yield from out(True)

    return run


MERGED = "radix int, run long, first long, block binary"


def counts(blocks: DataFrame, runs: int, how: Counting) -> DataFrame:
    """(radix, run, first, block): how many documents hold each pair, doubled, odd for an A id's highest."""
    while True:
        parts = -(-runs // how.fan_in)
        dealt = blocks.select("radix", F.pmod("run", F.lit(max(1, parts))).alias("part"), "first", "block")
        merged = stage(dealt.repartition("radix", "part").sortWithinPartitions(
            "radix", "part", "first").mapInArrow(_merge(how, parts <= 1), MERGED), "counts")
        if parts <= 1:
            return merged
        blocks, runs = merged, parts


def _give_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a radix come first, then bodies, for each of which the sums of its documents go out."""
    key, gathered, codes, numbers = None, [], None, None
    for batch in batches:
        for radix, part, run, documents, block, body in zip(*(batch.column(c).to_pylist() for c in (
                "radix", "slice", "run", "documents", "block", "body"))):
            if (radix, part) != key:
                key, gathered, codes = (radix, part), [], None
            if block is not None:
                gathered.append(_block(block))
                continue
            if codes is None:
                codes, numbers = (np.concatenate([x[i] for x in gathered]) for i in (0, 1))
                gathered = []
            steps, n, docs, links, large = _unpack(body, "<u4", "<u4", "<u2", "u1", "<u4")
            counted = np.repeat(numbers[np.searchsorted(codes, np.cumsum(steps, dtype=np.uint32))], n)
            docs = np.cumsum(docs, dtype=np.uint16)
            links = links.astype(np.int64)
            links[links == 255] = large
            best, total = np.zeros(documents, np.int64), np.zeros(documents, np.int64)
            np.add.at(best, docs, links * (counted & 1))
            np.add.at(total, docs, links * (counted >> 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([run], pa.int64()), pa.array([_pack(best, total)], pa.binary())], names=["run", "sums"])


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a run come one after another; a row for each of its documents."""
    run, best, total = None, None, None

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(best), run, np.int64)), pa.array(np.arange(len(best), dtype=np.int32)),
             pa.array(best), pa.array(total)], names=["run", "place", "n_best", "count_sum"])

    for batch in batches:
        for name, raw in zip(batch.column("run").to_pylist(), batch.column("sums").to_pylist()):
            more_best, more_total = _unpack(raw, "<i8", "<i8")
            if name == run:
                best, total = best + more_best, total + more_total
                continue
            if run is not None:
                yield rows()
            run, best, total = name, more_best, more_total
    if run is not None:
        yield rows()


def align(docs: DataFrame, path_a: str, path_b: str, how: Counting = Counting()) -> tuple[DataFrame, DataFrame]:
    """Figures of every document, and the counts of linked pairs.

    docs has (doc_id, text). The first frame has doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum and groups_sha256; the second a_id, b_id, n_docs, and whether it is a highest
    count of its A id.
    """
    spilled = stage(docs.select("doc_id", "text").mapInArrow(_spill(path_a, path_b, how), SPILL), "pair-runs")
    blocks = spilled.where("block is not null").select("radix", "run", "first", "block")
    runs = spilled.where("body is not null").agg(F.countDistinct("run")).first()[0]
    counted = counts(blocks, runs, how)
    slices = max(1, -(-runs // how.fan_in))
    none = F.lit(None)
    bodies = spilled.where("body is not null").select(
        "radix", F.pmod("run", F.lit(slices)).alias("slice"), "run", "documents", none.cast("long").alias("first"),
        none.cast("binary").alias("block"), "body")
    copies = counted.select(
        "radix", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice"),
        none.cast("long").alias("run"), none.cast("int").alias("documents"), "first", "block",
        none.cast("binary").alias("body"))
    given = bodies.unionByName(copies).repartition("radix", "slice").sortWithinPartitions(
        "radix", "slice", F.col("first").asc_nulls_last()).mapInArrow(_give_back, "run long, sums binary")
    sums = given.repartition("run").sortWithinPartitions("run").mapInArrow(
        _sum_up, "run long, place int, n_best long, count_sum long")
    rows = spilled.where("place is not null").select(
        "doc_id", "run", "place", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    figures = rows.join(sums, ["run", "place"], "left").fillna(0, ["n_best", "count_sum"]).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return figures, counted.mapInArrow(_pairs(how), "a_id int, b_id int, n_docs long, highest boolean")


def _pairs(how: Counting):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = how.radix_bits
        for batch in batches:
            for raw in batch.column("block").to_pylist():
                codes, numbers = _block(raw)
                a = codes >> np.uint32(16)
                a = (a & np.uint32((1 << (16 - bits)) - 1)) << np.uint32(bits) | a >> np.uint32(16 - bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.astype(np.int32)), pa.array((codes & np.uint32(0xFFFF)).astype(np.int32)),
                     pa.array(numbers >> 1), pa.array((numbers & 1).astype(bool))],
                    names=["a_id", "b_id", "n_docs", "highest"])

    return run
