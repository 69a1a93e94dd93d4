"""Token ids in files of independent zstandard frames with a seek table.

A file holds whole documents in ascending doc_id. Their ids, little-endian unsigned
32-bit, fill data frames that end between documents; a frame of their index follows,
and a skippable frame with the seek table (compressed size, size and checksum of each
frame) ends the file, as the public seekable zstandard format lays it down. A reader
takes the tail, the index, and then only the frames of the documents it wants.

Tasks write files under names of their own attempt and report them; the manifest
lists the files of the attempts that counted, and only those are read. A lost
executor leaves at most files that no manifest names.

Defined results: a null or empty text is a document of the end id alone; null ids
come first; rows that repeat an id are documents of their own, in the order of their
texts' digests; an empty table gives no files and no rows.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import string
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

# Fixed values of the seekable zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
ENTRY = struct.Struct("<III")   # compressed size, size, low half of the XXH64
FOOTER = struct.Struct("<IBI")  # frames, flags, magic

def _numbers(ids: list[int]) -> array:
    """Ids as little-endian unsigned 32-bit numbers."""
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers


INDEX_HEAD = struct.Struct("<QI")  # documents, data frames
SUFFIX = ".tok.zst"
CHUNK = 3 << 20  # bytes of text encoded at once, or one document


@dataclass(frozen=True)
class Layout:
    end_id: int = 0
    frame_bytes: int = 1 << 18   # a frame is closed by the document that reaches this
    file_bytes: int = 1 << 27    # and a file by the frame that reaches this
    level: int = 1


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the pieces of a byte-level tokenizer."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Token ids of many texts, with those of pieces of text kept for reuse.

    The pre-tokenizer always cuts before a space or a line break that no white space
    surrounds, and between a letter and the signs that end a piece. So a text is the
    sequence of its pieces, and every distinct piece is encoded once; texts with other
    white space around these are encoded as a whole, and so are texts that hold the string
    of an added token, unless ``plain`` makes it ordinary text. A piece of letters is not
    cut at all, so it goes to the model as it is.
    """

    KEPT = 500_000   # pieces in a generation; the two last generations are kept
    GROUP = 500      # pieces encoded as lines of one text
    SPACE = r"[\s\p{Z}\x{85}\x{0B}\x{1C}-\x{1F}]"
    UNEVEN = rf"\A{SPACE}|[ \n](?:{SPACE}|\z)"
    SIGNS = string.punctuation
    LETTERS_TO = "\u0530"  # scripts below have the same letters in all versions of Unicode in use
    BYTES = _byte_letters()

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [] if plain else [t.content for t in added]
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        cut = stated["pre_tokenizer"] or {}
        # What only cuts by the usual pattern, and leaves the rest to the merges.
        self.direct = (
            stated["normalizer"] is None and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
            and stated["model"].get("type") == "BPE" and all(t.special for t in added))
        self.model = self.tokenizer.model
        self.packed = [struct.pack("<I", i) for i in range(self.tokenizer.get_vocab_size())]
        self.line, = self.whole(["\n"])
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [_numbers(e.ids).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _lines(self, items: list[str]) -> list[bytes]:
        """Ids of items without white space, but for a first space, by way of joined lines."""
        found, width = [], len(self.line)
        for i in range(0, len(items), self.GROUP):
            part = items[i:i + self.GROUP]
            raw, = self.whole(["\n".join(part)])
            cuts = (4 * np.flatnonzero(np.frombuffer(raw, "<u4") == np.frombuffer(self.line, "<u4")[0])).tolist()
            if width != 4 or len(cuts) != len(part) - 1:
                found += self.whole(part)
            else:
                found += [raw[a:b] for a, b in zip([0, *(c + 4 for c in cuts)], [*cuts, len(raw)])]
        return found

    def _word(self, bare: str, spaced: bool) -> bytes | None:
        """Ids of letters, which the pre-tokenizer does not cut, after a space or without one."""
        if not bare.isalpha():
            return None
        if not bare.isascii():
            if max(bare) >= self.LETTERS_TO:
                return None
            bare = bare.encode().decode("latin-1").translate(self.BYTES)
        return b"".join([self.packed[t.id] for t in self.model.tokenize("\u0120" + bare if spaced else bare)])

    def _cut(self, piece: str) -> str:
        """A piece without the signs after its last letter, if there are any."""
        body = piece.rstrip(self.SIGNS)
        return body if body[-1:].isalpha() else piece

    def _learn(self, bodies: list[str]) -> None:
        """Puts the ids of pieces that are not kept among those kept."""
        kept, older, line = self.kept, self.older, self.line
        lines, odd = [], []
        for body in bodies:
            if body in kept:
                continue
            if (ids := older.get(body)) is not None:
                kept[body] = ids
                continue
            first = body[:1] == "\n"
            bare = body[1:] if first else body
            if self.direct and (ids := self._word(bare, not first)) is not None:
                kept[body] = line + ids if first else ids
                continue
            kept[body] = b""  # so that it is taken up once
            (lines if bare and bare.split() == [bare] else odd).append(body)
        items = [b[1:] if b[:1] == "\n" else f" {b}" for b in lines]
        for body, ids in zip(lines, self._lines(items)):
            kept[body] = line + ids if body[:1] == "\n" else ids
        for body, ids in zip(odd, self.whole([b if b[:1] == "\n" else f" {b}" for b in odd])):
            kept[body] = ids

    def _tail(self, tail: str) -> bytes:
        """Ids of signs behind a letter."""
        if (ids := self.tails.get(tail)) is None:
            ids, = self.whole([tail])
            if len(tail) < 8:  # 32 signs, and few of their sequences occur
                if len(self.tails) >= self.KEPT:
                    self.tails.clear()
                self.tails[tail] = ids
        return ids

    def ids_of(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces: those between the spaces of a text, with a space before each
        line break, of which none is empty. A piece stands after a space or begins with a line break."""
        if len(self.kept) > self.KEPT:
            self.kept, self.older = {}, self.kept
        kept = self.kept
        known = list(map(kept.get, pieces))
        new = [i for i, ids in enumerate(known) if ids is None]
        bodies = [self._cut(pieces[i]) for i in new]
        self._learn(bodies)
        for i, body in zip(new, bodies):
            piece = pieces[i]
            ids = kept[body]
            if len(body) < len(piece):
                ids = kept[piece] = ids + self._tail(piece[len(body):])
            known[i] = ids
        return known

    def uneven(self, texts: pa.Array) -> np.ndarray:
        """Which texts are to be encoded as a whole."""
        found = pc.match_substring_regex(texts, self.UNEVEN)
        for added in self.added:
            found = pc.or_(found, pc.match_substring(texts, added))
        return found.to_numpy(zero_copy_only=False)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as bytes; texts has no null."""
        uneven = self.uneven(texts)
        even = texts.filter(pa.array(~uneven))
        whole = iter(self.whole(texts.filter(pa.array(uneven)).to_pylist()))
        # Each text begins a line of its own, whose break is dropped in the end.
        split = pc.split_pattern(pc.binary_join_element_wise(
            pa.scalar("\n"), pc.replace_substring(even, "\n", " \n"), ""), " ")
        coded = split.flatten().dictionary_encode()
        known = self.ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, known), np.int32, len(known)) // 4
        flat = np.frombuffer(b"".join(known), "<u4")
        starts = np.cumsum(sizes, dtype=np.int32) - sizes  # a text has fewer than 2**31 ids
        codes = coded.indices.to_numpy()
        lengths = sizes[codes]
        ends = np.cumsum(lengths, dtype=np.int32)
        at = np.repeat(starts[codes] - ends + lengths, lengths)
        at += np.arange(len(at), dtype=np.int32)
        ids = flat.take(at)
        last = np.cumsum(pc.list_value_length(split).to_numpy())
        stops = ends[last - 1] if len(last) else ends
        begins = np.concatenate([[0], stops[:-1]]) + len(self.line) // 4
        parts = iter([ids[a:b].tobytes() for a, b in zip(begins.tolist(), stops.tolist())])
        return [next(whole) if u else next(parts) for u in uneven]


@functools.lru_cache(maxsize=1)
def encoder_of(path: str, plain: bool = False) -> Encoder:
    """One encoder for all tasks of a worker, so that what it has learned lasts."""
    return Encoder(path, plain)


class FileWriter:
    """One file in the making; frames are compressed as they fill."""

    def __init__(self, out, layout: Layout):
        self.out, self.layout = out, layout
        self.packer = zstandard.ZstdCompressor(level=layout.level, write_checksum=True)
        self.entries, self.per_frame = [], []
        self.ids, self.sizes = [], []
        self.pending, self.pending_bytes, self.in_frame, self.total = [], 0, 0, 0

    def _frame(self, raw: bytes) -> None:
        packed = self.packer.compress(raw)
        self.out.write(packed)
        self.entries.append(ENTRY.pack(
            len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def _close_frame(self) -> None:
        if self.in_frame:
            self._frame(b"".join(self.pending))
            self.per_frame.append(self.in_frame)
            self.pending, self.pending_bytes, self.in_frame = [], 0, 0

    def add(self, doc_id: int | None, raw: bytes) -> None:
        self.ids.append(doc_id)
        self.sizes.append(len(raw) // 4)
        self.pending.append(raw)
        self.pending_bytes += len(raw)
        self.in_frame += 1
        self.total += len(raw)
        if self.pending_bytes >= self.layout.frame_bytes:
            self._close_frame()

    def close(self) -> None:
        self._close_frame()
        named = np.array([i is not None for i in self.ids], np.uint8)
        self._frame(b"".join([
            INDEX_HEAD.pack(len(self.ids), len(self.per_frame)),
            np.array(self.per_frame, "<u4").tobytes(), named.tobytes(),
            np.array([i or 0 for i in self.ids], "<i8").tobytes(),
            np.array(self.sizes, "<u8").tobytes()]))
        table = b"".join(self.entries) + FOOTER.pack(
            len(self.entries), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()


class FileReader:
    """Random access to a file that can seek and read."""

    def __init__(self, source):
        self.source = source
        source.seek(0, 2)
        size = source.tell()
        source.seek(size - FOOTER.size)
        frames, flags, magic = FOOTER.unpack(source.read(FOOTER.size))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        source.seek(size - FOOTER.size - ENTRY.size * frames)
        self.entries = list(ENTRY.iter_unpack(source.read(ENTRY.size * frames)))
        self.offsets = np.concatenate([[0], np.cumsum([e[0] for e in self.entries])])
        raw = self.frame(frames - 1)
        docs, data_frames = INDEX_HEAD.unpack_from(raw)
        at = INDEX_HEAD.size
        per_frame = np.frombuffer(raw, "<u4", data_frames, at)
        at += 4 * data_frames
        named = np.frombuffer(raw, np.uint8, docs, at).astype(bool)
        ids = np.frombuffer(raw, "<i8", docs, at + docs)
        self.sizes = np.frombuffer(raw, "<u8", docs, at + 9 * docs).astype(np.int64)
        self.ids = [int(i) if n else None for i, n in zip(ids, named)]
        self.home = np.repeat(np.arange(data_frames), per_frame)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1].astype(np.int64)

    def frame(self, number: int) -> bytes:
        packed, size, checksum = self.entries[number]
        self.source.seek(int(self.offsets[number]))
        raw = zstandard.ZstdDecompressor().decompress(self.source.read(packed), max_output_size=size)
        if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {number} is damaged")
        return raw

    def documents(self, wanted: set | None = None) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc_id, tokens before it in the file, ids as bytes), from the frames needed only."""
        held, raw, first = -1, b"", 0
        for i, doc_id in enumerate(self.ids):
            if wanted is not None and doc_id not in wanted:
                continue
            if self.home[i] != held:
                held = int(self.home[i])
                raw = self.frame(held)
                first = int(self.starts[np.searchsorted(self.home, held)])
            begin = 4 * (int(self.starts[i]) - first)
            yield doc_id, int(self.starts[i]), raw[begin:begin + 4 * int(self.sizes[i])]


MANIFEST = "part int, number int, file string, n_docs bigint, n_tokens bigint"


def _write_task(folder: str, tokenizer_path: str, layout: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        target, root = fs.FileSystem.from_uri(folder)
        encoder, end = encoder_of(tokenizer_path), struct.pack("<I", layout.end_id)
        done, writer, name = [], None, None

        def close():
            writer.close()
            done.append((part, len(done), name, len(writer.ids), writer.total // 4))

        for batch in batches:
            texts = batch.column("text").fill_null("")
            sizes = np.cumsum(pc.binary_length(texts).to_numpy())
            cuts = np.flatnonzero(np.diff(sizes // CHUNK)) + 1
            for i, j in zip([0, *cuts], [*cuts, len(texts)]):
                ids = batch.column("doc_id")[i:j].to_pylist()
                for doc_id, raw in zip(ids, encoder.encode(texts[i:j])):
                    if writer is None:
                        name = f"part-{part:06d}-{len(done):04d}-{attempt}{SUFFIX}"
                        target.create_dir(root, recursive=True)
                        writer = FileWriter(target.open_output_stream(
                            f"{root}/{name}", compression=None), layout)
                    writer.add(doc_id, raw + end)
                    if writer.total >= layout.file_bytes:
                        close()
                        writer = None
            pa.default_memory_pool().release_unused()
        if writer is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done), (
                    pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                names=["part", "number", "file", "n_docs", "n_tokens"])

    return run


def write(docs: DataFrame, folder: str, tokenizer_path: str, layout: Layout = Layout()) -> DataFrame:
    """Writes docs (doc_id, text) below the folder; the manifest, which is stored there too.

    The folder is one that all executors reach, as a path or URI.
    """
    spark = docs.sparkSession
    ordered = docs.select("doc_id", "text", F.xxhash64("text").alias("_digest")).repartitionByRange(
        "doc_id", "_digest").sortWithinPartitions("doc_id", "_digest").select("doc_id", "text")
    manifest = ordered.mapInArrow(_write_task(f"{folder}/files", tokenizer_path, layout), MANIFEST)
    # Files are few: one for each task and 128 MB. Their starts are running totals.
    manifest.write.parquet(f"{folder}/written")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    spark.read.schema(MANIFEST).parquet(f"{folder}/written").withColumn(
        "start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long"))
    ).write.parquet(f"{folder}/manifest")
    return manifest_of(spark, folder)


def manifest_of(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{MANIFEST}, start bigint").parquet(f"{folder}/manifest")


TOKENS = "file string, doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint, ids binary"


def _decode(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in TOKENS.split(", ")]
        for batch in batches:
            for file, content in zip(batch.column("file"), batch.column("content")):
                rows = FileReader(pa.BufferReader(content.as_buffer())).documents()
                while part := list(itertools.islice(rows, 512)):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([file.as_py()] * len(part), pa.string()),
                        pa.array([x[0] for x in part], pa.int64()),
                        pa.array([x[1] for x in part], pa.int64()),
                        pa.array([len(x[2]) // 4 for x in part], pa.int64()),
                        pa.array([zlib.crc32(x[2]) for x in part], pa.int64()),
                        pa.array([x[2] if with_ids else None for x in part], pa.binary())],
                        names=names)

    return run


def read(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document in the files.

    ids holds little-endian unsigned 32-bit numbers; it is null without ``with_ids``.
    """
    manifest = manifest_of(spark, folder).select("file", F.col("start").alias("_start"))
    if manifest.isEmpty():
        content = spark.createDataFrame([], "file string, content binary")
    else:
        content = spark.read.format("binaryFile").load(f"{folder}/files").select(
            F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    # Attempts that did not count are in no manifest; their content is never decoded.
    rows = content.join(F.broadcast(manifest.select("file")), "file", "left_semi").mapInArrow(
        _decode(with_ids), TOKENS)
    return rows.join(F.broadcast(manifest), "file").select(
        "doc_id", (F.col("_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "ids")


def read_documents(folder: str, files: list[str], wanted: set[int]) -> dict[int, np.ndarray]:
    """The ids of some documents, reading only the frames that hold them."""
    source, root = fs.FileSystem.from_uri(folder)
    found = {}
    for name in files:
        with source.open_input_file(f"{root}/files/{name}") as file:
            for doc_id, _, raw in FileReader(file).documents(wanted):
                found[doc_id] = np.frombuffer(raw, "<u4")
    return found
