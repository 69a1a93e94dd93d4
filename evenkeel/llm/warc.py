"""Derivatives of WARC responses: metadata and plain-text conversion records.

Each response record gives a ``metadata`` record (status, source headers, digests,
title, links) and a ``conversion`` record (the visible text of the page). Both name
the response in WARC-Refers-To and carry its target and date; their own ids follow
from the response's, so that a rerun makes the same records. Records are handled one
by one, as bytes in a column; files of them hold one gzip member for each record.

Defined results: a null, empty or malformed record, and one of another type, has no
derivatives. A response without payload, or whose payload is no text, converts to an
empty text. Responses that repeat an id give derivatives that repeat theirs. Header
fields that occur several times are all kept, in order.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm.markup import plain_text

VERSION = b"WARC/1.1"
CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)
META_CHARSET = re.compile(rb"<meta[^>]{0,200}?charset\s*=\s*[\"']?([\w.:-]+)", re.I)
Headers = list[tuple[str, str]]


def digest(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def _head(lines: bytes) -> Headers:
    """Header fields; a line that starts with a blank goes on with the field before."""
    found: Headers = []
    for line in lines.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and found:
            found[-1] = (found[-1][0], f"{found[-1][1]} {line.strip()}")
        elif ":" in line:
            name, value = line.split(":", 1)
            found.append((name.strip(), value.strip()))
    return found


def get(headers: Headers, name: str) -> str | None:
    return next((v for k, v in headers if k.lower() == name.lower()), None)


def read_record(raw: bytes | None) -> tuple[Headers, bytes] | None:
    """Header fields and block of a record, or None if it is none."""
    if not raw or not raw.startswith(b"WARC/"):
        return None
    head, gap, block = raw.partition(b"\r\n\r\n")
    headers = _head(head.partition(b"\r\n")[2])
    length = get(headers, "Content-Length")
    if not gap or not length or not length.isdigit() or len(block) < int(length):
        return None
    return headers, block[:int(length)]


def write_record(headers: Headers, block: bytes) -> bytes:
    # A line break within a value would start another field.
    fields = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in headers)
    return b"".join([VERSION, b"\r\n", fields.encode("utf-8", "replace"),
                     f"Content-Length: {len(block)}\r\n\r\n".encode(), block, b"\r\n\r\n"])


def _unchunked(body: bytes) -> bytes:
    parts, at = [], 0
    while (stop := body.find(b"\r\n", at)) >= 0:
        try:
            size = int(body[at:stop].split(b";")[0], 16)
        except ValueError:
            return body
        if not size:
            break
        parts.append(body[stop + 2:stop + 2 + size])
        at = stop + 4 + size
    return b"".join(parts)


def http(block: bytes) -> tuple[str, Headers, bytes]:
    """Status line, header fields and payload of a response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    status, _, fields = head.partition(b"\r\n")
    headers = _head(fields)
    payload = body
    if "chunked" in (get(headers, "Transfer-Encoding") or "").lower():
        payload = _unchunked(payload)
    try:
        coding = (get(headers, "Content-Encoding") or "").lower()
        if coding in ("gzip", "x-gzip"):
            payload = gzip.decompress(payload)
        elif coding == "deflate":
            payload = zlib.decompress(payload)
    except (OSError, EOFError, zlib.error):
        payload = b""  # not what the header says
    return status.decode("latin-1"), headers, payload


def text_of(headers: Headers, payload: bytes):
    """(page, text) of a payload that is text, in the character set it names."""
    kind = get(headers, "Content-Type") or "text/html"
    if not any(x in kind.lower() for x in ("text/", "html", "xml")):
        return plain_text(None)
    named = CHARSET.search(kind)
    found = META_CHARSET.search(payload, 0, 4096)
    charset = named[1] if named else found[1].decode() if found else "utf-8"
    try:
        source = payload.decode(charset, "replace")
    except LookupError:
        source = payload.decode("utf-8", "replace")
    if "plain" in kind.lower():
        page = plain_text(None)[0]
        return page, "\n".join(line for x in source.splitlines() if (line := " ".join(x.split())))
    return plain_text(source)


def derivatives(raw: bytes | None) -> list[tuple]:
    """(type, headers, block) of the records that a response record gives."""
    record = read_record(raw)
    if record is None or (get(record[0], "WARC-Type") or "").lower() != "response":
        return []
    headers, block = record
    source = get(headers, "WARC-Record-ID")
    if not source:
        return []
    status, fields, payload = http(block)
    page, text = text_of(fields, payload)
    linked = [("WARC-Refers-To", source)]
    for name, to in (("WARC-Target-URI", "WARC-Target-URI"), ("WARC-Date", "WARC-Date"),
                     ("WARC-Target-URI", "WARC-Refers-To-Target-URI"),
                     ("WARC-Date", "WARC-Refers-To-Date")):
        if (value := get(headers, name)) is not None:
            linked.append((to, value))
    body = text.encode("utf-8", "replace")
    facts = [("http-status", status)]
    facts += [(f"http-header-{k.lower()}", v) for k, v in fields]
    facts += [(f"source-{k.lower()}", v) for k, v in headers]
    facts += [("source-block-sha1", digest(block)), ("source-payload-sha1", digest(payload)),
              ("title", page.title), ("links", str(page.links)), ("text-characters", str(len(text))),
              ("text-digest", digest(body))]
    meta = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in facts).encode("utf-8", "replace")
    found = []
    for kind, content, raw_block in (("metadata", "application/warc-fields", meta),
                                     ("conversion", "text/plain; charset=utf-8", body)):
        own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source} {kind}')}>"
        found.append((kind, [("WARC-Type", kind), ("WARC-Record-ID", own), *linked,
                             ("Content-Type", content), ("WARC-Block-Digest", digest(raw_block))],
                      raw_block))
    return found


def _rows(names: list[str], types: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """(page_id, url, record): response records for pages (page_id, url, html).

    For tables that hold pages instead of an archive; all get one date.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in (
                    "page_id", "url", "html"))):
                payload = (html or "").encode("utf-8", "surrogatepass")
                block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                         f"Content-Length: {len(payload)}\r\n\r\n").encode() + payload
                own = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {url} {digest(payload)}")
                headers = [("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:uuid:{own}>"),
                           ("WARC-Date", date), ("WARC-Payload-Digest", digest(payload)),
                           ("WARC-Block-Digest", digest(block)),
                           ("Content-Type", "application/http; msgtype=response")]
                if url is not None:
                    headers.insert(2, ("WARC-Target-URI", url))
                out.append((page_id, url, write_record(headers, block)))
            if out:
                yield _rows(["page_id", "url", "record"],
                            [pa.int64(), pa.string(), pa.binary()], out)

    return pages.select("page_id", "url", "html").mapInArrow(
        run, "page_id long, url string, record binary")


DERIVED = ("page_id long, type string, record_id string, refers_to string, target_uri string, "
           "date string, block_digest string, content_length long, n_chars long, record binary")


def derive(records: DataFrame) -> DataFrame:
    """The derivatives of records (page_id, record), with what their headers say."""
    names = [x.split()[0] for x in DERIVED.split(", ")]
    types = [pa.int64(), *[pa.string()] * 6, pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, raw in zip(batch.column("page_id").to_pylist(), batch.column("record")):
                for kind, headers, block in derivatives(raw.as_py()):
                    out.append((
                        page_id, kind, *(get(headers, f"WARC-{x}") for x in (
                            "Record-ID", "Refers-To", "Target-URI", "Date", "Block-Digest")),
                        len(block), len(block.decode("utf-8")), write_record(headers, block)))
            for i in range(0, len(out), 512):
                yield _rows(names, types, out[i:i + 512])

    return records.select("page_id", "record").mapInArrow(run, DERIVED)


FILES = "file string, records long"
FILE_BYTES = 256 << 20  # a file is read whole by one task


def members(content: memoryview, step: int = 1 << 14) -> Iterator[bytes]:
    """The gzip members of a file; ``step`` bytes at a time, so that none is read over and over.

    A member that the end of the file cuts off is an error.
    """
    at = 0
    while at < len(content):
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            piece = content[at:at + step]
            if not piece:
                raise EOFError("the file ends within a member")
            parts.append(member.decompress(piece))
            at += len(piece) - len(member.unused_data)
        yield b"".join(parts)


def write(derived: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes records (record) as files of gzip members; the manifest (file, records).

    The folder is one that all executors reach. A task writes under the name of its
    attempt, beginning another file once one has ``file_bytes``; the manifest names the
    files of the attempts that counted.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = fs.FileSystem.from_uri(f"{folder}/files")
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        out, done, count, size = None, [], 0, 0
        for batch in batches:
            for raw in batch.column("record"):
                if out is None:
                    target.create_dir(root, recursive=True)
                    file = f"{name}-{len(done):04d}.warc.gz"
                    out = target.open_output_stream(f"{root}/{file}", compression=None)
                member = gzip.compress(raw.as_py(), 6, mtime=0)
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= file_bytes:
                    out.close()
                    done.append((file, count))
                    out, count, size = None, 0, 0
        if out is not None:
            out.close()
            done.append((file, count))
        if done:
            yield _rows(["file", "records"], [pa.string(), pa.int64()], done)

    derived.where("record is not null").select("record").mapInArrow(run, FILES).write.parquet(
        f"{folder}/manifest")
    return derived.sparkSession.read.schema(FILES).parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(file, record) of the files that the manifest names."""
    manifest = spark.read.schema(FILES).parquet(f"{folder}/manifest")
    if manifest.isEmpty():
        return spark.createDataFrame([], "file string, record binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content")):
                found = members(memoryview(content.as_buffer()))
                while out := [(file, record) for record in islice(found, 256)]:
                    yield _rows(["file", "record"], [pa.string(), pa.binary()], out)

    content = spark.read.format("binaryFile").load(f"{folder}/files").select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return content.join(F.broadcast(manifest.select("file")), "file", "left_semi").mapInArrow(
        run, "file string, record binary")
