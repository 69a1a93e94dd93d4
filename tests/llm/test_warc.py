import gzip
import random
import time
import uuid

import pytest

from evenkeel.llm import warc
from evenkeel.llm.common import table
from evenkeel.session import shared_folder


def response(block, *, kind="response", record_id="<urn:uuid:1>", extra=()):
    return warc.write_record([("WARC-Type", kind), ("WARC-Record-ID", record_id),
                              ("WARC-Target-URI", "http://x.example/"), ("WARC-Date", "2020-01-01T00:00:00Z"),
                              *extra], block)


def http(body, *fields):
    return ("HTTP/1.1 200 OK\r\n" + "".join(f"{f}\r\n" for f in fields) + "\r\n").encode() + body


def test_links_headers_and_digests():
    body = "<title>T &amp; x</title><p>Grüße</p><a href=/>l</a>".encode("latin-1")
    block = http(body, "Content-Type: text/html; charset=latin-1", "X-A: 1", "X-A: 2")
    (m, mh, mb), (c, ch, cb) = warc.derivatives(response(block))
    assert (m, c) == ("metadata", "conversion")
    for headers, raw in ((mh, mb), (ch, cb)):
        assert warc.get(headers, "WARC-Refers-To") == "<urn:uuid:1>"
        assert warc.get(headers, "WARC-Target-URI") == "http://x.example/"
        assert warc.get(headers, "WARC-Block-Digest") == warc.digest(raw)
        assert warc.read_record(warc.write_record(headers, raw))[1] == raw
    assert cb.decode() == "Grüße\nl"
    lines = mb.decode().split("\r\n")
    assert "http-header-x-a: 1" in lines and "http-header-x-a: 2" in lines and "title: T & x" in lines
    assert f"source-payload-sha1: {warc.digest(body)}" in lines and "links: 1" in lines
    assert warc.get(mh, "WARC-Record-ID") != warc.get(ch, "WARC-Record-ID")
    assert warc.derivatives(response(block)) == warc.derivatives(response(block))


def test_codings():
    page = b"<p>hello there</p>"
    for block in (http(gzip.compress(page), "Content-Encoding: gzip"),
                  http(b"5\r\n<p>he\r\nd;x=1\r\nllo there</p>\r\n0\r\n\r\n", "Transfer-Encoding: chunked")):
        assert warc.derivatives(response(block))[1][2] == b"hello there"
    assert warc.derivatives(response(http(b"no gzip", "Content-Encoding: gzip")))[1][2] == b""
    assert warc.derivatives(response(http(b"\x89PNG", "Content-Type: image/png")))[1][2] == b""
    assert warc.derivatives(response(http(b"a  b\r\n\r\n c", "Content-Type: text/plain")))[1][2] == b"a b\nc"
    assert warc.derivatives(response(http(page, "Content-Type: text/html; charset=nosuch")))[1][2] == b"hello there"


def test_what_is_no_response():
    good = response(http(b"x"))
    for raw in (None, b"", b"junk", good[:-20], response(http(b"x"), kind="request"),
                warc.write_record([("WARC-Type", "response")], b""),
                good.replace(b"Content-Length: ", b"Content-Length: x")):
        assert warc.derivatives(raw) == []
    assert len(warc.derivatives(response(b""))) == 2
    folded = good.replace(b"WARC-Date: ", b"X-Long: a\r\n  b\r\nWARC-Date: ")
    assert "source-x-long: a b" in warc.derivatives(folded)[0][2].decode()


def test_pages_round_trip_through_files(spark):
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    derived = warc.derive(warc.responses(pages))
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    manifest = warc.write(derived, folder)
    assert manifest.agg({"records": "sum"}).first()[0] == 2 * pages.count()
    got = sorted(bytes(r["record"]) for r in warc.read(spark, folder).collect())
    assert got == sorted(bytes(r["record"]) for r in derived.collect())
    rows = derived.drop("record").collect()
    responses = {warc.get(warc.read_record(bytes(r["record"]))[0], "WARC-Record-ID")
                 for r in warc.responses(pages).collect()}
    assert {r["refers_to"] for r in rows} == responses and len(responses) == pages.count()


def test_awkward_rows(spark):
    df = spark.createDataFrame(
        [(1, None, None, "own"), (1, "u", "", "own"), (None, "u\r\nInjected: 1", "<p>x</p>", "own"),
         (2, "u", "<p>" + "long " * 300_000, "own"), (2, "u", "<p>" + "long " * 300_000, "own")],
        "page_id long, url string, html string, record string")
    rows = warc.derive(warc.responses(df)).collect()
    assert len(rows) == 10
    assert all(b"\r\nInjected" not in bytes(r["record"]).split(b"\r\n\r\n")[0] for r in rows)
    assert sorted(r["n_chars"] for r in rows if r["type"] == "conversion") == [0, 0, 1, 1_499_999, 1_499_999]
    empty = warc.derive(warc.responses(df.limit(0)))
    assert empty.count() == 0
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    assert warc.write(empty, folder).count() == 0 and warc.read(spark, folder).count() == 0


def test_members_are_read_once_and_files_roll(spark):
    draw = random.Random(4)
    records = [draw.randbytes(draw.choice((0, 1, 20, 2_000, 50_000))) for _ in range(300)]
    content = b"".join(gzip.compress(r) for r in records)
    for step in (97, 1 << 14, len(content)):
        assert list(warc.members(memoryview(content), step)) == records
    assert list(warc.members(memoryview(b""))) == []
    with pytest.raises(EOFError):
        list(warc.members(memoryview(content[:-1])))
    many = memoryview(b"".join(gzip.compress(draw.randbytes(2_000)) for _ in range(16_000)))
    begin = time.process_time()
    assert sum(1 for _ in warc.members(many)) == 16_000
    assert time.process_time() - begin < 5
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    df = spark.createDataFrame([(bytearray(r),) for r in records], "record binary").coalesce(1)
    manifest = warc.write(df, folder, file_bytes=100_000)
    assert manifest.count() > 10 and manifest.agg({"records": "sum"}).first()[0] == len(records)
    assert sorted(bytes(r["record"]) for r in warc.read(spark, folder).collect()) == sorted(records)
