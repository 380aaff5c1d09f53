"""Operator 9: round trips, revisits, real files, and broken archives."""

import base64
import hashlib
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from lexiflow.llm import warc_zstd as W
from lexiflow.llm.queries import op9_warc_zstd
from tests.conftest import SF_SMALL

LONG = "<p>" + "é" * 60 + "</p>"


def plain(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        f = first.get(h or "")
        again = len(data) >= 100 and f is not None and (i is None or i > f)
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


def fields(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


ROWS = [
    (5, "http://a/1", LONG), (3, "http://a/2", LONG), (9, "http://a/3", LONG), (4, None, None), (6, "u", ""), (7, "bad\r\nurl: x", "short"),
    (8, "u", "short"), (10, "u", "x" * 200000), (10, "u", "x" * 200000), (11, "u", "x" * 200000), (None, "n", LONG), (12, "u", "\r\n\r\nWARC/1.1\r\n" + LONG),
]


def test_round_trip_with_revisits(spark):
    pages = spark.createDataFrame([(*r, "e", 1) for r in ROWS], "page_id long, url string, html string, digest string, revisit int")
    got = W.round_trip(spark, pages)
    assert fields(got) == plain(ROWS)
    for r in got.collect():
        assert r.problem is None and (r.payload is None) == (r.record_type == "revisit")
        if r.record_type == "response":
            assert hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest
    assert W.round_trip(spark, pages.limit(0)).count() == 0


def test_real_files_with_and_without_dictionary(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "ARCHIVE_BYTES", 2000)
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    trained = W.train_dictionary(pages)
    assert trained
    for name, dictionary in (("a", trained), ("b", b"")):
        folder = tmp_path / name
        folder.mkdir()
        archives = W.write_archives(W.plan_records(pages), dictionary).collect()
        assert len(archives) > 1
        for r in archives:
            assert bytes(r.content)[:4] == b"\x5d\x2a\x4d\x18" and r.length == len(r.content)
            (folder / r.path).write_bytes(bytes(r.content))
        files = spark.read.format("binaryFile").load(str(folder))
        rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
        assert fields(W.read_archives(files)) == plain(rows)


def test_each_record_is_a_frame_and_dictionary_may_be_compressed():
    records = [W.record(i, "http://x", b"payload %d" % i, hashlib.sha256(b"payload %d" % i).hexdigest(), None, False) for i in range(3)]
    words = [b"some words of page %d " % i * 20 for i in range(500)]
    trained = zstandard.train_dictionary(2000, words)
    coder = zstandard.ZstdCompressor(dict_data=trained)
    packed = zstandard.ZstdCompressor().compress(trained.as_bytes())
    for lead in (trained.as_bytes(), packed):
        content = W.dictionary_frame(lead) + b"".join(map(coder.compress, records))
        assert [r for _, r in W.frames(content)] == records


@pytest.mark.parametrize("old,new", [(b"WARC/1.1", b"WARC/9.9"), (b"Content-Length: 7", b"Content-Length: 8"), (b"payload", b"paYload"), (b"WARC-Date: ", b"X-Date: "), (b"\r\n\r\npay", b"\r\n\r\npayy")])
def test_broken_records_are_told(old, new):
    data = W.record(1, "http://x", b"payload", hashlib.sha256(b"payload").hexdigest(), None, False)
    assert W.parse_record(data)["payload"] == b"payload"
    with pytest.raises(ValueError):
        W.parse_record(data.replace(old, new))


def test_broken_archives(spark):
    good = zstandard.ZstdCompressor().compress(W.record(1, "u", b"p", hashlib.sha256(b"p").hexdigest(), None, False))
    bad = zstandard.ZstdCompressor().compress(b"no record")
    rows = [("cut", good + good[:-3]), ("bad", good + bad + good), ("dict", W.dictionary_frame(b"x" * 50)[:20]), ("empty", b"")]
    df = spark.createDataFrame(rows, "path string, content binary")
    got = {(r.path, r.problem is None): r["count"] for r in W.read_archives(df, strict=False).groupBy("path", "problem").count().collect()}
    assert got == {("cut", True): 1, ("cut", False): 1, ("bad", True): 2, ("bad", False): 1, ("dict", False): 1}
    with pytest.raises(Exception, match="cut off"):
        W.read_archives(df.where(F.col("path") == "cut")).collect()


def made(kind, block, *headers):
    head = [b"WARC/1.0", b"WARC-Type: " + kind, b"WARC-Record-ID: <urn:x:%d>" % len(block), b"WARC-Date: 2020-01-01T00:00:00Z", *headers, b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


BODY = "<p>été</p>".encode()
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n"
CHUNKED = b"4;x=y\r\n" + BODY[:4] + b"\r\n%x\r\n" % len(BODY[4:]) + BODY[4:] + b"\r\n0\r\n\r\n"
SHA1 = b"sha1:" + base64.b32encode(hashlib.sha1(BODY).digest())
FOREIGN = [
    ("warcinfo", made(b"warcinfo", b"software: some writer\r\n", b"Content-Type: application/warc-fields"), b"software: some writer\r\n"),
    ("request", made(b"request", b"GET / HTTP/1.1\r\nHost: x\r\n\r\n", b"WARC-Concurrent-To: <urn:a>", b"WARC-Concurrent-To: <urn:b>", b"Content-Type: application/http; msgtype=request"), b""),
    ("response", made(b"response", HTTP + b"\r\n" + BODY, b"WARC-Target-URI: http://x/", b"WARC-Payload-Digest: " + SHA1, b"Content-Type: application/http;\r\n msgtype=response"), BODY),
    ("response", made(b"response", HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + CHUNKED, b"WARC-Payload-Digest: " + SHA1), BODY),
    ("response", made(b"response", HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + CHUNKED, b"WARC-Payload-Digest: md5:" + hashlib.md5(CHUNKED).hexdigest().encode()), BODY),
    ("response", made(b"response", HTTP + b"\r\n" + BODY, b"WARC-Payload-Digest: blake3:00"), BODY),  # unknown: not checked
    ("response", made(b"response", HTTP + b"Content-Length: 999\r\n\r\n" + BODY, b"WARC-Truncated: length"), BODY),
    ("response", made(b"response", b"20200101000000\n127.0.0.1\n", b"WARC-Target-URI: dns:x", b"Content-Type: text/dns"), b"20200101000000\n127.0.0.1\n"),
    ("resource", made(b"resource", BODY, b"WARC-Block-Digest: SHA-256:" + hashlib.sha256(BODY).hexdigest().upper().encode(), b"Content-Type: text/html"), BODY),
    ("metadata", made(b"metadata", b"fetchTimeMs: 3\r\n", b"Content-Type: application/warc-fields"), b"fetchTimeMs: 3\r\n"),
    ("conversion", made(b"conversion", b"text", b"Content-Type: text/plain"), b"text"),
    ("revisit", made(b"revisit", HTTP + b"\r\n", b"WARC-Payload-Digest: " + SHA1, b"WARC-Profile: http://netpreserve.org/warc/1.0/revisit/server-not-modified"), None),
    ("revisit", made(b"revisit", b"", b"WARC-Profile: " + W.PROFILE.encode()), None),
]


def test_archives_of_other_writers(spark):
    words = [b"some words of page %d " % i * 20 for i in range(500)]
    trained = zstandard.train_dictionary(2000, words)
    coder = zstandard.ZstdCompressor(dict_data=trained)
    skipped = struct.pack("<II", 0x184D2A5F, 5) + b"index"
    content = W.dictionary_frame(trained.as_bytes()) + b"".join(x for _, r, _ in FOREIGN for x in (coder.compress(r), skipped))
    rows = W.read_archives(spark.createDataFrame([("other.warc.zst", content)], "path string, content binary")).orderBy("offset").collect()
    assert [(r.record_type, None if r.payload is None else bytes(r.payload)) for r in rows] == [(k, p) for k, _, p in FOREIGN]
    assert all(r.payload_digest == hashlib.sha256(p).hexdigest() and r.payload_bytes == len(p) for r, (_, _, p) in zip(rows, FOREIGN) if p is not None)
    assert rows[2].url == "http://x/" and all(r.record_id.startswith("<urn:x:") for r in rows)
    with pytest.raises(ValueError, match="cut off"):
        list(W.frames(content + skipped[:-1]))


@pytest.mark.parametrize("data", [
    made(b"response", HTTP + b"\r\n" + BODY, b"WARC-Payload-Digest: sha1:" + b"A" * 32),
    made(b"response", HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + CHUNKED[:-9]),
    made(b"resource", BODY, b"WARC-Block-Digest: md5:00"),
    made(b"strange", BODY),
    made(b"resource", BODY, b"WARC-Target-URI: a", b"WARC-Target-URI: b"),
    made(b"revisit", HTTP + b"\r\n", b"WARC-Profile: http://other"),
    made(b"response", b"no header"),
])
def test_faults_of_other_writers_are_told(data):
    with pytest.raises(ValueError):
        W.parse_record(data)


def test_query(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()]
    assert fields(op9_warc_zstd(spark, SF_SMALL)) == plain(rows)
