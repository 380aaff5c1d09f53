"""Zstandard WARC archives: writer and reader (operator 9).

An archive starts with a skippable frame that holds the dictionary; each record
is one frame compressed with it.  The first page (smallest id) with a payload is
its response record, equal payloads of 100 bytes or more revisit it.

Spark deals the records to archives of bounded size; an archive is a row (path,
length, content), the columns of Spark's ``binaryFile`` source, so the reader
takes rows that were written as Parquet and ``.warc.zst`` files of other writers alike.
The reader decodes frame by frame, passes over skippable ones, knows all record types,
undoes chunked transfer coding, and checks every header, length and named digest.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiflow.llm.common import bounded_sample, cut, text_or_empty
from lexiflow.session import ensure_checkpoint_dir

#: Fixed values of the format: the skippable frame of the dictionary, frame magics, the revisit profile.
DICT_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
SKIPPABLE = 0x184D2A50  # the first of 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PROFILES = re.compile(r"http://netpreserve\.org/warc/1\.[01]/revisit/(identical-payload-digest|server-not-modified|uri-agnostic-identical-payload-digest)$")
TYPES = frozenset("warcinfo response resource request metadata revisit conversion continuation".split())
#: Headers that a record may have several times.
REPEATED = frozenset({"warc-concurrent-to"})
DIGESTS = frozenset("md5 sha1 sha224 sha256 sha384 sha512".split())
#: Payloads under so many bytes are never revisits.
LEAST = 100
#: Bytes of an archive after which the next one begins.
ARCHIVE_BYTES = 4_000_000
#: The dictionary is trained on so many pages, on so many characters of each, and has so many bytes
#: (a bounded sample: it changes how small archives are, never what they hold).
DICT_PAGES, DICT_CHARS, DICT_BYTES = 400, 16_000, 32_768
DATE = "1970-01-01T00:00:00Z"

_ARCHIVES = "path string, length bigint, content binary"
_RECORDS = (
    "path string, offset bigint, record_id string, page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, "
    "refers_to bigint, payload binary, problem string"
)
_RECORD_TYPE = pa.schema(
    [
        ("path", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("problem", pa.string()),
    ]
)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def _field(value: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit has the response's HTTP header but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_field(url)}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if page_id is not None:
        head.append(f"Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
        if refers_to is not None:
            head.append(f"Refers-To-Page-Id: {refers_to}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def _header(head: bytes) -> dict[str, list[str]]:
    """The header fields of a record, names in lower case; folded lines are put together."""
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("not a WARC record")
    fields: dict[str, list[str]] = {}
    name = ""
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and name:
            fields[name][-1] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        name = name.lower()
        if not colon or name in fields and name not in REPEATED:
            raise ValueError(f"bad or repeated header: {line[:60]}")
        fields.setdefault(name, []).append(value.strip())
    return fields


def _fits(told: str | None, *contents: bytes) -> bool:
    """Whether a digest (``algorithm:value``, hex or base32) is that of one of ``contents``; of an unknown
    algorithm nothing can be said."""
    algorithm, colon, value = (told or "").partition(":")
    algorithm = algorithm.lower().replace("-", "")
    if not colon or algorithm not in DIGESTS:
        return True
    found = [hashlib.new(algorithm, c).digest() for c in contents]
    return any(value.lower() == d.hex() or value.upper().rstrip("=") == base64.b32encode(d).decode().rstrip("=") for d in found)


def dechunk(body: bytes) -> bytes:
    """The content of a body in chunked transfer coding."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = re.match(rb"[0-9A-Fa-f]+", body[at:end]) if end >= 0 else None
        if not size:
            raise ValueError("a chunk has no size")
        at, n = end + 2, int(size[0], 16)
        if not n:
            return b"".join(parts)
        if at + n > len(body):
            raise ValueError("a chunk is cut off")
        parts.append(body[at : at + n])
        at += n + 2


def parse_record(data: bytes) -> dict:
    """The fields of one record of any type; raises ValueError where a header, length or digest is wrong.

    The payload is what the block holds behind its HTTP header, if it has one, without
    transfer coding, else the block.  A revisit has none; its length and digest are those
    that it names."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("not a WARC record")
    fields = _header(head)
    only = lambda name: fields[name][0] if name in fields else None
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"no {name}")
    kind = only("warc-type")
    if kind not in TYPES:
        raise ValueError(f"unknown record type: {kind[:40]}")
    if not only("content-length").isdecimal() or len(rest) != int(only("content-length")) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError("the block's length is not Content-Length")
    block = rest[:-4]
    if not _fits(only("warc-block-digest"), block):
        raise ValueError("the block is other than its digest says")
    payload = body = block
    told = None
    if kind in ("request", "response", "revisit") and (block or kind != "revisit") and (only("content-type") or "application/http").lower().startswith("application/http"):
        http, gap, body = block.partition(b"\r\n\r\n")
        if not gap or not (http.startswith(b"HTTP/") or kind == "request"):
            raise ValueError("no HTTP header")
        told = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d+)", http)
        chunked = kind == "response" and re.search(rb"(?i)\r\ntransfer-encoding:[^\r]*chunked", http)
        payload = dechunk(body) if chunked and "warc-truncated" not in fields else body
        if kind == "response" and told and not chunked and "warc-truncated" not in fields and len(body) != int(told[1]):
            raise ValueError("the payload is not as long as its header says")
    digest = only("warc-payload-digest")
    named = digest.partition(":")[2].lower() if digest and digest.lower().startswith("sha256:") else None
    if kind == "revisit":
        if body != b"" and told is not None or not PROFILES.match(only("warc-profile") or ""):
            raise ValueError("no revisit of an identical payload")
    elif "warc-truncated" not in fields and not _fits(digest, payload, body):  # writers differ on transfer coding
        raise ValueError("the payload is other than its digest says")
    number = lambda name: int(only(name)) if name in fields else None
    return {
        "record_id": only("warc-record-id"), "page_id": number("page-id"), "url": only("warc-target-uri"), "record_type": kind,
        "payload_bytes": (int(told[1]) if told else None) if kind == "revisit" else len(payload),
        "payload_digest": named if kind == "revisit" else hashlib.sha256(payload).hexdigest(),
        "refers_to": number("refers-to-page-id"), "payload": None if kind == "revisit" else payload,
    }


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICT_MAGIC, len(dictionary)) + dictionary


def frames(content: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, decoded record) of each frame, with the dictionary of the leading skippable frame;
    later skippable frames are passed over."""
    at, dictionary = 0, None
    if len(content) >= 8:
        magic, size = struct.unpack_from("<II", content)
        if magic == DICT_MAGIC:
            if 8 + size > len(content):
                raise ValueError("the dictionary frame is cut off")
            raw, at = content[8 : 8 + size], 8 + size
            if raw[:4] == struct.pack("<I", FRAME_MAGIC):  # the dictionary itself may be compressed
                raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
            dictionary = zstandard.ZstdCompressionDict(raw) if raw else None
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    view = memoryview(content)
    while at < len(content):
        if len(content) - at >= 8:
            magic, size = struct.unpack_from("<II", content, at)
            if SKIPPABLE <= magic < SKIPPABLE + 16:  # a skippable frame between records
                if at + 8 + size > len(content):
                    raise ValueError("a skippable frame is cut off")
                at += 8 + size
                continue
        one, fed, parts = decoder.decompressobj(), at, []
        while not one.eof:
            piece = view[fed : fed + 65536]
            if not len(piece):
                raise ValueError("the last frame is cut off")
            parts.append(one.decompress(piece))
            fed += len(piece)
        yield at, b"".join(parts)
        at = fed - len(one.unused_data)


def train_dictionary(pages: DataFrame, html_col: str = "html") -> bytes:
    """A dictionary from a bounded sample of pages; empty where the sample is too small to train on."""
    some = pages.select("page_id", F.substring(text_or_empty(html_col), 1, DICT_CHARS).alias("h")).where("h != ''")
    texts = [r.h.encode("utf-8") for r in bounded_sample(some, DICT_PAGES, F.col("page_id"), F.col("h"))]
    try:
        return zstandard.train_dictionary(DICT_BYTES, texts).as_bytes()
    except zstandard.ZstdError:
        return b""


def plan_records(pages: DataFrame) -> DataFrame:
    """``pages`` as (page_id, url, payload, digest, refers_to, revisit)."""
    payload = F.encode(text_or_empty("html"), "UTF-8")
    digests = pages.select("page_id", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("n")).where(F.col("n") >= LEAST)
    digests = cut(digests.select("page_id", "digest"))
    firsts = digests.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("times")).where("times > 1")
    revisits = digests.join(firsts, "digest").where("first < page_id or (page_id is null and first is not null)")
    revisits = revisits.select(F.col("page_id").alias("id"), F.col("digest").alias("of"), F.col("first").alias("refers_to")).distinct()
    source = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    same = source.page_id.eqNullSafe(revisits["id"]) & (source.digest == revisits["of"])
    return source.join(revisits, same, "left").select("page_id", "url", "payload", "digest", "refers_to", F.col("of").isNotNull().alias("revisit"))


def write_archives(records: DataFrame, dictionary: bytes, name: str = "pages") -> DataFrame:
    """Archives (path, length, content) of ``plan_records``: one frame per record."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        coder = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True) if trained else zstandard.ZstdCompressor(level=3, write_checksum=True)
        lead = dictionary_frame(dictionary)
        task, made = TaskContext.get().partitionId(), 0

        def archive(parts: list[bytes]) -> pa.RecordBatch:
            content = b"".join(parts)
            path = f"{name}-{task:06d}-{made:06d}.warc.zst"
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(content)], pa.int64()), pa.array([content], pa.binary())], names=["path", "length", "content"])

        parts, size = [lead], 0
        for batch in batches:
            for row in zip(*batch.columns):
                page_id, url, payload, digest, refers_to, revisit = (v.as_py() for v in row)
                parts.append(coder.compress(record(page_id, url, payload, digest, refers_to, revisit)))
                size += len(parts[-1])
                if size >= ARCHIVE_BYTES:
                    yield archive(parts)
                    parts, size, made = [lead], 0, made + 1
        if len(parts) > 1:
            yield archive(parts)

    return records.select("page_id", "url", "payload", "digest", "refers_to", "revisit").sortWithinPartitions("page_id", "digest").mapInArrow(pack, _ARCHIVES)


def read_archives(archives: DataFrame, strict: bool = True, payloads: bool = True) -> DataFrame:
    """The records of archives (path, content): one row each, or with ``strict`` off a row with the
    problem of a broken record or archive; with it on a broken one fails the job.  All records are
    decoded and checked; with ``payloads`` off they are not returned."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows: list[dict] = []
                size = at = 0
                try:
                    for at, data in frames(content.as_py()):
                        try:
                            rows.append({"path": path, "offset": at, **parse_record(data)})
                            if not payloads:
                                rows[-1]["payload"] = None
                        except ValueError as wrong:
                            if strict:
                                raise
                            rows.append({"path": path, "offset": at, "problem": str(wrong)})
                        size += len(data)
                        if size >= ARCHIVE_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=_RECORD_TYPE)
                            rows, size = [], 0
                except (ValueError, zstandard.ZstdError) as wrong:
                    if strict:
                        raise ValueError(f"{path} at {at}: {wrong}") from wrong
                    rows.append({"path": path, "offset": at, "problem": str(wrong)})
                yield pa.RecordBatch.from_pylist(rows, schema=_RECORD_TYPE)

    return archives.select("path", "content").mapInArrow(unpack, _RECORDS)


def round_trip(spark: SparkSession, pages: DataFrame, payloads: bool = True) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) to archives in the shared folder and read them back.

    A null html is an empty payload; payloads under 100 bytes are all responses;
    of rows that share the smallest page_id of a payload each is a response; a null
    page_id comes after all others; a null url has no target header; an empty table
    gives no archives and no rows; very long pages are records like others; other columns
    are not read.
    """
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    archives = write_archives(plan_records(pages.select("page_id", "url", "html")), train_dictionary(pages))
    archives.write.option("compression", "uncompressed").parquet(folder)
    return read_archives(spark.read.parquet(folder), payloads=payloads)


ORACLE = f"""
with d as (
  select page_id, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
f as (select *, min(page_id) over (partition by payload_digest) as first from d)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= {LEAST} and page_id > first then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= {LEAST} and page_id > first then first end as refers_to
from f
"""
