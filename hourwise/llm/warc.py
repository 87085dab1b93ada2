"""WARC derivatives: metadata and plain-text conversion records of response records.

A response is (record_id, target_uri, date, block): the block holds the HTTP status line, headers and
body. Each response gives a metadata record, with the source's id, date, digests, status and every HTTP header as
``application/warc-fields``, and, if its body is text, a conversion record with the whole visible text of the page.
Both carry WARC-Refers-To with the response's id, and name each other. Record ids are urn:uuid of a hash of the source id and
the type, so a rerun makes the same records. Digests are sha256 in hex.

``serialised`` makes gzip members, one a record, that joined in any order are a WARC file; ``read`` parses
WARC files (a file is one row, so it must be under Spark's limit of 2 GiB), in time linear in the file. What cannot be read never
ends a job: a member that is damaged or cut, a header without an end, and a Content-Length that is missing, no number or beyond the data
each give a row of ``errors`` with the file, the offset and the reason, and reading goes on at the next member or record.

Defined cases: null url and null html are empty; a block without a header end is all headers; bodies in gzip
or chunked coding are decoded, damaged ones kept as they are; unknown charsets are read as UTF-8, bad bytes
replaced; repeated rows make repeated records with the same ids; an empty table makes no records; page ids keep their type; texts are
taken whole, however long; only the columns named are read, others, whatever their names, are not looked at.
"""

from __future__ import annotations

import gzip
import hashlib
import html
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hourwise.llm.common import travels
from hourwise.llm.html_extract import BLOCK, SEEN, tokens
from hourwise.llm.text import texts_of

travels(__name__)

VERSION = b"WARC/1.1"
#: Date of responses made from stored pages, which carry none.
PAGE_DATE = "1970-01-01T00:00:00Z"
RECORD = ("page_id long, record_type string, record_id string, refers_to string, target_uri string, date string, "
          "content_type string, content_length long, block_digest string, source_digest string, concurrent_to string, block binary")
_NAMES = [c.split()[0] for c in RECORD.split(", ")]


def digest(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def record_uri(*parts: str) -> str:
    h = hashlib.sha256("\x00".join(parts).encode("utf-8", "surrogatepass")).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=h[:16], version=5)}>"


def response_of(page_id, url: str | None, body: bytes) -> dict:
    """Response record of a stored page."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n"
    return {"page_id": page_id, "record_id": record_uri("response", str(page_id), url or "", digest(body)),
            "target_uri": url or "", "date": PAGE_DATE, "block": head.encode() + body}


def http_parts(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and body as sent."""
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")
    headers = [(k.strip(), v.strip()) for k, sep, v in (x.partition(":") for x in lines[1:]) if sep]
    return lines[0], headers, body


def _dechunked(body: bytes) -> bytes:
    out, at = [], 0
    while m := re.compile(rb"([0-9a-fA-F]+)[^\r\n]*\r\n").match(body, at):
        n = int(m[1], 16)
        if not n:
            return b"".join(out)
        out.append(body[m.end():m.end() + n])
        at = m.end() + n + 2
    return body


def text_body(headers: list[tuple[str, str]], body: bytes) -> str | None:
    """Decoded body, or None if it is not text."""
    h = {k.lower(): v for k, v in headers}
    kind = h.get("content-type", "text/html").lower()
    if not kind.startswith(("text/", "application/xhtml")):
        return None
    if "chunked" in h.get("transfer-encoding", "").lower():
        body = _dechunked(body)
    if "gzip" in h.get("content-encoding", "").lower():
        try:
            body = gzip.decompress(body)
        except (OSError, EOFError, zlib.error):
            pass
    charset = m[1] if (m := re.search(r"charset=[\"']?([\w.:-]+)", kind)) else "utf-8"
    try:
        return body.decode(charset, "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def plain_text(page: str, kind: str = "text/html") -> str:
    """Visible text of a page: blocks on lines of their own, white space in a block as one space."""
    if kind.startswith("text/plain"):
        return page
    blocks, block = [], []
    for what, value, _ in [*tokens(page, SEEN), ("tag", "p", ())]:
        if what == "text":
            block.append(value)
        elif value in BLOCK:
            if text := " ".join(html.unescape("".join(block)).split()):
                blocks.append(text)
            block = []
    return "\n".join(blocks)


def derivatives(response: dict) -> list[dict]:
    """Metadata and conversion records of a response."""
    status, headers, body = http_parts(response["block"])
    source = response["record_id"]
    ids = {kind: record_uri(kind, source) for kind in ("metadata", "conversion")}
    text = text_body(headers, body)
    payload = digest(body)
    fields = [("source-record-id", source), ("source-date", response["date"]), ("source-block-digest", digest(response["block"])),
              ("source-payload-digest", payload), ("source-status", status), *((f"source-header-{k.lower()}", v) for k, v in headers)]
    if text is not None:
        fields.append(("conversion-record-id", ids["conversion"]))
    made = [("metadata", "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "replace"))]
    if text is not None:
        kind = next((v.lower() for k, v in headers if k.lower() == "content-type"), "text/html")
        made.append(("conversion", "text/plain; charset=utf-8", plain_text(text, kind).encode("utf-8", "replace")))
    other = {"metadata": "conversion", "conversion": "metadata"}
    return [{"page_id": response.get("page_id"), "record_type": kind, "record_id": ids[kind], "refers_to": source,
             "target_uri": response["target_uri"], "date": response["date"], "content_type": content_type,
             "content_length": len(block), "block_digest": digest(block), "source_digest": payload,
             "concurrent_to": ids[other[kind]] if len(made) > 1 else None, "block": block} for kind, content_type, block in made]


def _records(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


_ARROW = pa.schema([(n, pa.int64() if n in ("page_id", "content_length") else pa.binary() if n == "block" else pa.string())
                    for n in _NAMES])


def derived_from_pages(pages: DataFrame) -> DataFrame:
    """Derivative records (see RECORD; page_id as in ``pages``) of every row of ``pages`` (page_id, url, html) as a response."""
    names, plain = _NAMES, _ARROW

    def run(batches):
        for batch in batches:
            schema = plain.set(0, batch.schema.field("page_id"))
            rows = zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), texts_of(batch.column("html")))
            yield _records([x for i, url, body in rows for x in derivatives(response_of(i, url, body or b""))], schema)
    made = T.StructType([pages.schema["page_id"], *T.StructType.fromDDL(RECORD).fields[1:]])
    return pages.select("page_id", "url", "html").mapInArrow(run, made).select(*names)


def derived(responses: DataFrame) -> DataFrame:
    """Derivative records of ``responses`` (record_id, target_uri, date, block)."""
    schema = _ARROW

    def run(batches):
        for batch in batches:
            yield _records([x for r in batch.to_pylist() for x in derivatives(
                {k: r[k] if k == "block" else r[k] or "" for k in r} | {"block": r["block"] or b""})], schema)
    return responses.select("record_id", "target_uri", "date", "block").mapInArrow(run, RECORD)


def to_bytes(r: dict) -> bytes:
    """A record as in a WARC file, uncompressed."""
    block = r["block"] or b""
    head = [("WARC-Type", r["record_type"]), ("WARC-Record-ID", r["record_id"]), ("WARC-Refers-To", r.get("refers_to")),
            ("WARC-Concurrent-To", r.get("concurrent_to")), ("WARC-Target-URI", r["target_uri"]), ("WARC-Date", r["date"]),
            ("WARC-Block-Digest", r.get("block_digest") or digest(block)), ("Content-Type", r["content_type"]),
            ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {re.sub(r'[\r\n]+', ' ', v)}\r\n" for k, v in head if v)
    return VERSION + b"\r\n" + lines.encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


#: Compressed bytes that are fed to the decompressor at a time.
FEED = 1 << 16
_MEMBER = b"\x1f\x8b\x08"


def _member(data: bytes, at: int) -> tuple[bytes | None, int]:
    """Content of the gzip member at an offset, or None if it is damaged, and the offset after it."""
    d, parts, pos = zlib.decompressobj(31), [], at
    try:
        while not d.eof and pos < len(data):
            parts.append(d.decompress(data[pos:pos + FEED]))
            pos += FEED
    except zlib.error:
        return None, at + 1
    return (b"".join(parts), min(pos, len(data)) - len(d.unused_data)) if d.eof else (None, at + 1)


def parsed(data: bytes):
    """(offset, record, None) or (offset, None, error) of a WARC file's bytes, compressed by member or not; offsets are those of
    members, or of records if there are none."""
    if data[:2] != _MEMBER[:2]:
        yield from _plain_records(data)
        return
    at = 0
    while 0 <= at < len(data):
        content, after = _member(data, at)
        if content is None:
            yield at, None, "damaged or cut gzip member"
            at = data.find(_MEMBER, after)
            continue
        for _, record, error in _plain_records(content):
            yield at, record, error
        at = after
        if at < len(data) and data[at:at + 2] != _MEMBER[:2]:
            yield at, None, "no gzip member"
            at = data.find(_MEMBER, at)


def _plain_records(data: bytes):
    at = data.find(b"WARC/")
    if at < 0 and data.strip():
        yield 0, None, "no record"
    while at >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            yield at, None, "header without an end"
            return
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        h = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = h.get("content-length", "")
        n = int(size) if re.fullmatch("[0-9]{1,18}", size) else -1
        if n < 0 or end + 4 + n > len(data):
            yield at, None, f"Content-Length {size[:40]!r}" if n < 0 else "record cut short"
            begin = data.find(b"\r\nWARC/", at + 5)
            at = begin + 2 if begin >= 0 else -1
            continue
        block = data[end + 4:end + 4 + n]
        yield at, {"page_id": None, "record_type": h.get("warc-type"), "record_id": h.get("warc-record-id"),
                   "refers_to": h.get("warc-refers-to"), "target_uri": h.get("warc-target-uri", ""), "date": h.get("warc-date"),
                   "content_type": h.get("content-type"), "content_length": n, "block_digest": h.get("warc-block-digest"),
                   "source_digest": None, "concurrent_to": h.get("warc-concurrent-to"), "block": block}, None
        at = data.find(b"WARC/", end + 4 + n)


def from_bytes(data: bytes):
    """Records of a WARC file's bytes that can be read."""
    return (record for _, record, _ in parsed(data) if record is not None)


def serialised(records: DataFrame) -> DataFrame:
    """(record_id, member): each record as a gzip member."""
    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([r["record_id"] for r in rows], pa.string()),
                                              pa.array([gzip.compress(to_bytes(r), mtime=0) for r in rows], pa.binary())],
                                             names=["record_id", "member"])
    return records.mapInArrow(run, "record_id string, member binary")


def scan(spark: SparkSession, path: str) -> DataFrame:
    """Records (see RECORD) and errors of the WARC files below ``path``, with path, offset and error."""
    plain = _ARROW

    def run(batches):
        schema = pa.schema([*plain, pa.field("path", pa.string()), pa.field("offset", pa.int64()), pa.field("error", pa.string())])
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                rows, room = [], FEED * 64
                for at, record, error in parsed(data):
                    rows.append((record or {}) | {"path": name, "offset": at, "error": error})
                    room -= len(rows[-1].get("block") or b"")
                    if len(rows) == 500 or room < 0:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, room = [], FEED * 64
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(run, RECORD + ", path string, offset long, error string")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records (see RECORD) of the WARC files below ``path``."""
    return scan(spark, path).filter("error IS NULL").select(*_NAMES)


def errors(spark: SparkSession, path: str) -> DataFrame:
    """(path, offset, error) of what could not be read of the WARC files below ``path``."""
    return scan(spark, path).filter("error IS NOT NULL").select("path", "offset", "error")
