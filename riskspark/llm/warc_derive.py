"""WARC derivatives: from each response record a linked metadata record and a plain-text conversion.

A response record is parsed into its WARC headers, HTTP header and payload. Derived from it are

- a ``metadata`` record of ``application/warc-fields``: HTTP status and header fields of the source, its
  WARC date, and whether its payload digest holds;
- a ``conversion`` record of ``text/plain``: the visible text of an HTML payload, a block on each line.

Both refer to the source's record id (``WARC-Refers-To``), keep its target URI, date and payload digest
(``WARC-Refers-To-Target-URI``, ``-Date``), and have a block digest (SHA-1, base 32) and a length of
their own. Record ids are UUIDs made of the source id and the kind, so that a task that runs again
makes the same records.

A null or empty record, or one that is no response or has no HTTP header, gives no derivative but one
row of kind ``error`` that names the reason, so that nothing is lost in silence. Repeated records give
repeated rows; an empty table gives an empty result. Further columns are ignored. Digests are those of the payload
without its transfer encoding (chunks); for the text, gzip and deflate are unpacked, any other content encoding
is an error row. A record is handled whole, however long: memory follows the longest one."""

from __future__ import annotations

import base64
import codecs
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm import html_lineblocks
from riskspark.llm.common import only

VERSION, END = "WARC/1.1", "\r\n"
#: Namespace of derived record ids (any fixed UUID).
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
SCHEMA = ("key bigint, kind string, record_id string, refers_to string, target_uri string, content_type string, "
          "block_digest string, payload_digest string, payload_ok boolean, content_length bigint, record binary, error string")
COLUMNS = [part.split()[0] for part in SCHEMA.split(", ")]


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def fields(head: bytes) -> tuple[str, list[tuple[str, str]]]:
    """First line and fields of a header; lines that begin with white space continue the one before."""
    rows = re.split(r"\r?\n", head.decode("utf-8", "replace"))  # no other character ends a header line
    out: list[tuple[str, str]] = []
    for row in rows[1:]:
        if row[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {row.strip()}")
        elif ":" in row:
            name, value = row.split(":", 1)
            out.append((name.strip(), value.strip()))
    return rows[0] if rows else "", out


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = END.join([VERSION, *(f"{n}: {v}" for n, v in headers), f"Content-Length: {len(block)}"])
    return (head + END * 2).encode() + block + (END * 2).encode()


def response(uri: str, date: str, payload: bytes, record_id: str | None = None) -> bytes:
    """A response record with an HTML payload (the inverse of parsing, for tables of pages)."""
    http = f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: {len(payload)}{END}{END}".encode()
    block = http + payload
    return record([("WARC-Type", "response"), ("WARC-Record-ID", record_id or f"<urn:uuid:{uuid.uuid5(NAMES, uri)}>"),
                   ("WARC-Date", date), ("WARC-Target-URI", uri), ("Content-Type", "application/http; msgtype=response"),
                   ("WARC-Block-Digest", digest(block)), ("WARC-Payload-Digest", digest(payload))], block)


def parse(raw: bytes) -> tuple[dict[str, str], str, list[tuple[str, str]], bytes]:
    """(WARC headers by lower-case name, HTTP status line, HTTP fields, payload) of a response record."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    version, warc = fields(head)
    named = {n.lower(): v for n, v in warc}
    if not gap or not version.startswith("WARC/"):
        raise ValueError("no WARC header")
    if named.get("warc-type") != "response":
        raise ValueError("no response record")
    if not named.get("content-length", "").isdigit() or int(named["content-length"]) > len(rest):
        raise ValueError("record cut short")
    if not named.get("warc-record-id"):
        raise ValueError("no record id")
    http, gap, payload = rest[:int(named["content-length"])].partition(b"\r\n\r\n")
    status, http_fields = fields(http)
    if not gap or not status.startswith("HTTP/"):
        raise ValueError("no HTTP header")
    return named, status, http_fields, payload


def charset(http_fields: list[tuple[str, str]]) -> str:
    kind = next((v for n, v in http_fields if n.lower() == "content-type"), "")
    name = kind.lower().partition("charset=")[2].split(";")[0].strip(" \"'")
    try:
        return codecs.lookup(name or "utf-8").name
    except LookupError:
        return "utf-8"


def entity(http_fields: list[tuple[str, str]], payload: bytes) -> tuple[bytes, bytes]:
    """The payload without its transfer encoding, and that without its content encoding too."""
    named = {n.lower(): v.lower().strip() for n, v in http_fields}
    if "chunked" in named.get("transfer-encoding", ""):
        parts, at = [], 0
        while True:
            line, _, _ = payload[at:].partition(b"\r\n")
            try:
                size = int(line.split(b";")[0], 16)
            except ValueError:
                raise ValueError("chunks cannot be read") from None
            at += len(line) + 2
            if size == 0:
                break
            if at + size > len(payload):
                raise ValueError("chunks cut short")
            parts.append(payload[at:at + size])
            at += size + 2
        payload = b"".join(parts)
    plain = payload
    for coding in reversed([c.strip() for c in named.get("content-encoding", "").split(",") if c.strip() not in ("", "identity")]):
        if coding not in ("gzip", "x-gzip", "deflate"):
            raise ValueError(f"content encoding {coding} cannot be read")
        try:  # 47: a gzip or zlib header, whichever there is; -15: deflate without one
            plain = zlib.decompress(plain, 47)
        except zlib.error:
            try:
                plain = zlib.decompress(plain, -15)
            except zlib.error:
                raise ValueError("payload cannot be unpacked") from None
    return payload, plain


def derive_one(raw: bytes) -> list[tuple]:
    named, status, http_fields, payload = parse(raw)
    source, uri, date = named["warc-record-id"], named.get("warc-target-uri", ""), named.get("warc-date", "")
    payload, plain = entity(http_fields, payload)
    made, said = digest(payload), named.get("warc-payload-digest")
    same = made == said if said else None
    meta = [("http-status", status), *((f"http-{n.lower()}", v) for n, v in http_fields),
            ("source-date", date), ("payload-digest-valid", {True: "yes", False: "no", None: "unknown"}[same])]
    text = "\n".join(x.text for x in html_lineblocks.lines(plain.decode(charset(http_fields), "replace"), everything=True) if x.text)
    out = []
    for kind, content, block in (
            ("metadata", "application/warc-fields", "".join(f"{n}: {v}{END}" for n, v in meta).encode()),
            ("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace"))):
        rid = f"<urn:uuid:{uuid.uuid5(NAMES, f'{source} {kind}')}>"
        headers = [("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Refers-To", source), ("WARC-Target-URI", uri),
                   ("WARC-Date", date), ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", date),
                   ("WARC-Source-Payload-Digest", said or made), ("WARC-Block-Digest", digest(block)), ("Content-Type", content)]
        out.append((kind, rid, source, uri, content, digest(block), said or made, same, len(block), record(headers, block), None))
    return out


def derive(records: DataFrame) -> DataFrame:
    """Derived records of ``records(key, record)``; columns as in ``SCHEMA``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = batch.slice(at, 256), []
                for key, raw in zip(part.column(0).to_pylist(), part.column(1)):
                    try:
                        rows += [(key, *r) for r in derive_one(raw.as_py() or b"")]
                    except ValueError as e:
                        rows.append((key, "error", *[None] * 9, str(e)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                        [pa.int64(), *[pa.string()] * 7, pa.bool_(), pa.int64(), pa.binary(), pa.string()])], names=COLUMNS)

    return only(records, key="bigint", record="binary").mapInArrow(run, SCHEMA)


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records ``(key, record)`` of ``pages(page_id, url, html)``; null url or html is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [response(u.as_py() or "", date, (h.as_py() or "").encode(), f"<urn:uuid:{uuid.uuid5(NAMES, f'{k} {u}')}>")
                    for k, u, h in zip(batch.column(0), batch.column(1), batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["key", "record"])

    return only(pages, page_id="bigint", url="string", html="string").mapInArrow(run, "key bigint, record binary")


def write(derived: DataFrame, path: str) -> None:
    """Write the derived records as gzipped WARC files, one for each partition, with Spark's own writer:
    a record without its closing line ends is a row, and those line ends separate rows."""
    body = F.expr("left(cast(record as string), length(cast(record as string)) - 4)")
    rows = derived.where("record is not null").select(body.alias("value"))
    rows.write.option("lineSep", END * 2).option("compression", "gzip").text(path)


def derivatives(pages: DataFrame) -> DataFrame:
    """The query's rows: for each page's response the two derived records with their links and digests."""
    out = derive(responses(pages))
    return out.withColumnRenamed("key", "page_id").withColumn("record_sha256", F.sha2("record", 256)).drop("record")
