"""WARC: response records from pages, derived metadata and conversion records, files."""

from __future__ import annotations

import base64
import hashlib
import html
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rename_parts
from .html_text import attributes_of, lines_of, tokens
from .textkit import chunks, texts_of

_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: RFC 4122, names that are URLs
RECORD = (
    "record_id string, warc_type string, target_uri string, warc_date string, refers_to string, content_type string, headers map<string,string>, "
    "payload_digest string, block_digest string, source_payload_digest string, source_block_digest string, content_length long, block binary"
)
_CHARSET = re.compile(rb"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.IGNORECASE)
_META_CHARSET = re.compile(rb"<meta\b[^<>]*?charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.IGNORECASE)
_CAPTURED = "2024-01-01T00:00:00Z"
_READ_ROWS = 256  # records that a worker hands over together


def sha1_digest(data: bytes) -> str:
    """The labelled base32 form that WARC headers use."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: object) -> str:
    """A stable record id: the same content always gets the same one."""
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, chr(31).join(map(str, parts)))}>"


def responses(pages: DataFrame, date: str = _CAPTURED) -> DataFrame:
    """Response records of pages(page_id, url, html): HTTP head and body, digests of both.

    A null page has an empty body, a null URL an empty target.
    """

    def run(frames):
        for part in chunks(frames, "html"):
            rows = []
            for page_id, url, page in zip(part["page_id"], texts_of(part["url"]), texts_of(part["html"]), strict=True):
                body = (page or "").encode("utf-8", "surrogatepass")
                block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body) + body
                payload = sha1_digest(body)
                known = "" if pd.isna(page_id) else int(page_id)
                rows.append((record_id("response", known, url or "", payload), "response", url or "", date, None, "application/http; msgtype=response", split_http(block)[1], payload, sha1_digest(block), None, None, len(block), block))
            yield pd.DataFrame(rows, columns=_COLUMNS)

    return pages.select("page_id", "url", "html").mapInPandas(run, RECORD)


_COLUMNS = [c.split()[0] for c in RECORD.split(", ")]


def split_http(block: bytes) -> tuple[str, dict[str, str], bytes]:
    """Status line, headers (names lower-cased, repeated ones joined by a comma) and body of an HTTP message.

    A block without an empty line is all body.
    """
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"HTTP/"):
        return "", {}, block
    status, *lines = head.decode("latin-1").split("\r\n")
    headers: dict[str, str] = {}
    for line in lines:
        name, _, value = line.partition(":")
        name = name.strip().lower()
        headers[name] = f"{headers[name]}, {value.strip()}" if name in headers else value.strip()
    return status, headers, body


def _text(body: bytes, headers: dict[str, str]) -> str:
    """The page in the encoding that its header or a meta element names, UTF-8 if neither or unknown."""
    found = _CHARSET.search(headers.get("content-type", "").encode("latin-1", "replace")) or _META_CHARSET.search(body)
    try:
        return body.decode(found[1].decode() if found else "utf-8", "replace")
    except (LookupError, UnicodeError):
        return body.decode("utf-8", "replace")


def describe(page: str) -> tuple[str, str, list[str]]:
    """Title, language and link targets of a page, references decoded; the first title and language count."""
    title, lang, links = None, None, []
    for _, name, ends, attributes, raw in tokens(page, whole=True):
        if name == "title" and title is None and not ends:
            title = " ".join(html.unescape(raw.partition(">")[2]).split())
        elif ends or name not in ("html", "a"):
            continue
        else:
            found = attributes_of(attributes)
            if name == "html" and lang is None:
                lang = found.get("lang")
            elif name == "a" and found.get("href"):
                links.append(html.unescape(found["href"]).strip())
    return title or "", lang or "", links


def derive(row) -> list[tuple]:
    """The metadata and the conversion record of one response record, both referring to it."""
    status, headers, body = split_http(bytes(row.block or b""))
    page = _text(body, headers)
    lines = [t for t, _, _ in lines_of(page, whole=True)]
    title, lang, links = describe(page)
    payload, whole = row.payload_digest or sha1_digest(body), row.block_digest or sha1_digest(bytes(row.block or b""))
    fields = [("http-status", status), *((f"http-{k}", v) for k, v in headers.items()), ("title", title), ("language", lang), ("payload-digest", payload), ("block-digest", whole), *(("outlink", x) for x in links)]
    metadata = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in fields).encode("utf-8", "surrogatepass")
    plain = "\n".join(lines).encode("utf-8", "surrogatepass")
    uri, date = row.target_uri or "", row.warc_date or _CAPTURED
    return [
        (record_id(kind, row.record_id), kind, uri, date, row.record_id, content, headers, sha1_digest(block), sha1_digest(block), payload, whole, len(block), block)
        for kind, content, block in (("metadata", "application/warc-fields", metadata), ("conversion", "text/plain", plain))
    ]


def build_derivatives(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of every response record; other types pass by.

    Both name the response in refers_to and keep its target, date, HTTP headers
    and digests (source_payload_digest, source_block_digest; payload_digest and block_digest
    are those of the new record); the metadata also holds title, language and links.
    The conversion holds the whole text of the page, menus and footers too, one
    block a line; the title is in the metadata.  A response without block counts
    as empty; repeated rows give equal records under equal ids, so that a
    job run again gives the same file and a reader may drop what repeats.
    """

    def run(frames):
        for frame in frames:
            yield pd.DataFrame([x for row in frame.itertuples(index=False) for x in derive(row)], columns=_COLUMNS)

    return records.filter("warc_type = 'response'").select(*_COLUMNS).mapInPandas(run, RECORD)


# The named fields of WARC/1.1, and fields of our own for what records are derived from.
_FIELDS = {
    "WARC-Type": "warc_type", "WARC-Record-ID": "record_id", "WARC-Date": "warc_date", "WARC-Target-URI": "target_uri", "WARC-Refers-To": "refers_to", "WARC-Payload-Digest": "payload_digest",
    "WARC-Block-Digest": "block_digest", "X-Source-Payload-Digest": "source_payload_digest", "X-Source-Block-Digest": "source_block_digest", "Content-Type": "content_type",
}
_SOURCE_HEADER = "X-Source-Header"


def serialise(row) -> bytes:
    """One record in WARC/1.1 form; the source headers of a derived record are fields of their own."""
    fields = [(k, getattr(row, c)) for k, c in _FIELDS.items()]
    if row.refers_to and row.headers is not None:
        fields += [(_SOURCE_HEADER, f"{k}: {v}") for k, v in dict(row.headers).items()]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in fields if v) + f"Content-Length: {row.content_length}\r\n"
    return head.encode("utf-8", "surrogatepass") + b"\r\n" + bytes(row.block) + b"\r\n\r\n"


def write_warc(records: DataFrame, path: str, compress: bool = True) -> None:
    """Write records as WARC files under path, in any store that Spark writes: part-*.warc, or .warc.gz.

    Each record ends with a line feed, which is the separator of Spark's text
    files; so the bytes of records pass through that sink as they are.
    """

    def run(frames):
        for frame in frames:
            yield pd.DataFrame({"value": [serialise(r)[:-1] for r in frame.itertuples(index=False)]})

    lines = records.mapInPandas(run, "value binary").select(F.col("value").cast("string").alias("value"))
    lines.write.option("lineSep", "\n").option("compression", "gzip" if compress else "none").text(path)
    rename_parts(records.sparkSession, path, ".txt", ".warc")


class _Members(io.RawIOBase):
    """The content of gzip members one after another, as far as they are whole or can be read."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.packed, self.unpack = stream, b"", zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while True:
            self.packed = self.packed or self.stream.read(1 << 16)
            if not self.packed:
                return 0
            try:
                out = self.unpack.decompress(self.packed, len(into))
            except zlib.error:
                return 0
            self.packed = self.unpack.unconsumed_tail
            if self.unpack.eof:
                self.packed, self.unpack = self.unpack.unused_data, zlib.decompressobj(31)
            if out:
                into[: len(out)] = out
                return len(out)


def parse_warc(data: bytes | BinaryIO) -> Iterator[dict]:
    """The records of a WARC file, gzip members or plain, one by one; a cut-off last record is left out.

    fields has the named fields in lower case, the last of repeated ones;
    source_headers those of derived records.
    """
    stream = io.BytesIO(data) if isinstance(data, bytes) else data
    packed = stream.read(2) == b"\x1f\x8b"
    stream.seek(0)
    if packed:
        stream = io.BufferedReader(_Members(stream))
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        fields: dict[str, str] = {}
        source: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            if name.strip().lower() == _SOURCE_HEADER.lower():
                name, _, value = value.partition(":")
                source[name.strip()] = value.strip()
            else:
                fields[name.strip().lower()] = value.strip()
        size = fields.get("content-length", "")
        size = int(size) if size.isdecimal() else 0
        block = stream.read(size)
        if not line or len(block) < size:
            return
        yield {"fields": fields, "source_headers": source, "block": block}


def _record(found: dict) -> tuple:
    fields, block = found["fields"], found["block"]
    values = {c: fields.get(k.lower()) for k, c in _FIELDS.items()}
    headers = (found["source_headers"] if values["refers_to"] else split_http(block)[1]) or None
    return tuple({**values, "headers": headers, "content_length": len(block), "block": block}[c] for c in _COLUMNS)


def read_warc(spark, path: str) -> DataFrame:
    """Records of WARC files (plain or .gz) as a table; a file is one task's, unpacked and handed over piece by piece."""

    def run(frames):
        for frame in frames:
            for content in frame["content"]:
                rows = []
                for found in parse_warc(bytes(content)):
                    rows.append(_record(found))
                    if len(rows) == _READ_ROWS:
                        yield pd.DataFrame(rows, columns=_COLUMNS)
                        rows = []
                yield pd.DataFrame(rows, columns=_COLUMNS)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, RECORD)
