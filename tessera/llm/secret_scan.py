"""Secret scan: patterns, confirmed and extended by decoding what they hold."""

from __future__ import annotations

import base64
import binascii
import json
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import chunks, texts_of

# The base patterns, their order and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ that are long enough
LEAST_ASSIGN, LEAST_ACCESS = 6, 20

METHOD_KINDS = ("pem", "token", "der", "ssh")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----(.*?)-----END \1-----", re.DOTALL)
_SIGNED = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
_HEX_ANY = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){24,}(?![0-9A-Fa-f])")
_ESCAPED = re.compile(r"\\+[nrt]")
_PEM_HEADERS = re.compile(r"\s*((?:[A-Za-z][A-Za-z0-9-]*:[^\n]*\n(?:[ \t]+[^\n]*\n)*)+)")
_CIPHER = re.compile(r"DEK-Info:\s*[A-Za-z0-9-]+,\s*[0-9A-Fa-f]{16,}")
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])(?:M|b3BlbnNzaC1rZXktdjEA)[A-Za-z0-9+/_-]{15,}(?=(?:\s|\\+[nrt])+[A-Za-z0-9+/_-])")
_BREAK = re.compile(r"(?:\s|\\+[nrt])+")
_CHUNK = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_ENCRYPTION = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))  # fixed value: PKCS 5 and PKCS 12
_SSH_MAGIC = b"openssh-key-v1\x00"


def decode_base64(text: str) -> bytes | None:
    """Bytes of standard or URL-safe base64, padding optional; None if it is neither."""
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _der_item(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, content start, content end) of the DER item at a place, None if its length does not fit."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size & 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or at + n > end or data[at] == 0:
            return None
        size = int.from_bytes(data[at : at + n], "big")
        at += n
        if size < 0x80:
            return None
    return (tag, at, at + size) if at + size <= end else None


def _der_items(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The items that fill a range exactly."""
    out = []
    while at < end:
        item = _der_item(data, at, end)
        if item is None:
            return None
        out.append(item)
        at = item[2]
    return out


def is_der_key(data: bytes) -> bool:
    """A sequence filled exactly by nested items, led by a version number, as private keys are.

    Accepts RSA keys (version and at least eight integers), EC keys (version 1 and
    a key string), DSA keys (version 0 and five integers), wrapped keys (version,
    algorithm with an object identifier, key string) and encrypted ones (a password
    scheme and a string).
    """
    top = _der_item(data, 0, len(data))
    if top is None or top[0] != 0x30 or top[2] != len(data):
        return False
    items = _der_items(data, top[1], top[2])
    if items and [t for t, _, _ in items] == [0x30, 0x04]:
        inner = _der_items(data, items[0][1], items[0][2])
        return bool(inner) and inner[0][0] == 0x06 and data[inner[0][1] : inner[0][2]].startswith(_ENCRYPTION) and items[1][2] - items[1][1] >= 16
    if not items or items[0][0] != 0x02 or items[0][2] - items[0][1] != 1:
        return False
    tags = [t for t, _, _ in items]
    if len(tags) >= 9 and set(tags[:9]) == {0x02}:
        return True
    if tags == [0x02] * 6 and data[items[0][1]] == 0:
        return items[1][2] - items[1][1] >= 64 and 20 <= items[2][2] - items[2][1] <= 33
    if len(tags) >= 2 and tags[1] == 0x04 and data[items[0][1]] == 1:
        return items[1][2] - items[1][1] >= 16
    if len(tags) >= 3 and tags[1] == 0x30 and tags[2] == 0x04:
        inner = _der_items(data, items[1][1], items[1][2])
        return bool(inner) and inner[0][0] == 0x06
    return False


def is_ssh_key(data: bytes) -> bool:
    """The magic, then three length-prefixed strings whose lengths nest, and a count of keys."""
    if not data.startswith(_SSH_MAGIC):
        return False
    at = len(_SSH_MAGIC)
    for _ in range(3):
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        if at > len(data):
            return False
    return at + 4 <= len(data) and 1 <= int.from_bytes(data[at : at + 4], "big") <= 64


def is_signed_token(header: str, payload: str) -> bool:
    """A token whose header decodes to a JSON object naming an algorithm and whose payload decodes to one too."""
    try:
        first, second = (json.loads(decode_base64(x) or b"") for x in (header, payload))
    except (ValueError, RecursionError):
        return False
    return isinstance(first, dict) and isinstance(first.get("alg"), str) and isinstance(second, dict)


def is_pem_key(body: str) -> bool:
    """Whether what stands between the marks is a key: line ends may be escaped, headers may come first.

    The content of a key encrypted by its headers is cipher text; whole blocks of it are what can be told.
    """
    body = _ESCAPED.sub("\n", body).replace("\\/", "/")
    headers = _PEM_HEADERS.match(body)
    data = decode_base64("".join(body[headers.end() if headers else 0 :].split()))
    if not data:
        return False
    if headers and "ENCRYPTED" in headers[1] and _CIPHER.search(headers[1]):
        return len(data) >= 16 and len(data) % 8 == 0
    return is_der_key(data) or is_ssh_key(data)


def wrapped_key(text: str, start: int, end: int) -> tuple[str, int] | None:
    """Kind and end of a key whose base64 goes on over white space or escaped line ends after its first line.

    A DER key says how long it is; an SSH key ends with its first shorter line.
    """
    width = end - start
    first = decode_base64(text[start : start + width // 4 * 4]) or b""
    ssh, need = first.startswith(_SSH_MAGIC), 0
    if not ssh:
        if len(first) < 6 or first[0] != 0x30:
            return None
        n = first[1] & 0x7F if first[1] & 0x80 else 0
        if n > 3 or first[2 + n] not in (0x02, 0x30):
            return None
        need = -(-(2 + n + (int.from_bytes(first[2 : 2 + n], "big") if n else first[1])) * 4 // 3)
    parts, have, at = [text[start:end]], width, end
    while ssh or have < need:
        gap = _BREAK.match(text, at)
        chunk = _CHUNK.match(text, gap.end()) if gap else None
        if not chunk:
            break
        parts.append(chunk[0])
        have += len(chunk[0].rstrip("="))
        at = chunk.end()
        if len(chunk[0]) != width:
            break
    data = decode_base64("".join(parts)) if len(parts) > 1 else None
    if not data or not (is_ssh_key(data) if ssh else is_der_key(data)):
        return None
    return ("ssh" if ssh else "der"), at


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base patterns, leftmost and non-overlapping per kind; too short matches are dropped."""
    out = []
    lower = text.lower()
    if any(w in lower for w in ("passw", "secret", "token", "api")):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans whose decoded content has the structure of a key or signed token."""
    out = []
    if "-----BEGIN" in text:
        for m in _PEM.finditer(text):
            if is_pem_key(m[2]):
                out.append(("pem", m.start(), m.end()))
    if "eyJ" in text:
        out += [("token", m.start(), m.end()) for m in _SIGNED.finditer(text) if is_signed_token(m[1], m[2])]
    for m in _BASE64.finditer(text):
        data = decode_base64(m[0])
        if data and is_ssh_key(data):
            out.append(("ssh", m.start(), m.end()))
        elif data and is_der_key(data):
            out.append(("der", m.start(), m.end()))
    pems, after = [(a, b) for k, a, b in out if k == "pem"], 0
    for m in _WRAPPED.finditer(text):
        if m.start() >= after and not any(a <= m.start() < b for a, b in pems) and (found := wrapped_key(text, m.start(), m.end())):
            after = found[1]
            out.append((found[0], m.start(), after))
    for m in _HEX_ANY.finditer(text):
        if is_der_key(bytes.fromhex(m[0])):
            out.append(("der", m.start(), m.end()))
    return out


def scan(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans), each by start and then kind."""
    base, order = base_spans(text), {k: i for i, k in enumerate(KINDS + METHOD_KINDS)}
    return base, sorted(base + confirmed_spans(text), key=lambda s: (s[1], order[s[0]], s[2]))


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, text and the spans found, as arrays of (kind, start, end) in code points.

    Null or empty texts have none; one row per input row.
    """
    spans = "array<struct<kind: string, start: int, end: int>>"

    def run(frames):
        for part in chunks(frames):
            found = [scan(t or "") for t in texts_of(part["text"])]
            yield pd.DataFrame({"doc_id": part["doc_id"], "base": [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in b] for b, _ in found], "found": [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in a] for _, a in found]})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, f"doc_id long, base {spans}, found {spans}")


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, the hash of the base spans, and all spans as one string."""

    def joined(c):
        return F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(k) for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("found").alias("spans"))


def redact(text: str, spans: list[tuple[str, int, int]], mark: str = "[secret]") -> str:
    """The text with every span, or run of overlapping spans, replaced by a mark."""
    out, at = [], 0
    for _, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])
