r"""Operator 11, secrets in texts, with structural confirmation.

The base formats (an assignment to a telling name, an access key id, a run of
hex digits) are found by their patterns. Beside them, strings are reported for
what they decode to, whatever stands around them:

* ``key``: base64 or hex that decodes to a private key. The outer length of a
  DER encoding says how many characters belong to it, across line breaks (or
  breaks written ``\n``, as inside JSON); every nested length must fill its
  parent exactly, and the elements must be those of PKCS#1, PKCS#8, SEC 1, DSA
  or PKCS#12. An OpenSSH key is read by its chain of length fields.
* ``jwt``: three dotted base64url parts of which the first is a JSON header
  naming a signature algorithm, the second a JSON object.
* Base64 or hex that decodes to text is searched again for both, so a key
  wrapped once more is found too; the span is that of the outer string.

Every reported string carries what it was confirmed as (``detail``); a base
span has a detail if its own value decodes to something, else none.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds in the order of a report: the base formats, then what decoding finds.
BASE_KINDS, FOUND_KINDS = ("assign", "access", "hex"), ("key", "jwt")
KINDS = BASE_KINDS + FOUND_KINDS
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16
# Least length of a string that is decoded in the hope of text; wrappings looked into.
WRAPPED_LENGTH, DEPTH = 32, 3

# The base formats (a run of hex digits is maximal, so a least count finds the same runs).
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_LENGTH)

# DER tags, the object identifiers of password-based encryption, the OpenSSH mark.
INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30
_PBE = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
_OPENSSH = b"openssh-key-v1\0"

# A key's first characters: a sequence in base64 or hex, or the OpenSSH mark in base64.
_KEY_START = re.compile(r"(?:(?<![A-Za-z0-9+])|(?<=\\n))(?:M[A-P][A-Za-z0-9+/_-]{2}|b3BlbnNzaC1rZXktdjEA)")
_HEX_KEY = re.compile(r"(?<![0-9A-Fa-f])30(?:[0-9A-Fa-f]{2}){5,}(?![0-9A-Fa-f])")
_RUN, _BREAK = re.compile(r"[A-Za-z0-9+/_-]+"), re.compile(r"(?:\\r)?\\n|\r?\n[ \t]*")
_PADDED_END = re.compile(r"={0,2}(?![A-Za-z0-9+/_=]|-(?!--))")
_SIGNED = re.compile(r"(?<![A-Za-z0-9_-])(e[w-z0-9_-][A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)(?![A-Za-z0-9_.-])")
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}(?:={1,2})?" % WRAPPED_LENGTH)
_ALL_HEX = re.compile(r"(?:[0-9A-Fa-f]{2})+\Z")
# Whatever may be confirmed holds a run of this length; most texts hold none.
_LONG_RUN = re.compile(r"[A-Za-z0-9+/_-]{14}")
_TO_STANDARD = str.maketrans("-_", "+/")

Found = tuple[str, int, int, str | None]


def decoded64(chars: str) -> bytes | None:
    """Bytes of base64 characters of either alphabet, padding left out; None if their number is impossible."""
    chars = chars.rstrip("=")
    if len(chars) % 4 == 1:
        return None
    try:
        return base64.b64decode(chars.translate(_TO_STANDARD) + "=" * (-len(chars) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def read64(text: str, start: int, size: int) -> tuple[bytes, int]:
    """Up to ``size`` bytes of the base64 that starts at ``start``, over line breaks, and where it was left."""
    need, have, at, parts = -(-size * 4 // 3), 0, start, []
    while have < need:
        run = _RUN.match(text, at, at + need - have)
        if not run:
            break
        parts.append(run[0])
        have, at = have + len(run[0]), run.end()
        gap = _BREAK.match(text, at) if have < need else None
        if not gap:
            break
        at = gap.end()
    return decoded64("".join(parts)) or b"", at


def elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """``(tag, start, end)`` of the DER elements that fill ``at:end``; None if a length does not fit."""
    out = []
    while at < end:
        if end - at < 2:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            more = size & 0x7F
            if not 1 <= more <= 4 or end - at < more:
                return None
            size, at = int.from_bytes(data[at:at + more], "big"), at + more
        if end - at < size:
            return None
        out.append((tag, at, at + size))
        at += size
    return out


def der_size(head: bytes) -> int | None:
    """Bytes of the sequence whose first bytes are ``head``, its own header included."""
    if len(head) < 6 or head[0] != SEQUENCE:
        return None
    if head[1] < 0x80:
        return 2 + head[1]
    more = head[1] & 0x7F
    return 2 + more + int.from_bytes(head[2:2 + more], "big") if 1 <= more <= 4 else None


def _algorithm(data: bytes, part: tuple[int, int, int]) -> bytes | None:
    """The object identifier an algorithm sequence begins with."""
    inner = elements(data, *part[1:]) if part[0] == SEQUENCE else None
    return data[inner[0][1]:inner[0][2]] if inner and inner[0][0] == OID else None


def der_key(data: bytes) -> str | None:
    """The kind of private key that ``data``, one whole DER sequence, encodes."""
    outer = elements(data, 0, len(data))
    parts = elements(data, *outer[0][1:]) if outer and len(outer) == 1 and outer[0][0] == SEQUENCE else None
    if not parts or len(parts) < 2:
        return None
    tags = [t for t, _, _ in parts]
    first = data[parts[0][1]:parts[0][2]]
    if tags[:2] == [SEQUENCE, OCTETS] and len(tags) == 2:
        name = _algorithm(data, parts[0])
        return "pkcs8-encrypted" if name and name.startswith(_PBE) and parts[1][1] < parts[1][2] else None
    if tags[0] != INTEGER or len(first) != 1:
        return None
    if tags[1:3] == [SEQUENCE, OCTETS] and first[0] <= 1 and all(t in (0xA0, 0x81, 0xA1) for t in tags[3:]):
        inner = elements(data, *parts[2][1:])
        return "pkcs8" if _algorithm(data, parts[1]) and inner and len(inner) == 1 else None
    if tags[1] == OCTETS and first[0] == 1 and all(t in (0xA0, 0xA1) for t in tags[2:]):
        fits = all(elements(data, a, b) for _, a, b in parts[2:])
        return "sec1" if fits and parts[1][1] < parts[1][2] else None
    if set(tags) == {INTEGER} and first[0] == 0 and all(a < b for _, a, b in parts):
        return {9: "pkcs1", 6: "dsa"}.get(len(tags))
    if tags[1] == SEQUENCE and first[0] == 3 and set(tags[2:]) <= {SEQUENCE} and _algorithm(data, parts[1]):
        return "pkcs12"
    return None


def openssh_key(text: str, start: int) -> int | None:
    """Where the OpenSSH private key whose base64 starts at ``start`` ends: its length fields, one after another."""
    at, number = len(_OPENSSH), 0
    for field in ("cipher", "kdf", "options", "keys", "public", "private"):
        head, _ = read64(text, start, at + 4)
        if len(head) < at + 4:
            return None
        number = int.from_bytes(head[at:at + 4], "big")
        if field == "keys":
            if number != 1:
                return None
            at += 4
            continue
        if field in ("cipher", "kdf") and not 1 <= number <= 64:
            return None
        at += 4 + number
    data, end = read64(text, start, at)
    if len(data) < at or not _PADDED_END.match(text, end):
        return None
    body = data[at - number:at]
    plain = data[len(_OPENSSH) + 4:].startswith(b"none")
    return end if not plain or len(body) >= 8 and body[:4] == body[4:8] else None


def signed_token(header: str, payload: str) -> str | None:
    """The algorithm of a signed token's header, if header and payload are JSON objects."""
    try:
        head, body = (json.loads(decoded64(p) or b"") for p in (header, payload))
    except (ValueError, RecursionError):
        return None
    name = head.get("alg") if isinstance(head, dict) and isinstance(body, dict) else None
    return name if isinstance(name, str) and name and name.lower() != "none" else None


def structures(text: str, depth: int = DEPTH) -> Iterator[Found]:
    """``(kind, start, end, detail)`` of what decodes to a private key or a signed token."""
    if not _LONG_RUN.search(text):
        return
    done = 0
    for m in _KEY_START.finditer(text):
        if m.start() < done:
            continue
        start, name, end = m.start(), None, None
        if m[0][0] == "b":
            end = openssh_key(text, start)
            name = "openssh" if end else None
        else:
            size = der_size(read64(text, start, 12)[0])
            if size:
                data, end = read64(text, start, size)
                name = der_key(data[:size]) if len(data) >= size and _PADDED_END.match(text, end) else None
        if name:
            done = end = _PADDED_END.match(text, end).end()
            yield "key", start, end, name
    for m in _HEX_KEY.finditer(text):
        data = bytes.fromhex(m[0])
        name = der_key(data) if der_size(data[:12]) == len(data) else None
        if name:
            yield "key", *m.span(), f"hex {name}"
    for m in _SIGNED.finditer(text):
        name = signed_token(m[1], m[2])
        if name and decoded64(m[3]):
            yield "jwt", *m.span(), name
    if depth > 1:
        for m in _WRAPPED.finditer(text):
            for wrap, data in (("base64", decoded64(m[0])), ("hex", bytes.fromhex(m[0]) if _ALL_HEX.match(m[0]) else None)):
                if data and data.isascii():
                    inner = next(structures(data.decode("ascii"), depth - 1), None)
                    if inner:
                        yield inner[0], *m.span(), f"{wrap} {inner[3]}"
                        break


def _confirmed(value: str) -> str | None:
    inner = next(structures(value), None)
    return f"{inner[0]} {inner[3]}" if inner else None


def base_spans(text: str) -> Iterator[Found]:
    """The base formats' spans (code points, end exclusive), each with what its value decodes to."""
    for m in _ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= ASSIGN_LENGTH:
            yield "assign", *m.span(), _confirmed(m[2])
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if len(m[0]) >= ACCESS_LENGTH:
                # A well-formed id is 16 base32 digits after the mark.
                yield "access", *m.span(), "key id" if re.fullmatch(r"AKIA[A-Z2-7]{16}", m[0]) else None
    for m in _HEX.finditer(text):
        yield "hex", *m.span(), _confirmed(m[0])


def spans(text: str) -> list[Found]:
    """Every span of the text, by start, then kind as listed in ``KINDS``, then end; none is reported twice."""
    found = {s[:3]: s for s in (*base_spans(text), *structures(text))}
    return sorted(found.values(), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id and ``found``, an array of structs (kind, start, end, detail).

    A NULL or empty text has an empty array; repeated rows and NULL ids give
    a row each; texts of any length are read whole; other columns are not
    read. Spans of different kinds may overlap, those of one kind do not.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    fields = [pa.field("kind", pa.string()), pa.field("start", pa.int64()), pa.field("end", pa.int64()),
              pa.field("detail", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [spans(t) if t else [] for t in batch.column(1).to_pylist()]
            ends = [0]
            for own in rows:
                ends.append(ends[-1] + len(own))
            flat = list(zip(*(s for own in rows for s in own), strict=True)) or [[]] * 4
            parts = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(flat, fields, strict=True)], fields=fields)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts)], names=[id_col, "found"])

    return docs.select(docs[id_col], docs[text_col]).mapInArrow(
        run, f"`{id_col}` {id_type}, found array<struct<kind:string,start:long,end:long,detail:string>>")


def joined(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def summary(found: Column) -> dict[str, Column]:
    """Columns over ``found``: the count of each base kind, the digest of the base spans, all spans as text."""
    def of(*kinds: str) -> Column:
        return F.filter(found, lambda s: s["kind"].isin(*kinds))

    counts = {f"n_{k}": F.size(of(k)).cast("long") for k in BASE_KINDS}
    return {**counts, "base_sha256": F.sha2(joined(of(*BASE_KINDS)), 256), "spans": joined(found)}
