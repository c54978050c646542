"""Secret scans: pattern spans, and spans confirmed by the structure of what they decode to.

Base kinds come from patterns alone. The structural kinds are reported only when the
candidate decodes (base64, hex or base64url) and what it holds parses as a key or as the
header of a signed token: nested lengths must fit exactly, to the last byte.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "pem", "key64", "keyhex", "token")

# The forms of secrets. Letters in either case means ASCII letters only.
ASSIGN = re.compile(
    r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_ASSIGNED = 6
# Longest runs; a run shorter than the limit holds no longer match of the same kind.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LONG_RUN = re.compile(r"[A-Za-z0-9+/_=.-]{20,}")
# Line breaks and signs may be escaped, as in strings of JSON and of source code. Runs of
# backslashes are taken whole and never tried again from within.
ESCAPE = re.compile(r"(?<!\\)\\++(?:[rnt/]|u00[0-9A-Fa-f]{2})")
PEM_MARK = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,64}PRIVATE KEY)-----")
PEM_BODY = re.compile(
    r"(?:[A-Za-z0-9+/=\s:,.\-]|\\++(?:[rnt/]|u00[0-9A-Fa-f]{2}|(?=\s)))*+"
)
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
# Where a key may begin inside a run: a DER sequence, an OpenSSH key or a PEM file. Each
# start is tried; then lines of base64, with their quotes and escapes, count as one run.
KEY_START = re.compile(r"(?=(M[A-I][A-Za-z0-9+/_-]{18}|b3BlbnNzaC1rZXktdjE|LS0tLS1CRUdJTi))")
LINE = re.compile(r"[A-Za-z0-9+/_-]+")
PADS = re.compile(r"={0,2}")
NEXT_LINE = re.compile(
    r"[ \t\"',>]*+(?:\\++[rn]|\\*+\r?\n|\r)(?:[ \t\"',>\r\n]|\\++[rnt])*+(?=[A-Za-z0-9+/_-])|\\+(?=/)"
)
ANY_HEX = re.compile(r"[0-9A-Fa-f]{64,}")
# A token begins with its run of letters, so no run is tried from within.
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{4,}+\.[A-Za-z0-9_-]*")
OPENSSH_MAGIC = b"openssh-key-v1\x00"
# Elements of a sequence that are looked at: no key has more.
MOST_PARTS = 64


def _der(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of each element between two places, or None if lengths don't fit."""
    found = []
    while at < end:
        if at + 2 > end or len(found) == MOST_PARTS:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            count = size & 0x7F
            if not 1 <= count <= 4 or at + count > end:
                return None
            size, at = int.from_bytes(data[at : at + count], "big"), at + count
        if at + size > end:
            return None
        found.append((tag, at, at + size))
        at += size
    return found


def _openssh_head(data: bytes, start: int) -> int | None:
    """Where the number of keys of an OpenSSH key stands; None if it has no such head."""
    at, sizes = start + len(OPENSSH_MAGIC), []
    for _ in range(3):
        sizes.append(int.from_bytes(data[at : at + 4], "big"))
        at += 4 + sizes[-1]
        if at > len(data):
            return None
    return at if sizes[0] and int.from_bytes(data[at : at + 4], "big") >= 1 else None


def is_private_key(data: bytes) -> bool:
    """Whether bytes are a PKCS#1, PKCS#8 (plain or encrypted), SEC1, DSA or OpenSSH key."""
    if data.startswith(OPENSSH_MAGIC):
        return _openssh_head(data, 0) is not None
    outer = _der(data, 0, len(data))
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    parts = _der(data, *outer[0][1:])
    if not parts:
        return False
    tags = [p[0] for p in parts]
    if tags[0] == 0x02 and parts[0][2] - parts[0][1] == 1:
        version = data[parts[0][1]]
        if tags[1:2] == [0x04]:
            return version == 1  # SEC1
        if tags[1:3] == [0x30, 0x04]:
            inner = _der(data, *parts[1][1:])
            return version in (0, 1) and bool(inner) and inner[0][0] == 0x06  # PKCS#8
        # PKCS#1 holds nine integers, a DSA key six.
        return len(tags) in (6, 9, 10) and set(tags[:9]) == {0x02} and version in (0, 1)
    if tags == [0x30, 0x04]:
        inner = _der(data, *parts[0][1:])
        return bool(inner) and inner[0][0] == 0x06  # encrypted PKCS#8
    return False


def _unbase64(text: str) -> bytes | None:
    plain = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _is_token(candidate: str) -> bool:
    """Whether the first part of a dotted candidate is the header of a signed token."""
    header = _unbase64(candidate.split(".", 1)[0])
    if not header or not header.lstrip().startswith(b"{"):
        return False
    try:
        said = json.loads(header)
    except (ValueError, RecursionError):
        return False
    return isinstance(said, dict) and isinstance(said.get("alg"), str)


def _key_size(data: bytes) -> int | None:
    """How many bytes a DER key takes by its head; None if it can't be one."""
    if len(data) < 8 or data[0] != 0x30:
        return None
    count = data[1] & 0x7F if data[1] & 0x80 else 0
    if count > 4 or (data[1] & 0x80 and not count):
        return None
    size = int.from_bytes(data[2 : 2 + count], "big") if count else data[1]
    # A version or a sequence comes first in every kind of key.
    return 2 + count + size if data[2 + count] in (0x02, 0x30) else None


def _openssh_size(data: bytes, start: int) -> int | None:
    """How many bytes an OpenSSH key takes; all there are if its later lengths don't fit."""
    at = _openssh_head(data, start)
    if at is None:
        return None
    # As many public keys as the head says, then the private ones as one string.
    left = int.from_bytes(data[at : at + 4], "big") + 1
    at += 4
    while left and at <= len(data):
        at, left = at + 4 + int.from_bytes(data[at : at + 4], "big"), left - 1
    return min(at, len(data)) - start


class _Run:
    """Base64 characters from a place on, over line breaks, decoded once per alignment."""

    def __init__(self, text: str, start: int) -> None:
        self.starts, self.before, parts, have, at = [], [], [], 0, start
        while m := LINE.match(text, at):
            self.starts.append(at)
            self.before.append(have)
            parts.append(m[0])
            have, at = have + len(m[0]), m.end()
            if not (gap := NEXT_LINE.match(text, at)):
                break
            at = gap.end()
        self.text, self.end, self.size = text, self.starts[-1] + have - self.before[-1], have
        self.chars = "".join(parts)
        self.decoded: dict[int, bytes] = {}
        self.blocks: dict[int, list[tuple[int, int]]] = {}

    def place(self, char: int) -> int:
        """Where the text stands behind so many characters of the run."""
        line = max(0, bisect_left(self.before, char) - 1)
        return self.starts[line] + char - self.before[line]

    def bytes_from(self, start: int) -> tuple[bytes, int, int]:
        """The bytes of the run as a key at a place would read them, and where it begins."""
        line = bisect_right(self.starts, start) - 1
        char = self.before[line] + start - self.starts[line]
        phase = char % 4
        if phase not in self.decoded:
            part = self.chars[phase:]
            self.decoded[phase] = _unbase64(part[: len(part) - (len(part) % 4 == 1)]) or b""
        return self.decoded[phase], (char - phase) // 4 * 3, char

    def pem_from(self, phase: int, at: int) -> int | None:
        """Where the first PEM key from a byte on ends."""
        if phase not in self.blocks:
            said = self.decoded[phase].decode("latin-1")
            self.blocks[phase] = [(a, b) for a, b in _pem_blocks(said)]
        place = bisect_left(self.blocks[phase], (at, 0))
        return self.blocks[phase][place][1] if place < len(self.blocks[phase]) else None

    def key_at(self, start: int) -> int | None:
        """Where a base64 key that begins at a place ends, or None."""
        data, at, char = self.bytes_from(start)
        if self.text.startswith("M", start):
            size = _key_size(data[at : at + 9])
            if size is None or at + size > len(data) or not is_private_key(data[at : at + size]):
                return None
        elif data.startswith(OPENSSH_MAGIC, at):
            size = _openssh_size(data, at)
            if size is None:
                return None
        else:
            end = self.pem_from(char % 4, at)
            if end is None:
                return None
            size = end - at
        end = self.place(char + -(-size * 4 // 3))
        return PADS.match(self.text, end).end()


def _unescaped(body: str) -> str:
    """The body of a PEM block with its escapes undone."""

    def sign(m: re.Match) -> str:
        code = m[0].lstrip("\\")
        return chr(int(code[1:], 16)) if code[0] == "u" else {"/": "/"}.get(code, "\n")

    return ESCAPE.sub(sign, body).replace("\\", "")


def _pem_key(body: str) -> bool:
    body = _unescaped(body)
    lines = [x for x in body.splitlines() if x.strip()]
    if any(":" in x for x in lines):  # Encrypted in the old style: headers, then opaque bytes.
        body = "".join(x for x in lines if ":" not in x)
        data = _unbase64("".join(body.split()))
        return "ENCRYPTED" in "".join(lines) and bool(data) and len(data) % 8 == 0
    data = _unbase64("".join(body.split()))
    return data is not None and is_private_key(data)


def _pem_blocks(text: str) -> list[tuple[int, int]]:
    """(start, end) of PEM keys: each END mark with the last BEGIN mark of its kind before it."""
    found, begun = [], None
    for m in PEM_MARK.finditer(text):
        if m[1] == "BEGIN":
            begun = m
            continue
        if begun and begun[2] == m[2]:
            body = PEM_BODY.match(text, begun.end(), m.start())
            if body.end() == m.start() and _pem_key(body[0]):
                found.append((begun.start(), m.end()))
        begun = None
    return found


def _base64_keys(text: str, pems: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(start, end) of base64 keys outside PEM blocks: whole runs, and starts inside them."""
    taken, k = [], 0
    for m in BASE64.finditer(text):
        while k < len(pems) and pems[k][1] <= m.start():
            k += 1
        if k < len(pems) and pems[k][0] <= m.start():
            continue
        data = _unbase64(m[0])
        if data and is_private_key(data):
            # A first line may pass alone; the key goes on over its other lines.
            end = _Run(text, m.start()).key_at(m.start()) if KEY_START.match(text, m.start()) else 0
            taken.append((m.start(), max(m.end(), end or 0)))
    covered, found, k, free, run = sorted(pems + taken), [], 0, 0, None
    for m in KEY_START.finditer(text):
        start = m.start()
        while k < len(covered) and covered[k][1] <= start:
            k += 1
        if start < free or (k < len(covered) and covered[k][0] <= start):
            continue
        # Starts inside a run share what it decodes to.
        if run is None or start >= run.end:
            run = _Run(text, start)
        end = run.key_at(start)
        if end is not None:
            found.append((start, end))
            free = end
    return found + taken


def spans_of(text: str | None) -> list[tuple[str, int, int]]:
    """Every span of a text: (kind, start, end) in code points, by start, then by kind."""
    if not text:
        return []
    found: list[tuple[str, int, int]] = []
    pems = []
    if "PRIVATE KEY-----" in text:
        pems = _pem_blocks(text)
    found += [("pem", *span) for span in pems]
    small = text.lower()
    if any(word in small for word in ASSIGN_WORDS):
        found += [
            ("assign", m.start(), m.end())
            for m in ASSIGN.finditer(text)
            if len(m[1]) >= MIN_ASSIGNED
        ]
    if LONG_RUN.search(text):
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
        found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
        for m in ANY_HEX.finditer(text):
            if len(m[0]) % 2 == 0 and is_private_key(bytes.fromhex(m[0])):
                found.append(("keyhex", m.start(), m.end()))
        found += [("key64", *span) for span in _base64_keys(text, pems)]
        if "." in text:
            found += [("token", m.start(), m.end()) for m in TOKEN.finditer(text) if _is_token(m[0])]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redacted(text: str | None, spans: list[tuple[str, int, int]], mask: str) -> str | None:
    """The text with every stretch that spans cover replaced by a mask."""
    if text is None or not spans:
        return text
    out, at, covered = [], 0, 0
    for _, start, end in spans:
        if start >= covered:
            out += [text[at:start], mask]
        covered = max(covered, end)
        at = covered
    return "".join([*out, text[at:]])


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, counts per base kind, base_sha256, spans, n_confirmed.

    A null text counts as empty: no spans, and the digest of an empty string. Repeated
    rows are scanned each on its own, a null id is passed through, other columns are
    ignored. Whole texts are scanned. An empty table gives an empty result.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                spans = spans_of(text)
                base = [s for s in spans if s[0] in BASE_KINDS]
                kinds = [s[0] for s in base]
                rows.append(
                    (
                        *(kinds.count(k) for k in BASE_KINDS),
                        hashlib.sha256(_joined(base).encode()).hexdigest(),
                        _joined(spans),
                        len(spans) - len(base),
                    )
                )
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_confirmed"]
            made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(types)]
            # The id passes by as it is, whatever its type and size.
            yield pa.RecordBatch.from_arrays([batch.column("id"), *made], names=["id", *names])

    kind = docs.schema[id_col].dataType.simpleString()
    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(
            scan,
            f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, "
            "spans string, n_confirmed long",
        )
        .withColumnRenamed("id", id_col)
    )


def redact_secrets(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The same rows and columns, with every secret's span in the text replaced by a mask.

    Null texts stay null; rows without secrets stay as they are; `n_chars`, if there is
    such a column, becomes the length of the new text.
    """

    @F.pandas_udf("string")
    def mask_spans(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: redacted(t, spans_of(t), mask), na_action="ignore")

    out = docs.withColumn(text_col, mask_spans(text_col))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length(text_col).cast(kind))
    return out
