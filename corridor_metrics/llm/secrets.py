"""Secrets in texts: patterns, and encoded material that is confirmed by its structure.

Three kinds are plain patterns. ``assign`` is a name such as ``password`` with a value of at least 8
characters, ``access`` an access key id of at least 16, ``hex`` a run of at least 32 hexadecimal digits.

Two further kinds are reported only after decoding. Candidates are long base64 or hex strings, bare or in
PEM armour, also folded over lines, and words of three or five parts joined by dots.

``key``   the decoded bytes are a private key: a DER value of the forms PKCS#1, PKCS#8 (plain or encrypted), SEC 1 or
          DSA whose nested lengths fill each other exactly, or an OpenSSH key whose nested strings do. Bytes that
          are base64 or PEM again are decoded once more.
``token`` the first part is a JSON header that names an algorithm; of a signed token the second part is a JSON
          object and the signature has the length of that algorithm; of an encrypted one (five parts) the header names the
          content encryption and the last three parts are not empty.

Public keys, certificates, unsigned tokens and random strings are not reported. A span may lie in one of
another kind. Places are in code points; the end is exclusive. Every text is scanned whole in the task
that holds its row; nothing is shuffled.

Defined results: NULL and empty texts have no spans; rows that repeat are reported each; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor_metrics.llm.common import gathered

# Names, prefix and least lengths of the plain patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST = {"assign": 8, "access": 16}
PLAIN = ("assign", "access", "hex")
KINDS = (*PLAIN, "key", "token")

NAMES = ("passw", "secret", "token", "api")
ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9]+ )*PRIVATE KEY-----")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}(?:\r?\n[A-Za-z0-9+/_-]+)*={0,2}")
HEX_BYTES = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{64,}")
DOTTED = re.compile(r"(?<![A-Za-z0-9_.-])e[wy][A-Za-z0-9_-]{6,}(?:\.[A-Za-z0-9_-]*){2,4}(?![A-Za-z0-9_.-])")  # e[wy]: "{" and a quote or blank
LONG = 32  # every hex string, base64 string and token has at least so many characters without a blank
FOLD = re.compile(r"[\r\n]+")
PEM_NOISE = re.compile(rb"-----[^-\n]*-----|^[A-Za-z-]+:[^\n]*$|\s+", re.MULTILINE)

# Length in bytes of the signature, by algorithm; RSA signatures have 128 or more.
SIGNATURES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132, "EdDSA": 64}
RSA_SIGNED = {"RS256", "RS384", "RS512", "PS256", "PS384", "PS512"}
RSA_LEAST = 128

INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30
OPENSSH = b"openssh-key-v1\x00"


# nested lengths


def der_value(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, first and end place of the content of the DER value at ``at``, if it ends by ``end`` and its length is minimal."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if tag & 0x1F == 0x1F:
        return None
    if size >= 0x80:
        width = size & 0x7F
        if not 1 <= width <= 4 or at + width > end:
            return None
        size = int.from_bytes(data[at : at + width], "big")
        if size < 0x80 or size >> (8 * (width - 1)) == 0:
            return None
        at += width
    return (tag, at, at + size) if at + size <= end else None


def der_parts(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The values that fill a content exactly; None if they don't."""
    parts = []
    while at < end:
        value = der_value(data, at, end)
        if value is None:
            return None
        parts.append(value)
        at = value[2]
    return parts


def _integers(data: bytes, parts: list[tuple[int, int, int]]) -> bool:
    """Whether all values are minimal INTEGERs that are not negative."""
    for tag, at, end in parts:
        if tag != INTEGER or at == end or data[at] >= 0x80 or (end - at > 1 and data[at] == 0 and data[at + 1] < 0x80):
            return False
    return True


def _algorithm(data: bytes, value: tuple[int, int, int]) -> bool:
    """Whether a value is an AlgorithmIdentifier: a SEQUENCE that starts with an OID and is well nested."""
    tag, at, end = value
    parts = der_parts(data, at, end) if tag == SEQUENCE else None
    return bool(parts) and parts[0][0] == OID and parts[0][2] > parts[0][1] and len(parts) <= 2


def der_key(data: bytes) -> int:
    """Number of bytes of the private key in DER that ``data`` starts with; 0 if there is none."""
    outer = der_value(data, 0, len(data))
    if outer is None or outer[0] != SEQUENCE:
        return 0
    size = outer[2]
    parts = der_parts(data, outer[1], size)
    if not parts:
        return 0
    tags = [tag for tag, _, _ in parts]
    first = data[parts[0][1] : parts[0][2]]
    if tags[0] == INTEGER and first in (b"\0", b"\1"):
        if len(parts) >= 6 and all(t == INTEGER for t in tags):  # PKCS#1 has nine, DSA six
            return size if len(parts) in (6, 9) and _integers(data, parts) and parts[1][2] - parts[1][1] >= 32 else 0
        if first == b"\1" and tags[1:2] == [OCTETS] and all(t in (0xA0, 0xA1) for t in tags[2:]):  # SEC 1
            inner = [der_parts(data, at, end) for _, at, end in parts[2:]]
            return size if parts[1][2] - parts[1][1] >= 16 and all(inner) else 0
        if len(parts) >= 3 and _algorithm(data, parts[1]) and tags[2] == OCTETS and all(t in (0xA0, 0x81, 0xA1) for t in tags[3:]):  # PKCS#8
            at, end = parts[2][1:]
            nested = der_value(data, at, end)
            whole = nested is not None and nested[2] == end
            if whole and nested[0] == SEQUENCE:
                return size if der_parts(data, nested[1], end) else 0
            return size if whole and nested[0] in (INTEGER, OCTETS) and nested[2] > nested[1] else 0
        return 0
    if len(parts) == 2 and _algorithm(data, parts[0]) and tags[1] == OCTETS and len(der_parts(data, *parts[0][1:])) == 2:  # encrypted PKCS#8
        return size if parts[1][2] - parts[1][1] >= 16 else 0
    return 0


def _strings(data: bytes, at: int, count: int) -> list[tuple[int, int]] | None:
    """Places of ``count`` strings with four bytes of length each."""
    found = []
    for _ in range(count):
        if at + 4 > len(data):
            return None
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if at + size > len(data):
            return None
        found.append((at, at + size))
        at += size
    return found


def openssh_key(data: bytes) -> int:
    """Number of bytes of the OpenSSH private key that ``data`` starts with; 0 if there is none."""
    if not data.startswith(OPENSSH):
        return 0
    head = _strings(data, len(OPENSSH), 3)  # cipher, derivation, its options
    if head is None or head[0][0] == head[0][1]:
        return 0
    at = head[2][1]
    keys = int.from_bytes(data[at : at + 4], "big")
    rest = _strings(data, at + 4, keys + 1) if 1 <= keys <= 64 else None  # public keys, then the private part
    if rest is None:
        return 0
    for first, end in rest[:-1]:
        name = _strings(data[first:end], 0, 1)
        if name is None or not data[first:end][name[0][0] : name[0][1]].isascii() or name[0][0] == name[0][1]:
            return 0
    first, end = rest[-1]
    if end - first < 8 or (data[head[0][0] : head[0][1]] == b"none" and data[first : first + 4] != data[first + 4 : first + 8]):
        return 0  # of an open key both check numbers are equal
    return end


def private_key(data: bytes, again: bool = True) -> int:
    """Number of leading bytes that are a private key in some encoding; 0 if none."""
    size = der_key(data) or openssh_key(data)
    if size or not again:
        return size
    if data.startswith(b"-----BEGIN ") and b"PRIVATE KEY-----" in data[:64]:
        inner = decoded(PEM_NOISE.sub(b"", data).decode("latin-1"))
        return len(data) if inner and private_key(inner, False) else 0
    if len(data) >= 40 and re.fullmatch(rb"[A-Za-z0-9+/_=\r\n-]+", data):
        inner = decoded(FOLD.sub("", data.decode("ascii")))
        return len(data) if inner and private_key(inner, False) else 0
    return 0


def decoded(text: str) -> bytes | None:
    """Bytes of a base64 string of either alphabet, with or without padding; an incomplete last group is left out."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    text = text[: len(text) - (len(text) % 4 == 1)]
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


# candidates


def _json_object(part: str) -> dict | None:
    data = decoded(part)
    if not data or data[:1] != b"{":
        return None
    try:
        value = json.loads(data)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_token(text: str) -> bool:
    """Whether dotted parts are a signed or encrypted JSON web token."""
    parts = text.split(".")
    header = _json_object(parts[0])
    algorithm = header.get("alg") if header else None
    if not isinstance(algorithm, str):
        return False
    if len(parts) == 5:
        return isinstance(header.get("enc"), str) and all(decoded(p) for p in parts[2:])
    if len(parts) != 3 or _json_object(parts[1]) is None:
        return False
    signature = decoded(parts[2]) or b""
    if algorithm in RSA_SIGNED:
        return len(signature) >= RSA_LEAST
    return len(signature) == SIGNATURES.get(algorithm, -1)


def _encoded_end(text: str, at: int, size: int) -> int:
    """Place after the base64 digits of the first ``size`` bytes, and after their padding."""
    digits = -(-size * 8 // 6)
    while digits:
        digits -= text[at] not in "\r\n"
        at += 1
    return at


def has_long_word(text: str) -> bool:
    return max(map(len, text.split()), default=0) >= LONG


def structural_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans of confirmed keys and tokens."""
    armoured = []
    for head in ARMOUR.finditer(text) if "PRIVATE KEY-----" in text else ():
        tail = f"-----END {head.group()[11:]}"
        end = text.find(tail, head.end())
        if end < 0 or (armoured and head.start() < armoured[-1][1]):
            continue
        body = decoded(PEM_NOISE.sub(b"", text[head.end() : end].replace("\\n", "\n").encode()).decode("utf-8", "replace"))
        if body and private_key(body, False):
            armoured.append((head.start(), end + len(tail)))
            yield "key", *armoured[-1]
    if not has_long_word(text):
        return
    inside = iter([*armoured, (len(text) + 1, 0)])
    block = next(inside)
    for m in BASE64.finditer(text):
        while block[1] and block[1] <= m.start():
            block = next(inside)
        if block[0] <= m.start():
            continue
        data = decoded(FOLD.sub("", m.group()))
        size = private_key(data) if data else 0
        if size:
            end = _encoded_end(text, m.start(), size)
            while end < m.end() and text[end] == "=":
                end += 1
            yield "key", m.start(), end
    for m in HEX_BYTES.finditer(text):
        size = private_key(bytes.fromhex(m.group()[: len(m.group()) & ~1]))
        if size:
            yield "key", m.start(), m.start() + 2 * size
    for m in DOTTED.finditer(text):
        if is_token(m.group()):
            yield "token", m.start(), m.end()


def plain_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans of the plain patterns; per kind the leftmost matches that don't overlap, of which short ones are dropped."""
    lower = text.lower()
    for m in ASSIGN.finditer(text) if any(name in lower for name in NAMES) else ():
        if m.end(2) - m.start(2) >= LEAST["assign"]:
            yield "assign", m.start(), m.end()
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= LEAST["access"]:
            yield "access", m.start(), m.end()
    for m in HEX.finditer(text) if has_long_word(text) else ():
        yield "hex", m.start(), m.end()


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text by start, then in the order of ``KINDS``."""
    found = {*plain_spans(text), *structural_spans(text)}
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


PORTION = 4 << 20


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, and ``spans`` (kind, start, end) by start and kind."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(span))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gathered(batches, "text", PORTION):
            found = [[dict(zip(("kind", "start", "end"), s)) for s in spans_of(t)] for t in rows.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id").combine_chunks(), pa.array(found, pa.list_(span))], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(scan, "doc_id long, spans array<struct<kind: string, start: long, end: long>>")
