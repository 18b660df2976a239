"""Secret scans with structural confirmation.

Three plain patterns give the base spans. Further candidates are reported only once their structure holds:
base64 or hex that decodes to a private key in DER, whose nested lengths must fill each other exactly, PEM
blocks around such a key or around length-prefixed OpenSSH fields, and signed tokens whose header decodes to
JSON that names an algorithm with a signature as long as that algorithm makes it. What stands beside a key does not
matter: it may begin anywhere in a run of base64 or hex digits, as after an equals sign, a quote or an escaped line
break, and ends where its own lengths say. PEM bodies may have their line breaks and slashes escaped.

Spans are half open and count code points. Null and empty texts have none. Spans of one kind never overlap;
those of different kinds may. Repeated rows are scanned each, a null id stays null, an empty table gives an
empty result, and other columns play no part.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("assign", "access", "hex", "signed_token", "pem_key", "base64_key", "hex_key")
#: The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

TOKEN = re.compile(r"(?:(?<![A-Za-z0-9_-])|(?<=\\[nrt]))(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:(?:\s|\\+[nr])*+[A-Za-z]+(?:-[A-Za-z]+)*+:[^\n\r\\]*+)*+)((?:[A-Za-z0-9+/=\s]++|\\++[nrt/])++)-----END \1-----")
PEM_GAP = re.compile(r"\s+|\\+[nrt]|\\+(?=/)")
PEM_BREAK = re.compile(r"\\+[nr]")
PEM_HEADER = re.compile(r"([A-Za-z-]+):\x20*([^\n\r\\]*)")
#: Of an encrypted key in the older form: the cipher and its first block, in hex.
DEK = re.compile(r"[A-Z0-9]+(?:-[A-Z0-9]+)+,((?:[0-9A-Fa-f]{16}){1,2})\s*")
#: How a key in DER (a sequence with a definite length) or of OpenSSH begins, and the digits that may follow.
BASE64_START, BASE64_RUN = re.compile(r"(?:M[A-I]|b3BlbnNzaC1rZXktdjE)[A-Za-z0-9+/_-]{30}"), re.compile(r"[A-Za-z0-9+/_-]*")
HEX_START, HEX_RUN = re.compile(r"(?:30(?:8[1-4]|[0-7][0-9A-Fa-f])|6[Ff]70656[Ee]7373682[Dd]6[Bb]65792[Dd]763100)[0-9A-Fa-f]{50}"), re.compile(r"[0-9A-Fa-f]*")

#: Bytes of a signature by algorithm; None where they depend on the key.
SIGNATURES = {
    "none": 0, "HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132, "EdDSA": 64,
    "RS256": None, "RS384": None, "RS512": None, "PS256": None, "PS384": None, "PS512": None,
}
OPENSSH = b"openssh-key-v1\0"


def decode64(text: str) -> bytes | None:
    """Bytes of base64 in either alphabet, padded or not; None if it is not that."""
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of the elements that fill ``data`` exactly, or None."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data) or data[at] & 0x1F == 0x1F:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data) or data[at] == 0:
                return None
            size, at = int.from_bytes(data[at : at + n], "big"), at + n
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        out.append((tag, data[at : at + size]))
        at += size
    return out


INTEGER, BITS, OCTETS, OID, SEQUENCE = 2, 3, 4, 6, 0x30


def is_der_key(data: bytes) -> bool:
    """A private key: RSA or DSA integers, an elliptic curve's secret, or either wrapped, plain or encrypted."""
    top = der(data)
    if not top or len(top) != 1 or top[0][0] != SEQUENCE:
        return False
    parts = der(top[0][1])
    if not parts:
        return False
    tags = [t for t, _ in parts]
    named = lambda part: part[0] == SEQUENCE and bool(inner := der(part[1])) and inner[0][0] == OID
    if set(tags) == {INTEGER} and len(tags) in (6, 9):
        return all(c for _, c in parts)
    if tags[:2] == [INTEGER, OCTETS] and parts[0][1] == b"\x01":
        return len(parts[1][1]) in (20, 24, 28, 32, 48, 66)
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS]:
        return named(parts[1])
    return tags == [SEQUENCE, OCTETS] and named(parts[0])


def openssh_size(read: Callable[[int, int], bytes]) -> int | None:
    """Bytes of an OpenSSH key: cipher, key derivation, its options, a count, and as many public keys before one private part, all by length.

    ``read`` gives the bytes between two places, so that only the lengths are decoded.
    """
    if read(0, len(OPENSSH)) != OPENSSH:
        return None
    at, fields, count = len(OPENSSH), 0, None
    while len(head := read(at, at + 4)) == 4:
        size = int.from_bytes(head, "big")
        at += 4
        if fields == 3 and count is None:
            count = size
            continue
        at, fields = at + size, fields + 1
        if count is not None and fields == 3 + count + 1:
            return at
    return None


def is_openssh_key(data: bytes) -> bool:
    """An OpenSSH key and nothing but zeros behind it."""
    size = openssh_size(lambda a, b: data[a:b])
    return size is not None and size <= len(data) and not any(data[size:])


def der_size(head: bytes | None) -> int | None:
    """Bytes of the sequence that begins so, by its length."""
    if not head or len(head) < 2 or head[0] != SEQUENCE:
        return None
    n = head[1] & 0x7F
    if not head[1] & 0x80:
        return 2 + n
    return 2 + n + int.from_bytes(head[2 : 2 + n], "big") if 1 <= n <= 4 and len(head) >= 2 + n else None


def may_hold_key(head: bytes) -> bool:
    """Whether the sequence that begins so has a number or a sequence as its first element, as every key has."""
    at = 2 + (head[1] & 0x7F if head[1] & 0x80 else 0)
    return len(head) > at and head[at] in (INTEGER, SEQUENCE)


def is_key(data: bytes | None) -> bool:
    return data is not None and (is_der_key(data) or is_openssh_key(data))


def unhex(text: str) -> bytes:
    return bytes.fromhex(text[: len(text) & ~1])


def keys(text: str, start: re.Pattern, run: re.Pattern, bits: int, decode: Callable[[str], bytes | None]) -> Iterator[tuple[int, int]]:
    """(start, end) of the keys among digits of ``bits`` bits each; they do not overlap."""
    at = end = 0
    while m := start.search(text, at):
        first, at = m.start(), m.start() + 1
        if first >= end:
            end = run.match(text, first).end()
        digits = lambda size: -(-size * 8 // bits)
        head = decode(text[first : first + digits(9)]) or b""
        size = der_size(head)
        if size is None and head.startswith(OPENSSH[: len(head)]):

            def read(a: int, b: int) -> bytes:  # three bytes are four digits of 6 bits and six of 4
                unit = 24 // bits
                part = text[first + a // 3 * unit : min(first + -(-b // 3) * unit, end)]  # noqa: B023
                while part and (data := decode(part)) is None:
                    part = part[:-1]
                return (data if part else b"")[a % 3 : a % 3 + b - a]

            size = openssh_size(read)
        elif size is not None and not may_hold_key(head):
            continue
        if size is None or first + digits(size) > end:
            continue
        to = first + digits(size)
        if is_key((decode(text[first:to]) or b"")[:size]):
            yield first, to
            at = to


def is_pem_key(headers: str, body: str) -> bool:
    """A key in PEM; one encrypted in the older form is told by its cipher and whole blocks, as its inside cannot be parsed."""
    data, told = decode64(PEM_GAP.sub("", body)), dict(PEM_HEADER.findall(PEM_BREAK.sub("\n", headers)))
    if "DEK-Info" in told:
        first = DEK.fullmatch(told["DEK-Info"])
        return bool(data and first and told.get("Proc-Type", "").strip() == "4,ENCRYPTED" and len(data) % 8 == 0)
    return is_key(data)


def is_signed_token(head: str, body: str, mark: str) -> bool:
    first, second, sign = decode64(head), decode64(body), decode64(mark)
    if first is None or second is None or sign is None:
        return False
    try:
        header, claims = json.loads(first), json.loads(second)
    except (ValueError, RecursionError):
        return False
    if not isinstance(header, dict) or not isinstance(claims, dict) or str(header.get("alg")) not in SIGNATURES:
        return False
    size = SIGNATURES[str(header["alg"])]
    return len(sign) == size if size is not None else len(sign) >= 128


def find(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the secret itself) by start, then by the order of ``KINDS``."""
    out, low = [], text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [("assign", *m.span(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", *m.span(), m.start()) for m in ACCESS.finditer(text)]
    out += [("hex", *m.span(), m.start()) for m in HEX.finditer(text)]
    if "eyJ" in text:
        out += [("signed_token", *m.span(), m.start()) for m in TOKEN.finditer(text) if is_signed_token(*m.groups())]
    if "-----BEGIN" in text:
        out += [("pem_key", *m.span(), m.start()) for m in PEM.finditer(text) if is_pem_key(m[2], m[3])]
    for first, end in keys(text, BASE64_START, BASE64_RUN, 6, decode64):
        most = end + -(end - first) % 4
        while end < most and text[end : end + 1] == "=":
            end += 1
        out.append(("base64_key", first, end, first))
    out += [("hex_key", first, end, first) for first, end in keys(text, HEX_START, HEX_RUN, 4, unhex)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redact(text: str, mark: str = "[REDACTED]") -> str:
    """The text with every secret replaced; of an assignment only the value goes."""
    out, at = [], 0
    for _, _, end, start in sorted(find(text), key=lambda s: s[3]):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPANS = "array<struct<kind: string, start: long, end: long>>"


def spans(text: Column) -> Column:
    """All spans of a text, in order; none for null."""

    @F.arrow_udf(SPANS)
    def run(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b, _ in find(x.as_py() or "")] for x in texts], kind)

    return run(text.cast("string"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id and ``spans`` for every row of ``docs``."""
    return docs.select(F.col(f"`{doc_id}`").alias(doc_id), spans(F.col(f"`{text}`")).alias("spans"))


def redacted(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with the secrets of its texts replaced, and with their new length where there is such a column; null stays null."""

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([redact(x.as_py()) if x.is_valid else None for x in texts], pa.string())

    clean = docs.withColumn(text, run(F.col(f"`{text}`")))
    if length not in docs.columns:
        return clean
    return clean.withColumn(length, F.when(F.col(f"`{text}`").isNull(), F.col(f"`{length}`")).otherwise(F.length(F.col(f"`{text}`")).cast(docs.schema[length].dataType)))
