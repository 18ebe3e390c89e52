"""Secret scan with structural confirmation.

Base findings come from three patterns. On top of them, runs of base64 and
hex text are decoded and parsed, and reported only when their structure holds:

* ``pem``: an armoured block whose body decodes to a private key encoding, also with headers or with line ends
  written as escapes; a block that its headers say is encrypted must name a cipher, a fitting start vector and
  hold whole cipher blocks;
* ``key``: bare base64 (in one run or wrapped over lines) or hex that decodes to a private key encoding: a DER
  sequence whose nested lengths fill it exactly, or an OpenSSH key container;
* ``jwt``: a signed token whose header is JSON with an ``alg``, whose payload is
  JSON and whose signature decodes.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from contrail.llm.common import id_text, text_slices

# The base patterns. Matches that fail their length are dropped, without a retry.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "pem", "key", "jwt")

PEM = re.compile(r"-----BEGIN ([A-Z ]*)PRIVATE KEY-----((?:[^-]++|-(?!----))*+)-----END \1PRIVATE KEY-----")
LINE_END = r"(?:\r?\n|(?:\\+r)?\\+n)"
ESCAPED_END = re.compile(r"(?:\\+r)?\\+n")
HEADER = re.compile(r"[ \t]*([A-Za-z][A-Za-z0-9-]*):[ \t]*(.*)")
CIPHER = re.compile(r"((?:AES|DES|CAMELLIA|ARIA|SEED|BF|CAST5|IDEA|RC2)[A-Z0-9-]*),([0-9A-Fa-f]+)")
JWT = re.compile(r"(?<![A-Za-z0-9_.-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+(?![A-Za-z0-9_-])")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{44,}={0,2}(?![A-Za-z0-9+/_=-])")
WRAPPED = re.compile(
    rf"(?<![A-Za-z0-9+/_-])((?:[A-Za-z0-9+/]{{40,}}+{LINE_END}[ \t]*+)++)([A-Za-z0-9+/]*+={{0,2}})")
HEX_KEY = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9a-f]{2}){40,}(?![0-9A-Fa-f])|(?<![0-9A-Fa-f])(?:[0-9A-F]{2}){40,}(?![0-9A-Fa-f])")

# DER tags and the magic of an OpenSSH private key.
SEQUENCE, INTEGER, OCTETS, OID = 0x30, 0x02, 0x04, 0x06
OPENSSH_MAGIC = b"openssh-key-v1\0"
NESTING = 8


def decode64(text: str) -> bytes | None:
    """Bytes of standard or URL-safe base64, padded or not; None when it isn't any."""
    text = "".join(text.split()).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(raw: bytes, depth: int = 0) -> list[tuple[int, bytes]] | None:
    """(tag, content) of the values that fill ``raw`` exactly; nested sequences must fill theirs too."""
    items, at = [], 0
    while at < len(raw):
        if at + 2 > len(raw):
            return None
        tag, n, at = raw[at], raw[at + 1], at + 2
        if n & 0x80:
            k = n & 0x7F
            if not 1 <= k <= 4 or at + k > len(raw):
                return None
            n, at = int.from_bytes(raw[at:at + k], "big"), at + k
            if n < 0x80:
                return None
        if at + n > len(raw):
            return None
        body, at = raw[at:at + n], at + n
        if tag in (SEQUENCE, 0x31) and (depth >= NESTING or der_items(body, depth + 1) is None):
            return None
        items.append((tag, body))
    return items


def is_private_key(raw: bytes) -> bool:
    """Whether the bytes are a PKCS#1, SEC1, PKCS#8 (plain or encrypted) or OpenSSH private key."""
    if raw.startswith(OPENSSH_MAGIC):
        return _openssh_fills(raw)
    top = der_items(raw)
    if not top or len(top) != 1 or top[0][0] != SEQUENCE:
        return False
    inner = der_items(top[0][1])
    tags = [t for t, _ in inner]
    if tags[:1] == [INTEGER] and len(inner[0][1]) == 1:
        version = inner[0][1][0]
        if version in (0, 1) and len(tags) >= 9 and set(tags[1:9]) == {INTEGER} and len(inner[1][1]) >= 32:
            return True  # RSA: version and eight numbers
        if version == 0 and len(tags) == 6 and set(tags) == {INTEGER} and len(inner[1][1]) >= 64:
            return True  # DSA
        if version == 1 and tags[1:2] == [OCTETS] and len(inner[1][1]) >= 16 and all(t & 0xE0 == 0xA0 for t in tags[2:]):
            return True  # elliptic curve
        if version in (0, 1) and tags[1:3] == [SEQUENCE, OCTETS] and len(inner[2][1]) >= 16:
            return [t for t, _ in der_items(inner[1][1])][:1] == [OID]  # PKCS#8
    # encrypted PKCS#8: algorithm, then the sealed key
    return tags == [SEQUENCE, OCTETS] and len(inner[1][1]) >= 32 and [t for t, _ in der_items(inner[0][1])][:1] == [OID]


def _openssh_fills(raw: bytes) -> bool:
    """Cipher, key derivation, options, number of keys, that many public keys, sealed private part: nothing left."""
    at = len(OPENSSH_MAGIC)

    def text(at: int) -> int:
        if at + 4 > len(raw):
            return len(raw) + 1
        return at + 4 + int.from_bytes(raw[at:at + 4], "big")

    for _ in range(3):
        at = text(at)
    if at + 4 > len(raw):
        return False
    n, at = int.from_bytes(raw[at:at + 4], "big"), at + 4
    if not 1 <= n <= 64:
        return False
    for _ in range(n + 1):
        at = text(at)
    return at == len(raw)


def is_sealed_key(headers: dict[str, str], raw: bytes) -> bool:
    """Whether an encrypted armoured key names its cipher, with a start vector of a block, and holds whole blocks."""
    named = CIPHER.fullmatch(headers.get("dek-info", "").strip())
    if not named or len(named[2]) not in (16, 32):
        return False
    return len(raw) >= 64 and len(raw) % (len(named[2]) // 2) == 0


def is_armoured_key(body: str) -> bool:
    """Whether the text between the armour lines is a key: optional headers, then base64. Escaped line ends are line ends."""
    lines = ESCAPED_END.sub("\n", body).strip().splitlines()
    headers: dict[str, str] = {}
    at, last = 0, ""
    while at < len(lines):
        line = lines[at].strip("\"'")
        if m := HEADER.fullmatch(line):
            last = m[1].lower()
            headers[last] = m[2]
        elif headers and line[:1] in (" ", "\t"):
            headers[last] += line.strip()
        else:
            break
        at += 1
    raw = decode64("".join(line.strip().strip("\"',;") for line in lines[at:]))
    if not raw:
        return False
    sealed = "encrypted" in headers.get("proc-type", "").lower()
    return is_sealed_key(headers, raw) if sealed else is_private_key(raw)


def wrapped_keys(text: str) -> list[tuple[int, int]]:
    """Where base64 wrapped over lines is a key. The words after the last line end may or may not belong to it."""
    found = []
    for m in WRAPPED.finditer(text):
        whole = ESCAPED_END.sub("\n", m[1]).rstrip()
        for body, end in ((whole + m[2], m.end()), (whole, m.start() + len(re.sub(rf"{LINE_END}[ \t]*\Z", "", m[1])))):
            if (raw := decode64(body)) and is_private_key(raw):
                found.append((m.start(), end))
                break
    return found


def is_signed_token(text: str) -> bool:
    head, body, signature = map(decode64, text.split("."))
    if not head or not body or not signature:
        return False
    try:
        head, body = json.loads(head), json.loads(body)
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and head["alg"].lower() != "none" and isinstance(body, dict)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    return [
        *(("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6),
        *(("access", *m.span()) for m in ACCESS.finditer(text)),
        *(("hex", *m.span()) for m in HEX.finditer(text)),
    ]


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans whose decoded structure proves them; none lies inside another."""
    found = [("pem", *m.span()) for m in PEM.finditer(text) if is_armoured_key(m[2])]
    found += [("jwt", *m.span()) for m in JWT.finditer(text) if is_signed_token(m[0])]
    taken = [(a, b) for _, a, b in found]
    wrapped = [(a, b) for a, b in wrapped_keys(text) if not any(x <= a < y for x, y in taken)]
    found += [("key", a, b) for a, b in wrapped]
    taken += wrapped
    for pattern, decode in ((BASE64, decode64), (HEX_KEY, bytes.fromhex)):
        for m in pattern.finditer(text):
            if not any(a <= m.start() < b for a, b in taken) and (raw := decode(m[0])) and is_private_key(raw):
                found.append(("key", *m.span()))
                taken.append(m.span())
    return found


def digest_text(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end by start, then kind as listed, joined by commas."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_confirmed.

    Counts and digest are of the base findings; ``spans`` holds those and the
    structurally confirmed ones. Positions are code points, ends exclusive. A null
    text counts as empty and has no findings. Repeated rows give a row each.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            out: list[list] = [[] for _ in range(6)]
            for text in pc.fill_null(part.column("text"), "").to_pylist():
                base, more = base_spans(text), confirmed_spans(text)
                kinds = [k for k, _, _ in base]
                row = [*(kinds.count(k) for k in KINDS[:3]), hashlib.sha256(digest_text(base).encode()).hexdigest(), digest_text(base + more), len(more)]
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *map(pa.array, out, types)],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_confirmed"])

    return id_text(docs).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_confirmed long")
