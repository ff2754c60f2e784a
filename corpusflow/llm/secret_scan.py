"""Secrets in texts: patterns, and encoded keys or tokens whose structure holds.

Base kinds are matched by pattern: ``assign``, ``access`` and ``hex``.  Candidates in base64
or hex are decoded and parsed, and reported only if their structure holds to the last byte.
A candidate may begin anywhere, also behind other letters; its first bytes must be those of a
key, and its nested lengths say where it ends, so that nothing behind it matters:

* ``der``: nested lengths of a private key (RSA, PKCS#8 or EC) in base64 or hex, in one
  piece or in the lines of a PEM block, indented or with line ends written as ``\\n``;
* ``ssh``: an ``openssh-key-v1`` blob whose length-prefixed fields fit, in pieces likewise;
* ``token``: a signed token, of which the header is JSON with an algorithm, the payload
  JSON, and the signature as long as the algorithm says.

Null texts count as empty: no spans, digests of the empty string.  Positions are code
points, ends exclusive.  Overlapping spans of different kinds are all reported.  Rows are
judged one by one, so repeated rows and ids make no difference.  Columns beside ``doc_id`` and
``text`` may have any names.  Very long texts are searched whole, in time proportional to their
length; an encoded key has ``MOST_BYTES`` at most.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "der", "ssh", "token")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_HINTS = ("passw", "secret", "token", "api_key", "apikey")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Where a key may begin, found also inside longer runs: a sequence tag, its length and the tag of the version number.
HEX_START = re.compile(r"(?=30(?:[0-7][0-9A-Fa-f]|81..|82.{4}|83.{6})020100|30(?:[0-7][0-9A-Fa-f]|81..|82.{4}|83.{6})020101)")
HEX_DIGITS = re.compile(r"[0-9A-Fa-f]*+")
DER_START = re.compile(r"(?=M[A-P][A-Za-z0-9+/_-]{14})")
SSH_START = "b3BlbnNzaC1rZXktdjEA"
LETTERS = re.compile(r"[A-Za-z0-9+/_-]++")
#: What may part the pieces of one key: white space, line ends written out, quotes and what joins strings.
BETWEEN = re.compile(r"""(?:[\s"'+,]|\\[nrt])*+""")
MOST_BYTES = 1 << 16
#: Three runs of letters with dots between, from every run on; a run is never entered in its middle.
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(?=([A-Za-z0-9_-]++)\.([A-Za-z0-9_-]++)\.([A-Za-z0-9_-]*+))")
TOKEN_START = re.compile(r"(?=e[wy][A-Za-z0-9_-]{10})")
JSON_START = re.compile(rb'\{\s*"[A-Za-z]')

#: Signature bytes of the registered signing algorithms; None: any length above 127.
SIGNATURE_BYTES = {
    "HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132, "EdDSA": 64,
    "RS256": None, "RS384": None, "RS512": None, "PS256": None, "PS384": None, "PS512": None, "none": 0,
}
SSH_MAGIC = b"openssh-key-v1\0"


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """``(tag, content)`` of consecutive DER values that fill ``data`` exactly, else None."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, length, at = data[at], data[at + 1], at + 2
        if length >= 0x80:
            size = length & 0x7F
            if not 1 <= size <= 4 or at + size > len(data):
                return None
            length, at = int.from_bytes(data[at : at + size], "big"), at + size
            if length < 0x80:
                return None
        if at + length > len(data):
            return None
        items.append((tag, data[at : at + length]))
        at += length
    return items


def is_key_der(data: bytes) -> bool:
    """Whether ``data`` is one private key: a sequence with the fields of a known layout."""
    outer = der_items(data) if data[:1] == b"\x30" else None
    if outer is None or len(outer) != 1:
        return False
    parts = der_items(outer[0][1])
    if not parts or parts[0][0] != 0x02 or len(parts[0][1]) != 1:
        return False
    tags = [tag for tag, _ in parts]
    if tags[:9] == [0x02] * 9 and all(content for _, content in parts):  # RSA: version and eight numbers
        return True
    if tags[:3] == [0x02, 0x30, 0x04]:  # PKCS#8: version, algorithm, key
        algorithm = der_items(parts[1][1])
        return bool(algorithm) and algorithm[0][0] == 0x06 and len(parts[2][1]) >= 16
    if tags[:2] == [0x02, 0x04] and parts[0][1] == b"\x01":  # EC: version, key, named curve
        return len(parts[1][1]) >= 16 and all(tag in (0xA0, 0xA1) and der_items(content) for tag, content in parts[2:])
    return False


def ssh_length(data: bytes) -> int | None:
    """Bytes of the private key of length-prefixed fields that begins ``data``, else None."""
    if not data.startswith(SSH_MAGIC):
        return None
    at = len(SSH_MAGIC)

    def after(at: int) -> int | None:
        end = at + 4 + int.from_bytes(data[at : at + 4], "big")
        return end if at + 4 <= len(data) and end <= len(data) else None

    for k in range(3):  # cipher, key derivation, its options
        begin, end = at, after(at)
        if end is None or (not k and end == begin + 4):
            return None
        at = end
    count, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    if not 1 <= count <= 64:
        return None
    for _ in range(count + 1):  # public keys, then the private part
        if (end := after(at)) is None:
            return None
        at = end
    return at


def der_length(head: bytes) -> int | None:
    """Bytes of the private key that may begin with ``head``, of which some bytes suffice, else None."""
    if len(head) < 6 or head[0] != 0x30:
        return None
    size = head[1] & 0x7F if head[1] >= 0x80 else 0
    if size > 3 or head[1] == 0x80 or head[2 + size : 4 + size] != b"\x02\x01" or head[4 + size] > 1:
        return None
    total = 2 + size + (int.from_bytes(head[2 : 2 + size], "big") if size else head[1])
    return total if total <= MOST_BYTES else None


def decoded(text: str) -> bytes | None:
    """Base64 of either alphabet, with or without padding and line ends."""
    plain = text.replace("\r", "").replace("\n", "").rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (ValueError, binascii.Error):
        return None


def is_signed_token(text: str) -> bool:
    """Whether ``header.payload.signature`` holds JSON, JSON and as many bytes as the algorithm signs."""
    header, payload, signature = (decoded(part) for part in text.split("."))
    if header is None or payload is None or signature is None:
        return False
    try:
        head, body = json.loads(header), json.loads(payload)
    except (ValueError, RecursionError):
        return False
    if not isinstance(head, dict) or not isinstance(body, dict) or not isinstance(head.get("alg"), str):
        return False
    if head["alg"] not in SIGNATURE_BYTES:
        return False
    size = SIGNATURE_BYTES[head["alg"]]
    return len(signature) >= 128 if size is None else len(signature) == size


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` by pattern; matches are found first and short ones dropped then."""
    found = []
    low = text.lower()
    if any(hint in low for hint in ASSIGN_HINTS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def _collected(text: str, at: int, need: int) -> tuple[str, list[tuple[int, int]]]:
    """Up to ``need`` base64 letters from ``at`` on, and ``(letters before, place)`` of the pieces they come in."""
    out, places, have = [], [], 0
    while have < need and (m := LETTERS.match(text, at, at + need - have)):
        out.append(m[0])
        places.append((have, at))
        have += len(m[0])
        at = BETWEEN.match(text, m.end()).end()
    return "".join(out), places


def _base64_end(text: str, places: list[tuple[int, int]], letters: int) -> int:
    """Place behind so many letters of a collected key, and its padding."""
    before, place = next(p for p in reversed(places) if p[0] < letters)
    end = place + letters - before
    while end < len(text) and text[end] == "=" and letters % 4:
        end, letters = end + 1, letters + 1
    return end


def _der_spans(text: str) -> Iterator[tuple[int, int, str]]:
    done = 0
    for m in DER_START.finditer(text):
        at = m.start()
        total = der_length(decoded(text[at : at + 16]) or b"") if at >= done else None
        if total is None:
            continue
        need = -(-total * 4 // 3)
        letters, places = _collected(text, at, need)
        if len(letters) == need and is_key_der((decoded(letters) or b"")[:total]):
            done = _base64_end(text, places, need)
            yield at, done, "der"


def _ssh_spans(text: str) -> Iterator[tuple[int, int, str]]:
    at = text.find(SSH_START)
    while at >= 0:
        head = decoded(_collected(text, at, 28)[0]) or b""
        # the name of a cipher comes first
        named = len(head) == 21 and 1 <= int.from_bytes(head[15:19], "big") <= 255
        letters, places = _collected(text, at, MOST_BYTES * 4 // 3 if named else 0)
        total = ssh_length(decoded(letters[: len(letters) // 4 * 4] if len(letters) % 4 == 1 else letters) or b"")
        end = at + 1 if total is None else _base64_end(text, places, -(-total * 4 // 3))
        if total is not None:
            yield at, end, "ssh"
        at = text.find(SSH_START, end)


def _hex_spans(text: str) -> Iterator[tuple[int, int, str]]:
    done = 0
    for m in HEX_START.finditer(text):
        at = m.start()
        head = HEX_DIGITS.match(text, at, at + 16)[0]
        total = der_length(bytes.fromhex(head)) if at >= done and len(head) == 16 else None
        if total is None:
            continue
        digits = HEX_DIGITS.match(text, at, at + 2 * total)[0]
        if len(digits) == 2 * total and is_key_der(bytes.fromhex(digits)):
            done = at + 2 * total
            yield at, done, "der"


def _token_spans(text: str) -> Iterator[tuple[int, int, str]]:
    for m in TOKEN.finditer(text):
        for start in TOKEN_START.finditer(m[1]):
            at = m.start() + start.start()
            # twelve letters show whether an object begins here
            if JSON_START.match(decoded(text[at : at + 12]) or b"") and is_signed_token(text[at : m.end(3)]):
                yield at, m.end(3), "token"
                break


def structural_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of encoded keys and signed tokens."""
    found = [*_hex_spans(text), *_der_spans(text), *_ssh_spans(text)]
    return [*found, *_token_spans(text)] if "." in text else found


def digest(spans: list[tuple[int, int, str]]) -> str:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_structural`` for every row of ``docs(doc_id, text)``."""
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_structural long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1):
                text = value.as_py() or ""
                base, more = base_spans(text), structural_spans(text)
                counts = [sum(k == kind for _, _, k in base) for kind in BASE_KINDS]
                rows.append((*counts, hashlib.sha256(digest(base).encode()).hexdigest(), digest(base + more), len(more)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], [x.split()[0] for x in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, schema)


def redacted(text: str) -> str:
    """The text with every span, and overlapping ones together, replaced by ``[SECRET]``."""
    out, at = [], 0
    for start, end, _ in sorted(base_spans(text) + structural_spans(text)):
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets replaced in ``text`` and ``n_chars`` to match; other columns and all rows stay."""

    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else redacted(t))

    out = docs.withColumn("text", F.pandas_udf(clean, "string")("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
