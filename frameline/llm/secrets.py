"""Secret scan with structural confirmation.

Base kinds are patterns (see :func:`base_spans`): ``assign``, ``access``, ``hex``. The other kinds are candidates that
are reported only after their inside has been taken apart:

* ``signed``: three base64url parts of which the first two decode to JSON objects and the first names an ``alg``;
* ``sshkey``: base64 that decodes to ``openssh-key-v1`` or to length-prefixed fields which start with a known key type
  and fill the data exactly;
* ``derkey``: base64 or hex that decodes to one DER sequence whose nested lengths fill it exactly and that holds an
  integer or object identifier as a key or its algorithm does;
* ``pem``: a ``-----BEGIN ... KEY-----`` block whose body decodes to one of the two forms above, or that is marked as
  encrypted.

Spans are code points, end exclusive. Null text is empty; repeated rows give repeated rows; other columns are ignored.
The scan is one narrow pass over whole texts.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameline.llm.common import fresh, texts

# The base patterns, the kinds in their order, and key types.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "pem", "signed", "sshkey", "derkey")
KEY_TYPES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-nistp256", b"ecdsa-sha2-nistp384", b"ecdsa-sha2-nistp521")

_NAMES = ("password", "passwd", "secret", "token", "api")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*KEY)-----(.{1,20000}?)-----END \1-----", re.S)
_SIGNED = re.compile(r"(?<![A-Za-z0-9_.-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_-])")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/_-]{40,}={0,2}")
_HEX_KEY = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-fA-F]{2}){32,}(?![0-9A-Za-z])")


def base_spans(text: str) -> Iterator[tuple[int, int, str]]:
    """Leftmost matches per kind, none overlapping; those that are too short are used up and dropped."""
    folded = text.lower()
    if any(name in folded for name in _NAMES):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 8:
                yield m.start(), m.end(), "assign"
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= 16:
                yield m.start(), m.end(), "access"
    for m in HEX.finditer(text):
        yield m.start(), m.end(), "hex"


def unbase64(text: str) -> bytes | None:
    """Bytes of base64 in either alphabet, with or without padding; None if it is none."""
    body = text.rstrip("=")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body.translate({45: 43, 95: 47}) + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def signed_token(header: str, payload: str) -> bool:
    for part, needs in ((header, "alg"), (payload, None)):
        data = unbase64(part)
        try:
            got = json.loads(data) if data else None
        except (ValueError, RecursionError):
            return False
        if not isinstance(got, dict) or needs and not isinstance(got.get(needs), str):
            return False
    return True


def ssh_key(data: bytes) -> bool:
    if data.startswith(b"openssh-key-v1\0"):
        return True
    fields, at = [], 0
    while at + 4 <= len(data):
        size = int.from_bytes(data[at : at + 4], "big")
        if size > len(data) - at - 4:
            return False
        fields.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return at == len(data) and len(fields) > 1 and fields[0] in KEY_TYPES


def der_items(data: bytes, depth: int = 0) -> list[tuple[int, bytes]] | None:
    """Tag and content of the elements that fill ``data`` exactly; None if lengths do not fit. Sequences are entered."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size >= 0x80:
            count = size & 0x7F
            if not 1 <= count <= 4 or at + count > len(data):
                return None
            size = int.from_bytes(data[at : at + count], "big")
            at += count
        if size > len(data) - at:
            return None
        inside = data[at : at + size]
        if tag == 0x30 and depth < 16 and der_items(inside, depth + 1) is None:
            return None
        items.append((tag, inside))
        at += size
    return items


def der_key(data: bytes) -> bool:
    """A key: SEQUENCE of (version INTEGER, ...) or of (algorithm SEQUENCE with an identifier, BIT STRING)."""
    outer = der_items(data) if len(data) >= 24 and data[0] == 0x30 else None
    if not outer or len(outer) != 1:
        return False
    inner = der_items(outer[0][1]) or []
    tags = [t for t, _ in inner]
    if tags[:1] == [0x02]:
        return len(tags) >= 2 and (sum(t == 0x02 for t in tags) >= 2 or 0x04 in tags)
    if tags[:2] == [0x30, 0x03]:
        return (der_items(inner[0][1]) or [(0, b"")])[0][0] == 0x06
    return False


def _key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    return "sshkey" if ssh_key(data) else "derkey" if der_key(data) else None


def confirmed_spans(text: str) -> Iterator[tuple[int, int, str]]:
    """Candidates whose structure holds."""
    if "-----BEGIN" in text:
        for m in _PEM.finditer(text):
            body = m[2]
            if "ENCRYPTED" in m[1] or "Proc-Type: 4,ENCRYPTED" in body or _key_kind(unbase64("".join(body.split()))):
                yield m.start(), m.end(), "pem"
    if "." in text:
        for m in _SIGNED.finditer(text):
            if m[1].startswith(("ey", "ew", "e3")) and signed_token(m[1], m[2]):  # a JSON object starts with a brace
                yield m.start(), m.end(), "signed"
    for m in _BASE64.finditer(text):
        if kind := _key_kind(unbase64(m[0])):
            yield m.start(), m.end(), kind
    for m in _HEX_KEY.finditer(text):
        if kind := _key_kind(bytes.fromhex(m[0])):
            yield m.start(), m.end(), kind


def spans(text: str) -> list[tuple[int, int, str]]:
    """All spans by start, then kind in the order of ``KINDS``, then end."""
    return sorted({*base_spans(text), *confirmed_spans(text)}, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def listed(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def redact(text: str, mark: str = "[SECRET]") -> str:
    """``text`` with every run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    merged: list[list[int]] = []
    for start, end, _ in spans(text):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    for start, end in merged:
        out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key``, counts of the base kinds, digest of the base spans, and ``spans`` with all of them."""
    base = KINDS[:3]

    def run(batches):
        for batch in batches:
            rows = [spans(t) for t in batch["text"]]
            own = [[s for s in r if s[2] in base] for r in rows]
            counts = {f"n_{k}": [sum(s[2] == k for s in r) for r in own] for k in base}
            yield pd.DataFrame({
                key: batch[key], **counts,
                "base_sha256": [hashlib.sha256(listed(r).encode()).hexdigest() for r in own],
                "spans": [listed(r) for r in rows],
            })

    return texts(docs, key).mapInPandas(run, f"{key} long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets replaced in ``text`` and ``n_chars`` counted anew where the text has changed; null text stays."""

    @F.pandas_udf("string")
    def clean(column: pd.Series) -> pd.Series:
        return column.map(redact, na_action="ignore")

    masked = fresh(docs, "_clean")
    new = docs.withColumn(masked, clean(F.col("text")))
    changed = ~F.col(masked).eqNullSafe(F.col("text"))
    shown = {"text": F.col(masked), "n_chars": F.when(changed, F.length(masked).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))}
    return new.select(*[shown.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
