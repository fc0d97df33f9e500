"""Operator 9 - secrets confirmed by their structure.

Three plain patterns report as they match.  The method then decodes every
base64, base64url or hex run and reports it only if the bytes are built like a
secret: DER private keys whose nested lengths fill the run exactly, OpenSSH
key files, length-prefixed SSH keys, signed tokens whose first part is a JSON
header naming an algorithm, or encoded text that itself holds a plain secret.

One narrow pass: the JVM clears the text of rows that cannot match, so only
candidate rows cross to Python; no shuffle.  Defined results: null and empty
texts hold nothing; repeated rows get equal results; other columns are
ignored; spans are code points, end exclusive, and cover the whole match.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ["assign", "access", "hex", "private_key", "ssh_key", "signed_token", "encoded"]
BASE = KINDS[:3]
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
# any row that could match is let through by this Java pattern; others hold nothing
MAYBE = (r"(?i:password|passwd|secret|token|api_?key)|AKIA[A-Z0-9]{12}|[A-Za-z0-9+/_-]{24}|-----BEGIN"
         r"|[A-Za-z0-9_-]{8}\.[A-Za-z0-9_-]{2,}+\.")
PEM = re.compile(r"-----BEGIN ([A-Z0-9]+ )?PRIVATE KEY-----([A-Za-z0-9+/=\s]{16,}?)-----END ([A-Z0-9]+ )?PRIVATE KEY-----")
RUN = re.compile(r"[A-Za-z0-9+/_-]{24,}={0,2}")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,}+)\.([A-Za-z0-9_-]{2,}+)\.([A-Za-z0-9_-]*)")
HEX_RUN = re.compile(r"(?:[0-9a-f]{2}){12,}|(?:[0-9A-F]{2}){12,}")
NOT_TEXT = re.compile(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F]")  # control characters besides tab and line ends


def _decode(run: str) -> bytes | None:
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


def _tlv(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, body start, body end) of the DER element at ``at``, if it fits."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size & 0x80:
        k = size & 0x7F
        if not 1 <= k <= 4 or at + k > end:
            return None
        size, at = int.from_bytes(data[at:at + k], "big"), at + k
    return (tag, at, at + size) if at + size <= end else None


def _children(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill data[at:end] exactly, or None."""
    out = []
    while at < end:
        x = _tlv(data, at, end)
        if x is None:
            return None
        out.append(x)
        at = x[2]
    return out


def der_private_key(data: bytes) -> bool:
    """PKCS#1, PKCS#8 or SEC1: one SEQUENCE whose lengths nest exactly."""
    top = _tlv(data, 0, len(data))
    if top is None or top[0] != 0x30 or top[2] != len(data):
        return False
    parts = _children(data, top[1], top[2])
    if not parts or parts[0][0] != 0x02:
        return False
    tags = [t for t, _, _ in parts]
    if len(parts) >= 9 and set(tags[:9]) == {0x02}:  # version and eight integers
        return True
    if len(tags) >= 3 and tags[1] == 0x30 and tags[2] == 0x04:  # algorithm, then the key
        algorithm = _children(data, parts[1][1], parts[1][2])
        return bool(algorithm) and algorithm[0][0] == 0x06
    return len(tags) >= 2 and tags[1] == 0x04 and parts[1][2] - parts[1][1] in (28, 32, 48, 66)


def ssh_key(data: bytes) -> bool:
    """An OpenSSH key file, or fields that are each a length and as many
    bytes, the first naming the key type, filling the run exactly."""
    if data.startswith(b"openssh-key-v1\x00"):
        return True
    at, fields = 0, 0
    while at + 4 <= len(data):
        n = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + n > len(data):
            return False
        if fields == 0 and not re.match(rb"ssh-|ecdsa-|sk-", data[4:4 + n]):
            return False
        at, fields = at + 4 + n, fields + 1
    return fields >= 2 and at == len(data)


def signed_token(match: re.Match) -> bool:
    try:
        header = json.loads(_decode(match[1]) or b"")
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and _decode(match[2]) is not None


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= 32]
    return out


def _structure(data: bytes | None) -> str | None:
    """What the bytes are built like, if like a secret.  Text (UTF-8, lines
    and tabs included) is searched as a document is; each decoding shortens
    it, so nested ones end by themselves."""
    if not data:
        return None
    if der_private_key(data):
        return "private_key"
    if ssh_key(data):
        return "ssh_key"
    try:
        inner = data.decode()
    except UnicodeDecodeError:
        return None
    if NOT_TEXT.search(inner):
        return None
    if PEM.search(inner) or any(k != "hex" for _, _, k in base_spans(inner)) or method_spans(inner):
        return "encoded"
    return None


def method_spans(text: str) -> list[tuple[int, int, str]]:
    """Decoded and confirmed runs; a run inside a confirmed longer one of the
    same kind is not reported again."""
    out: list[tuple[int, int, str]] = []
    for m in PEM.finditer(text):
        data = _decode("".join(m[2].split()))
        if data and (der_private_key(data) or ssh_key(data)):
            out.append((m.start(), m.end(), "private_key"))
    out += [(m.start(), m.end(), "signed_token") for m in TOKEN.finditer(text) if signed_token(m)]
    for m in RUN.finditer(text):
        kind = _structure(_decode(m[0]))
        if kind:
            out.append((m.start(), m.end(), kind))
    for m in HEX_RUN.finditer(text):
        kind = _structure(bytes.fromhex(m[0]))
        if kind:
            out.append((m.start(), m.end(), kind))
    kept: list[tuple[int, int, str]] = []
    reach = dict.fromkeys(KINDS, -1)  # earlier starts come first, so the furthest end decides
    for s in sorted(set(out), key=lambda x: (x[0], -x[1], KINDS.index(x[2]))):
        if s[1] > max(reach[s[2]], reach["signed_token"], reach["private_key"]):
            kept.append(s)
            reach[s[2]] = s[1]
    return kept


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1])))


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) per row."""
    empty = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[], [], []]
            digests, spans = [], []
            for text in batch.column(1):
                base = base_spans(s) if (s := text.as_py()) else []
                for c, kind in zip(counts, BASE, strict=True):
                    c.append(sum(k == kind for _, _, k in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest() if base else empty)
                spans.append(joined(base + method_spans(s)) if s else "")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
                 pa.array(spans, pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    candidate = F.when(F.col("text").rlike(MAYBE), F.col("text"))
    return docs.select(F.col("doc_id").cast("long"), candidate.alias("text")).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
