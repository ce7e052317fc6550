"""Operator 2, secret scans with structural confirmation.

Base spans come from three patterns (assignments, access key ids, hex runs).
The method adds spans: candidates in base64 or hex are decoded and reported
only if their bytes parse as a key (ASN.1 with consistent nested lengths, the
length-prefixed private key container, a PEM block) or as a signed token whose
header is JSON with an algorithm.

Spans are code points of the whole match, end exclusive, listed by start and
then by kind in the order of ``KINDS``.  Defined cases: a null text is empty
and has no spans; repeated rows each give a row; other columns are ignored."""

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
from pyspark.sql import types as T

from cartwheel.llm.common import table
from cartwheel.llm.registry import query

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "pem", "der", "openssh", "jwt")

# fixed values: patterns of the base kinds
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run of 16 or more is a whole run: matching is leftmost and greedy

PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----([A-Za-z0-9+/=\s]+?)-----END \1-----")
JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_-])")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/])[bM][A-Za-z0-9+/]{31,}={0,2}")  # how a sequence or the container begins
HEX_ANY = re.compile(r"(?<![0-9A-Fa-f])(?:30|6[fF])[0-9A-Fa-f]{46,}")


def _element(b: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the ASN.1 element at ``at``, in its shortest length form."""
    if at + 2 > end:
        return None
    tag, n, at = b[at], b[at + 1], at + 2
    if n >= 0x80:
        size = n & 0x7F
        if not 1 <= size <= 4 or at + size > end or b[at] == 0:
            return None
        n = int.from_bytes(b[at:at + size], "big")
        if n < 0x80:
            return None
        at += size
    return (tag, at, at + n) if at + n <= end else None


def _children(b: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    out = []
    while at < end:
        x = _element(b, at, end)
        if x is None:
            return None
        out.append(x)
        at = x[2]
    return out


def is_der_key(b: bytes) -> bool:
    """A private or public key as ASN.1: one outer sequence that covers all
    bytes and whose members have the tags and lengths of a known form."""
    outer = _element(b, 0, len(b))
    if not outer or outer[0] != 0x30 or outer[2] != len(b):
        return False
    inner = _children(b, outer[1], outer[2])
    if not inner or len(inner) < 2:
        return False
    tags = [t for t, _, _ in inner]
    if tags[0] == 0x30 and tags == [0x30, 0x03]:  # algorithm, then the public key's bits
        return _is_algorithm(b, inner[0])
    if tags[0] != 0x02 or inner[0][2] - inner[0][1] != 1 or b[inner[0][1]] > 1:  # a version of 0 or 1
        return False
    if len(tags) >= 9 and set(tags[1:9]) == {0x02}:  # modulus, exponents, primes, coefficient
        return all(e > s for _, s, e in inner[1:9])
    if tags[1] == 0x04:  # a private scalar, perhaps with curve and public point
        return inner[1][2] - inner[1][1] in range(16, 67) and all(t in (0xA0, 0xA1) for t in tags[2:])
    if tags[1:3] == [0x30, 0x04]:  # algorithm, then the key as octets
        return _is_algorithm(b, inner[1]) and all(t in (0xA0, 0xA1) for t in tags[3:])
    return len(tags) == 6 and set(tags) == {0x02}  # parameters, public and private number


def _is_algorithm(b: bytes, x: tuple[int, int, int]) -> bool:
    parts = _children(b, x[1], x[2])
    return bool(parts) and parts[0][0] == 0x06


def is_key_container(b: bytes) -> bool:
    """The length-prefixed private key container: names, key count, then keys,
    with every length inside the bytes."""
    magic = b"openssh-key-v1\0"
    if not b.startswith(magic):
        return False
    at = len(magic)

    def take() -> bytes | None:
        nonlocal at
        if at + 4 > len(b):
            return None
        n = int.from_bytes(b[at:at + 4], "big")
        if at + 4 + n > len(b):
            return None
        part, at = b[at + 4:at + 4 + n], at + 4 + n
        return part

    if any(take() is None for _ in range(3)) or at + 4 > len(b):
        return False
    keys, at = int.from_bytes(b[at:at + 4], "big"), at + 4
    if not 1 <= keys <= 64:
        return False
    return all(take() for _ in range(keys)) and bool(take()) and at == len(b)


def _b64(s: str, url: bool = False) -> bytes | None:
    s = re.sub(r"\s", "", s).rstrip("=")
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(b: bytes | None) -> dict | None:
    try:
        x = json.loads(b)
    except (TypeError, ValueError, RecursionError):
        return None
    return x if isinstance(x, dict) else None


def key_kind(b: bytes | None) -> str | None:
    if not b:
        return None
    return "der" if is_der_key(b) else "openssh" if is_key_container(b) else None


def spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all spans, sorted by start and then kind."""
    text = text or ""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    if "-----BEGIN" in text:
        out += [(m.start(), m.end(), "pem") for m in PEM.finditer(text) if key_kind(_b64(m[2]))]
    if "eyJ" in text:
        for m in JWT.finditer(text):
            head = _json_object(_b64(m[1], url=True))
            if head and isinstance(head.get("alg"), str) and _json_object(_b64(m[2], url=True)) is not None \
                    and (bool(m[3]) or head["alg"].lower() == "none"):
                out.append((m.start(), m.end(), "jwt"))
    for m in BASE64.finditer(text):
        kind = key_kind(_b64(m[0]))
        if kind:
            out.append((m.start(), m.end(), kind))
    for m in HEX_ANY.finditer(text):
        kind = key_kind(bytes.fromhex(m[0])) if len(m[0]) % 2 == 0 else None
        if kind:
            out.append((m.start(), m.end(), kind))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(set(out), key=lambda x: (x[0], order[x[2]], x[1]))


def joined(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in found)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and found, an array of (start, end, kind, base)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("txt"))
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                         T.StructField("kind", T.StringType())])
    schema = T.StructType([rows.schema["id"], T.StructField("base_sha256", T.StringType()), T.StructField("found", T.ArrayType(span))])
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            found = [spans(t) for t in b.column(1).to_pylist()]
            sha = [hashlib.sha256(joined([x for x in f if x[2] in BASE]).encode()).hexdigest() for f in found]
            rows = [[{"start": s, "end": e, "kind": k} for s, e, k in f] for f in found]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sha, pa.string()), pa.array(rows, arrow)], ["id", "base_sha256", "found"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def mask(docs: DataFrame, text_col: str = "text", token: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of a text, joined where they overlap, replaced."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            texts = []
            for t in b.column(at).to_pylist():
                last, parts = 0, []
                for s, e, _ in spans(t):
                    if s >= last:
                        parts += [t[last:s], token]
                    last = max(last, e)
                texts.append(t if t is None else "".join([*parts, t[last:]]))
            yield b.set_column(at, b.schema.field(at), pa.array(texts, b.column(at).type))

    return docs.mapInArrow(run, docs.schema)


@query("op2_secrets")
def op2(spark, sf_dir):
    """Secrets of all documents."""
    n = lambda k: F.size(F.filter("found", lambda x: x.kind == k)).cast("long").alias(f"n_{k}")
    text = F.array_join(F.transform("found", lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", *[n(k) for k in BASE], "base_sha256", text.alias("spans"))
