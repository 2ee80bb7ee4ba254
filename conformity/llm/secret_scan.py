"""Secrets in texts: patterns of assignments and ids, and encoded keys and tokens that their structure confirms.

The base kinds are patterns. ``key`` and ``signed`` are reported only if a candidate decodes and parses:

* A base64 run (plain or url-safe), a hex run or the body of a PEM block is ``key`` if its bytes are a private
  key as a whole: DER whose nested lengths all fill what holds them and that has the members of an RSA, DSA,
  elliptic-curve, PKCS #8, encrypted PKCS #8 or PKCS #12 structure, or an OpenSSH key with fields that fill it.
  Of a legacy encrypted PEM block the headers and whole cipher blocks are checked, which is all that it shows.
* Parts joined by dots are ``signed`` if the first decodes to a JSON object with an algorithm and the others
  have the form that it asks for: a JSON payload and a signature as long as the algorithm makes them, or the
  parts of an encrypted token. A token with algorithm ``none`` is not signed.
* A run that decodes to text which itself holds such a key or token is reported as that, one level deep.

Certificates, public keys and bytes that only look encoded are not reported. Spans are code points with an
exclusive end, by start, then kind; spans of different kinds may overlap, and base spans are never dropped.

Null and empty texts have no spans. Texts of any length are scanned whole in linear time. Every row is
scanned for itself: repeated rows, ids and null ids change nothing. Only doc_id and text are read, so other
columns may have any names. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import claim, prepare

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "key", "signed")
#: The base kinds: pattern, the group whose length counts, and its least length.
PATTERNS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}
#: Candidates. They begin where a run begins and give nothing back, so that long runs take linear time.
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}+={0,2}")
HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{60,}+")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])e[wy][A-Za-z0-9_-]{6,}+(?:\.[A-Za-z0-9_-]*+(?:\.[A-Za-z0-9_-]++){3}|(?:\.[A-Za-z0-9_-]++){2})")
MARKER = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")
PEM_NOISE = re.compile(r"""\\[nrt]|[\s"',]+""")
PEM_HEADER = re.compile(r"^[ \t]*[A-Za-z][A-Za-z0-9-]*:[^\n]*$", re.M)
INTEGER, BITS, OCTETS, OID, SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30
#: Algorithm ids as DER has them.
RSA_ID, DSA_ID, EC_ID = bytes.fromhex("2a864886f70d010101"), bytes.fromhex("2a8648ce380401"), bytes.fromhex("2a8648ce3d0201")
EDWARDS_IDS = {bytes.fromhex("2b656e"): 32, bytes.fromhex("2b656f"): 56, bytes.fromhex("2b6570"): 32, bytes.fromhex("2b6571"): 57}
PASSWORD_IDS = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
PKCS7_IDS = bytes.fromhex("2a864886f70d0107")
#: Bytes of a signature by algorithm; None where the key's size decides.
SIGNATURES = {
    "HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132, "EdDSA": None,
    "RS256": None, "RS384": None, "RS512": None, "PS256": None, "PS384": None, "PS512": None,
}
SPANS = "array<struct<kind string, start int, end int, form string>>"
Member = tuple[int, bytes]


# ---- structures


def members(data: bytes) -> list[Member] | None:
    """Tag and content of the DER values that fill ``data`` exactly, or None."""
    out, at, end = [], 0, len(data)
    while at < end:
        if at + 2 > end or data[at] & 31 == 31:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 128:
            k = size & 127
            if not 1 <= k <= 4 or at + k > end:
                return None
            size, at = int.from_bytes(data[at : at + k]), at + k
            if size < 128 or size >> 8 * (k - 1) == 0:  # DER has the shortest form only
                return None
        if at + size > end:
            return None
        out.append((tag, data[at : at + size]))
        at += size
    return out


def _tags(of: list[Member]) -> list[int]:
    return [tag for tag, _ in of]


def _number(value: bytes) -> int:
    return int.from_bytes(value, signed=True)


def _sequence(data: bytes) -> list[Member] | None:
    """The members of the one sequence that ``data`` is."""
    outer = members(data) if data[:1] == b"\x30" else None
    return members(outer[0][1]) if outer and len(outer) == 1 else None


def _rsa(of: list[Member]) -> bool:
    if len(of) not in (9, 10) or _tags(of[:9]) != [INTEGER] * 9:
        return False
    version, n, e, d, p, q, dp, dq, inverse = (_number(v) for _, v in of[:9])
    # 10 members: further primes
    return version == len(of) - 9 and n.bit_length() >= 256 and min(e, d, p, q, dp, dq, inverse) > 0 and (version == 1 or p * q == n)


def _dsa(of: list[Member]) -> bool:
    if _tags(of) != [INTEGER] * 6:
        return False
    version, p, q, g, y, x = (_number(v) for _, v in of)
    return version == 0 and p.bit_length() >= 512 and q.bit_length() >= 160 and 0 < x < q and 0 < g < p and 0 < y < p


def _elliptic(of: list[Member]) -> bool:
    if _tags(of[:2]) != [INTEGER, OCTETS] or _number(of[0][1]) != 1 or not 16 <= len(of[1][1]) <= 66:
        return False
    inner = [members(v) for _, v in of[2:]]
    allowed = ([], [0xA0], [0xA1], [0xA0, 0xA1])
    return _tags(of[2:]) in allowed and all(m and len(m) == 1 for m in inner)


def _inner_key(algorithm: bytes, data: bytes) -> bool:
    held = members(data)
    if held is None or len(held) != 1:
        return False
    tag, value = held[0]
    if algorithm in EDWARDS_IDS:
        return tag == OCTETS and len(value) == EDWARDS_IDS[algorithm]
    if algorithm == DSA_ID:
        return tag == INTEGER and _number(value) > 0
    of = members(value) if tag == SEQUENCE else None
    if algorithm == RSA_ID:
        return of is not None and _rsa(of)
    if algorithm == EC_ID:
        return of is not None and _elliptic(of)
    return True  # an algorithm not known here, in the right structure


def der_form(data: bytes) -> str | None:
    """What kind of private key DER bytes are as a whole."""
    of = _sequence(data)
    if not of:
        return None
    tags = _tags(of)
    if _rsa(of):
        return "rsa"
    if _dsa(of):
        return "dsa"
    if _elliptic(of):
        return "ec"
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS] and _number(of[0][1]) in (0, 1) and all(t in (0xA0, 0xA1, 0x81) for t in tags[3:]):
        algorithm = members(of[1][1])
        if algorithm and algorithm[0][0] == OID and _inner_key(algorithm[0][1], of[2][1]):
            return "pkcs8"
    if tags == [SEQUENCE, OCTETS] and of[1][1] and len(of[1][1]) % 8 == 0:
        algorithm = members(of[0][1])
        if algorithm and _tags(algorithm) == [OID, SEQUENCE] and algorithm[0][1].startswith(PASSWORD_IDS) and members(algorithm[1][1]):
            return "pkcs8-encrypted"
    if tags in ([INTEGER, SEQUENCE], [INTEGER, SEQUENCE, SEQUENCE]) and _number(of[0][1]) == 3:
        content = members(of[1][1])
        if content and _tags(content) == [OID, 0xA0] and content[0][1].startswith(PKCS7_IDS) and members(content[1][1]):
            return "pkcs12"
    return None


def _strings(data: bytes) -> list[bytes] | None:
    """The strings with lengths of four bytes before them that fill ``data``."""
    out, at = [], 0
    while at < len(data):
        stop = at + 4 + int.from_bytes(data[at : at + 4])
        if at + 4 > len(data) or stop > len(data):
            return None
        out.append(data[at + 4 : stop])
        at = stop
    return out


def openssh_form(data: bytes) -> str | None:
    magic = b"openssh-key-v1\x00"
    if not data.startswith(magic):
        return None
    at, head = len(magic), []
    for _ in range(3):  # cipher, key derivation and its options
        size = int.from_bytes(data[at : at + 4])
        head.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    count, rest = int.from_bytes(data[at : at + 4]), _strings(data[at + 4 :])
    if at + 4 > len(data) or rest is None or len(rest) != count + 1 or not count or any(not _strings(public) for public in rest[:-1]):
        return None
    private = rest[-1]
    if head[0] != b"none":
        return "openssh-encrypted" if private and len(private) % 8 == 0 else None
    return "openssh" if len(private) >= 8 and private[:4] == private[4:8] else None


def decoded(run: str) -> bytes | None:
    """The bytes of a base64 run in either alphabet, with or without its padding."""
    bare = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(bare) % 4 == 1:
        return None
    try:
        return base64.b64decode(bare + "=" * (-len(bare) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def key_form(data: bytes | None) -> str | None:
    return (der_form(data) or openssh_form(data)) if data else None


def _object(part: str) -> dict[str, Any] | None:
    data = decoded(part)
    try:
        found = json.loads(data) if data and data[:1] == b"{" else None
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def token_form(token: str) -> str | None:
    """The algorithm of a signed or encrypted token whose parts have the form it asks for."""
    parts = token.split(".")
    header = _object(parts[0])
    algorithm = header.get("alg") if header else None
    if not isinstance(algorithm, str):
        return None
    if len(parts) == 5:
        held = [decoded(p) for p in parts[1:]]
        return f"jwe:{algorithm}" if isinstance(header.get("enc"), str) and None not in held and held[2] and held[3] else None
    if len(parts) != 3 or algorithm not in SIGNATURES:
        return None
    signature, size = decoded(parts[2]), SIGNATURES[algorithm]
    fits = signature is not None and (len(signature) == size if size else len(signature) >= 64)
    return f"jwt:{algorithm}" if fits and _object(parts[1]) is not None else None


def _blocks(text: str) -> Iterator[tuple[int, int, str]]:
    """PEM blocks of private keys: start, end and body. An end closes the last beginning of its label."""
    open_at: dict[str, tuple[int, int]] = {}
    for m in MARKER.finditer(text):
        if m[1] == "BEGIN":
            open_at[m[2]] = m.span()
        elif m[2] in open_at:
            start, body = open_at.pop(m[2])
            yield start, m.end(), text[body : m.start()]


def pem_form(body: str) -> str | None:
    headers = PEM_HEADER.findall(body)
    data = decoded(PEM_NOISE.sub("", PEM_HEADER.sub("", body)))
    if data and any("ENCRYPTED" in h for h in headers) and any("DEK-Info" in h for h in headers):
        return "pem-encrypted" if len(data) % 8 == 0 else None
    return key_form(data)


def confirmed(text: str, nested: bool = True) -> list[tuple[str, int, int, str]]:
    """The spans of kind ``key`` and ``signed``."""
    out, covered = [], []
    for start, end, body in _blocks(text):
        if form := pem_form(body):
            out.append(("key", start, end, form))
            covered.append((start, end))
    for m in TOKEN.finditer(text):
        # what follows a signed token behind further dots is not part of it
        for token in dict.fromkeys((m[0], ".".join(m[0].split(".")[:3]))):
            if form := token_form(token):
                out.append(("signed", m.start(), m.start() + len(token), form))
                break
    blocks = iter(sorted(covered))
    block = next(blocks, None)
    for m in RUN.finditer(text):
        while block and block[1] <= m.start():
            block = next(blocks, None)
        if block and block[0] <= m.start():
            continue
        data = decoded(m[0])
        if form := key_form(data):
            out.append(("key", *m.span(), form))
        elif data and nested and data.isascii():
            out += [(kind, *m.span(), f"{form} in base64") for kind, _, _, form in confirmed(data.decode(), False)[:1]]
    for m in HEX_RUN.finditer(text):
        if len(m[0]) % 2 == 0 and (form := key_form(bytes.fromhex(m[0]))):
            out.append(("key", *m.span(), form))
    return out


def secrets_in(text: str | None) -> list[tuple[str, int, int, str]]:
    """All spans (kind, start, end, form) of a text, by start, then kind."""
    if not text:
        return []
    out = [(kind, *m.span(), kind) for kind, (pattern, group, least) in PATTERNS.items() for m in pattern.finditer(text) if len(m[group]) >= least]
    return sorted({*out, *confirmed(text)}, key=lambda s: (s[1], KINDS.index(s[0]), s[2], s[3]))


def _scan(texts: pd.Series) -> pd.Series:
    claim("secrets")
    names = ("kind", "start", "end", "form")
    return pd.Series([[dict(zip(names, s, strict=True)) for s in secrets_in(t)] for t in texts], dtype=object)


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and ``secrets``: the spans of every row's text (kind, start, end, form)."""
    prepare(docs.sparkSession)
    scan = pandas_udf(_scan, SPANS).asNondeterministic()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), scan(F.col("text").cast("string")).alias("secrets"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op12_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    of = lambda *kinds: F.filter("secrets", lambda s: s["kind"].isin(*kinds))
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    base, spans = F.sha2(_listed(of(*BASE)), 256), _listed(F.col("secrets"))
    return found.select("doc_id", *counts, base.alias("base_sha256"), spans.alias("spans"))
