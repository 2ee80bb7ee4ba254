"""Whitening, secret scans and resampling: brute force and awkward rows."""

import base64
import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conformity.llm import resampling, secret_scan, whitening

from .helpers import CLASH, awkward, docs_frame

# ---- whitening


def brute_whitening(vectors):
    """n, exact deviations, and the whitening of numpy for (vec_id, vector) pairs; vectors may be unusable."""
    usable = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in usable}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = np.array([[float(n * x - s) / n for x, s in zip(row, sums, strict=True)] for row in fit])
    covariance = centred.T @ centred / n
    values, vectors_ = np.linalg.eigh(covariance)
    deviations = Counter((i, sum((n * x - s) ** 2 for x, s in zip(row, sums, strict=True))) for i, row in usable)
    rows = {(i, tuple(x)): np.array([float(n * a - s) / n for a, s in zip(x, sums, strict=True)]) for i, x in usable}
    return n, deviations, values[::-1], vectors_[:, ::-1], rows, np.trace(covariance)


def vectors_frame(spark, rows, clash=False):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    return df.withColumns({c: F.lit("7").cast(t) for c, t in (CLASH | {"x": "int", "component": "string"}).items()}) if clash else df


@pytest.mark.parametrize(("d", "clash"), [(40, False), (5, True)])
def test_whitening_matches_brute_force(spark, d, clash):
    rng = np.random.default_rng(d)
    mix = rng.normal(size=(d, d))
    held = [(i, [float(np.float32(c)) for c in rng.normal(size=d) @ mix]) for i in range(300)]
    held += [held[3], held[3], (900, held[5][1]), *[(1000 + i, held[7][1]) for i in range(150)], (None, held[9][1])]
    bad = [(2000, None), (2001, [None] * d), (2002, [float("nan")] * d), (2003, [float("inf"), *[0.0] * (d - 1)]), (2004, []), (2005, [1.0] * (d + 1))]
    n, deviations, values, axes, rows, trace = brute_whitening(held)
    got = whitening.whiten(vectors_frame(spark, held + bad, clash)).collect()
    k = min(16, d)
    assert len(got) == k * len(held) and {r["n"] for r in got} == {n}
    assert Counter((r["vec_id"], r["deviation"]) for r in got) == Counter({key: c * k for key, c in deviations.items()})
    assert max(r["identity_error"] for r in got) < 1e-9
    signs = {}
    by_id = {i: v for (i, _), v in rows.items()}
    for r in got:
        c = r["component"] - 1
        want = by_id[r["vec_id"]] @ axes[:, c] / math.sqrt(values[c])
        if abs(want) > 1e-3:
            signs.setdefault(c, np.sign(want * r["whitened"]))
            assert r["whitened"] == pytest.approx(want * signs[c], rel=1e-7)
        assert r["explained"] == pytest.approx(values[c] / trace, rel=1e-9)


def test_degenerate_vectors_have_defined_results(spark):
    assert whitening.whiten(vectors_frame(spark, [])).count() == 0
    assert whitening.whiten(vectors_frame(spark, [(1, [1.0, 2.0])] * 5)).count() == 0
    line = [(i, [float(i), 2.0 * i, 1.0]) for i in range(30)]  # one dimension of variance
    got = whitening.whiten(vectors_frame(spark, line)).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 30 and got[0]["explained"] == pytest.approx(1)
    huge = whitening.whiten(vectors_frame(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 5.0])])).collect()
    assert {r["deviation"] for r in huge if r["vec_id"] != 3} == {None} and all(math.isfinite(r["whitened"]) for r in huge)


def test_tiles_sum_over_row_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 1)  # 64 rows to a block
    rng = np.random.default_rng(3)
    values = rng.integers(-50, 50, size=(700, 70))
    rows = spark.createDataFrame([(v.tolist(),) for v in values], "x array<long>").repartition(3)
    n, sums = whitening.dimension_sums(rows, "x")
    assert (n, sums) == (700, values.sum(axis=0).tolist())
    got = whitening.tiled_covariance(rows, "x", whitening.Centre.of(n, sums))
    assert np.allclose(got, np.cov(values.T, bias=True), atol=1e-9)


# ---- secrets


def der(tag, *parts):
    body = b"".join(parts)
    size = bytes([len(body)]) if len(body) < 128 else (lambda k: bytes([128 + len(k)]) + k)(len(body).to_bytes((len(body).bit_length() + 7) // 8))
    return bytes([tag]) + size + body


def number(v):
    return der(2, v.to_bytes(v.bit_length() // 8 + 1))


P, Q = (1 << 521) - 1, (1 << 607) - 1
RSA = der(0x30, *map(number, (0, P * Q, 65537, 12345, P, Q, 77, 88, 99)))
ED25519 = der(0x30, number(0), der(0x30, der(6, bytes.fromhex("2b6570"))), der(4, der(4, bytes(range(32)))))
PKCS8 = der(0x30, number(0), der(0x30, der(6, secret_scan.RSA_ID), der(5)), der(4, RSA))
EC = der(0x30, number(1), der(4, bytes(range(32))), der(0xA0, der(6, bytes.fromhex("2a8648ce3d030107"))))
LOCKED = der(0x30, der(0x30, der(6, secret_scan.PASSWORD_IDS[0] + b"\x0d"), der(0x30, der(4, b"salt"))), der(4, bytes(64)))
PUBLIC = der(0x30, der(0x30, der(6, secret_scan.RSA_ID), der(5)), der(3, b"\x00" + der(0x30, number(P * Q), number(65537))))


def string(data):
    return len(data).to_bytes(4) + data


PUB = string(b"ssh-ed25519") + string(bytes(32))
OPENSSH = b"openssh-key-v1\x00" + string(b"none") * 2 + string(b"") + (1).to_bytes(4) + string(PUB) + string(b"abcdabcd" + PUB + bytes(16))


def url(data):
    return base64.urlsafe_b64encode(data).rstrip(b"=").decode()


def jwt(alg, size, payload=b'{"sub": 1}'):
    return ".".join([url(json.dumps({"alg": alg, "typ": "JWT"}).encode()), url(payload), url(bytes(range(size)))])


def pem(data, label="PRIVATE KEY", cut=64):
    text = base64.b64encode(data).decode()
    return "\n".join([f"-----BEGIN {label}-----", *[text[i : i + cut] for i in range(0, len(text), cut)], f"-----END {label}-----"])


def b64(data):
    return base64.b64encode(data).decode()


KEYS = {"rsa": RSA, "pkcs8": PKCS8, "ec": EC, "pkcs8-encrypted": LOCKED, "openssh": OPENSSH}


@pytest.mark.parametrize(("form", "data"), [*KEYS.items(), ("pkcs8", ED25519)])
def test_keys_are_confirmed_in_every_encoding(form, data):
    for at in (b64(data), url(data) + "=" * 2, data.hex(), data.hex().upper(), pem(data, "RSA PRIVATE KEY"), pem(data).replace("\n", "\\n")):
        text = f"é see {at}, then"
        bare = at.rstrip("=") + "==" if at.endswith("==") else at
        assert [s for s in secret_scan.secrets_in(text) if s[0] == "key"] == [("key", 6, 6 + len(bare), form)], at[:40]
    nested = b64(pem(data).encode())
    assert [s[::3] for s in secret_scan.secrets_in(nested) if s[0] == "key"] == [("key", f"{form} in base64")]


@pytest.mark.parametrize("data", [RSA[:-1], RSA + b"\x00", RSA[:5] + b"\x05" + RSA[6:], PUBLIC, OPENSSH[:-1], OPENSSH.replace(b"abcdabcd", b"abcdabce"), bytes(90), b"\x30\x80" + bytes(60)])
def test_bytes_of_another_structure_are_not_keys(data):
    for at in (b64(data), data.hex(), pem(data)):
        assert not [s for s in secret_scan.secrets_in(at) if s[0] in ("key", "signed")]


def test_tokens_are_confirmed_by_their_parts():
    good = [jwt("HS256", 32), jwt("ES384", 96), jwt("RS256", 256)]
    wrong = [jwt("HS256", 31), jwt("none", 32), jwt("XX256", 32), jwt("HS256", 32, b"[1]"), jwt("HS256", 32, b"\xff\xfe"), jwt("HS256", 0), url(b'{"a": 1}' * 9) + ".b.c"]
    sealed = ".".join(map(url, (b'{"alg": "dir", "enc": "A128GCM"}', b"", b"123456789012", b"text", b"tag")))
    for token in (*good, sealed):
        for tail in ("", ".", ". Next", ".html.x" if token != sealed else ""):
            found = [s for s in secret_scan.secrets_in(f"x={token}{tail}") if s[0] == "signed"]
            assert [(s[1], s[2]) for s in found] == [(2, 2 + len(token))], (token, tail)
    for token in wrong:
        assert not [s for s in secret_scan.secrets_in(token) if s[0] == "signed"], token


def brute_base(text):
    """The base kinds by a scan of every start, without searching patterns."""
    out, text = [], text or ""
    tail = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    lower = "".join(c.lower() if c.isascii() else c for c in text)
    at = 0
    while at < len(text):
        word = next((w for w in ("password", "passwd", "secret", "token", "api_key", "apikey") if lower.startswith(w, at)), None)
        m = re.compile(tail).match(text, at + len(word)) if word else None
        if m:
            if len(m[1]) >= 6:
                out.append(("assign", at, m.end()))
            at = m.end()
        else:
            at += 1
    for kind, pattern, least in (("access", "AKIA", 20), ("hex", "", 24)):
        letters = set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") if kind == "access" else set("0123456789abcdef")
        at = 0
        while at < len(text):
            end = at + len(pattern)
            if text.startswith(pattern, at) and end < len(text) and text[end] in letters:
                while end < len(text) and text[end] in letters:
                    end += 1
                if end - at >= least:
                    out.append((kind, at, end))
                at = end
            else:
                at += 1
    return sorted(out, key=lambda s: (s[1], secret_scan.KINDS.index(s[0])))


@pytest.mark.parametrize("clash", [False, True])
def test_secret_spans_match_brute_force(spark, tmp_path, clash):
    rng = random.Random(4)
    pieces = ["password", "PassWd", "ſecret", "secret", "TOKEN", "api_key", "apiKey", ' "', "'", ": ", "=", "  ", "x", "abc123", "AKIA", "AKIA" + "Z9" * 9, "0123456789abcdef" * 2, "é", "\n", "toKen", "."]
    rows = awkward(rng)
    rows += [(500 + i, "".join(rng.choice(pieces) for _ in range(rng.randrange(60))), "en", "s", 1) for i in range(300)]
    rows += [(900, f"key {pem(RSA)} and {jwt('HS256', 32)}", "en", "s", 1), (901, "deadbeef" * 4 + " " + ED25519.hex(), None, None, None)]
    docs_frame(spark, rows, clash).write.parquet(f"{tmp_path}/documents.parquet")
    got = secret_scan.op12_secret_scan(spark, str(tmp_path)).collect()
    want = Counter()
    for doc_id, text, *_ in rows:
        base = brute_base(text)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        counts = [sum(k == kind for k, *_ in base) for kind in secret_scan.BASE]
        want[(doc_id, *counts, hashlib.sha256(listed.encode()).hexdigest())] += 1
    assert Counter((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in got) == want
    for r in got:  # base spans stay, in order, among the confirmed ones
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        assert [int(s[1]) for s in spans] == sorted(int(s[1]) for s in spans)
        listed = ",".join(":".join(s) for s in spans if s[0] in secret_scan.BASE)
        assert hashlib.sha256(listed.encode()).hexdigest() == r["base_sha256"]
    by_id = {r["doc_id"]: r for r in got}
    assert (by_id[900]["n_key"], by_id[900]["n_signed"], by_id[901]["n_key"]) == (1, 1, 1)


@pytest.mark.parametrize("text", ["a" * 400_000, "password " * 60_000, "-----BEGIN PRIVATE KEY-----" * 15_000, "ey" * 200_000 + ".a", "eyJa.a" * 60_000, "0" * 400_001, "=:" * 200_000, b64(b"\x30" * 300_000)])
def test_hostile_texts_take_linear_time(text):
    import time

    began = time.perf_counter()
    secret_scan.secrets_in(text)
    assert time.perf_counter() - began < 4


def test_no_texts_no_secrets(spark):
    assert secret_scan.find_secrets(docs_frame(spark, [])).count() == 0


# ---- resampling


def brute_runs(text, n=3):
    w = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    return len(w), [b" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def brute_resample(rows, target):
    corpus, wanted = Counter(), Counter()
    for _, text, *_ in rows:
        corpus.update(zlib.crc32(f) % 10_000 for f in brute_runs(text)[1])
    for _, text in target:
        wanted.update(zlib.crc32(f) % 10_000 for f in brute_runs(text)[1])
    s_all, t_all = sum(corpus.values()) + 10_000.0, sum(wanted.values()) + 10_000.0
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * s_all / ((corpus[b] + 1) * t_all)))
    out = []
    for doc_id, text, *_ in rows:
        n, runs = brute_runs(text)
        weight = sum(gain(zlib.crc32(f) % 10_000) for f in runs)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, n, len(runs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    enough = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[1], r[2]))
    drawn = len(enough) * 5 // 100
    ranked = [(*r[:1], *r[2:], i + 1 if i < drawn else None) for i, r in enumerate(enough)]
    return Counter([*ranked, *[(*r[:1], *r[2:], None) for r in out if r[1] < 20]])


@pytest.mark.parametrize("clash", [False, True])
def test_resampling_matches_brute_force(spark, tmp_path, clash):
    rng = random.Random(9)
    rows = awkward(rng)
    rows += [(3000 + i, " ".join(rng.choice(["Der", "the", "it's", "Äpfel", "x-1", "日本", "end."]) for _ in range(rng.randrange(90))), "en", "s", 1) for i in range(400)]
    rows += [(5000 + i, "the same words again and again " * 5, "en", "hot", 1) for i in range(200)]
    target = [(1, "the end. it's the Äpfel x-1"), (2, None), (3, "")]
    docs_frame(spark, rows, clash).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(target, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = resampling.op13_resample(spark, str(tmp_path))
    assert dict(got.dtypes) == dict.fromkeys(("doc_id", "n_features", "weight", "score", "rank"), "bigint")
    assert Counter(map(tuple, got.collect())) == brute_resample(rows, target)


def test_resampling_of_empty_tables(spark):
    nothing = docs_frame(spark, [])
    assert resampling.resample(nothing, nothing).count() == 0
    one = resampling.resample(docs_frame(spark, [(1, "a b", "en", "s", 3)]), nothing).collect()
    assert [(r["doc_id"], r["n_features"], r["rank"]) for r in one] == [(1, 3, None)]


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_the_ring_carries_states_over_parts(n):
    rng = random.Random(n)
    for _ in range(200):
        words = [rng.choice([b"a", b"bc", b"\xc3\xa9", b"longer9"]) for _ in range(rng.randrange(12))]
        ring, got, at = resampling.CrcRing(n), [[] for _ in range(n)], 0
        while at < len(words):
            step = rng.randrange(1, 5)
            for k, found in enumerate(ring.extend(words[at : at + step])):
                got[k] += found
            at += step
        assert got == [[zlib.crc32(b" ".join(words[i : i + k])) for i in range(len(words) - k + 1)] for k in range(1, n + 1)]
