"""Token files, packing, quality rules, WARC, sharding: brute force, invariants and awkward rows."""

import base64
import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from conformity.llm import packing, quality, sharding, token_files, tokens, warc
from conformity.llm.common import numbered, scratch_path
from conformity.llm.tokens import PieceEncoder, default_vocabulary

from .helpers import awkward, docs_frame


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_vocabulary())


def ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def packed(values):
    return struct.pack(f"<{len(values)}I", *values)


def test_pieces_encode_like_whole_texts(tokenizer):
    encoder = PieceEncoder(default_vocabulary())
    rng = random.Random(5)
    letters = "ab1 \n\t.'s<|!é²\xa0\x85\x1c\r  reAvell"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(400)]
    texts += ["x <|endoftext|> y", "日本 text", ""] + [f"a{chr(c)}b {chr(c)}1 {chr(c)}" for c in range(0x2C0)]
    for _ in range(2):
        assert encoder.encode(texts) == [packed(ids(tokenizer, t)[:-1]) for t in texts]


def test_pieces_are_split_and_kept_in_arrays(tokenizer, monkeypatch):
    rng = random.Random(9)
    letters = "ab sstmdrevl'''  \n\t\xa0\x85.,1²éß\x00\x1c"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(600)]
    texts += ["", "'", "'s", "a'", "a'r", "it's'll've'dx 'm", "\n", "x" * 19, "x" * 18, "y" * 300 + " " + "y" * 300, " " * 40]
    joined = "".join(t + tokens.END for t in texts)
    at = np.flatnonzero(tokens.piece_starts(np.frombuffer(joined.encode("utf-16-le"), "<u2"))).tolist()
    assert [joined[a:b] for a, b in zip(at, [*at[1:], len(joined)], strict=True)] == [p for t in texts for p in [*tokens.PIECES.findall(t), tokens.END]]
    # a table that keeps few pieces drops the others and spells the same ids
    monkeypatch.setattr(tokens, "KEPT_PIECES", 40)
    monkeypatch.setattr(tokens, "LOOKED_UP", 64)
    encoder = PieceEncoder(default_vocabulary())
    for _ in range(2):
        assert encoder.encode(texts) == [packed(ids(tokenizer, t)[:-1]) for t in texts]
        assert encoder.table.n <= 2 * 40 + 64


def test_new_pieces_are_not_split_again(tokenizer):
    encoder = PieceEncoder(default_vocabulary())
    encoder.tokenizer = SimpleNamespace(model=tokenizer.model)  # without the library's own splitting
    texts = ["Unheard-of pieces,\n\n they've  gone straight", "to the 1 model's\tmerges é", ""]
    assert encoder.encode(texts) == [packed(ids(tokenizer, t)[:-1]) for t in texts]


@pytest.mark.parametrize("clash", [False, True])
def test_token_files_round_trip(spark, tokenizer, clash):
    rows = awkward(random.Random(1))
    folder = scratch_path(spark, "test-tokens")
    manifest = token_files.write_token_files(docs_frame(spark, rows, clash), folder)
    out = token_files.read_token_files(manifest, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in out] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d))
    want = Counter((r[0], packed(ids(tokenizer, r[1]))) for r in rows)
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in out) == want
    at = 0
    for r in out:
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]) // 4)
        at += r["n_tokens"]
    # a doc_id with most rows, and rows without one, are many files
    hot = [(None if i % 3 == 0 else 7, f"text {i}", "en", "s", 1) for i in range(400)]
    folder = scratch_path(spark, "test-tokens")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        manifest = token_files.write_token_files(docs_frame(spark, hot), folder)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    files = [r["n_docs"] for r in manifest.collect()]
    assert sum(files) == 400 and max(files) <= 200 and len(files) >= 3
    out = token_files.read_token_files(manifest, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in out] == [None] * 134 + [7] * 266 and len({bytes(r["ids"]) for r in out}) == 400
    empty = scratch_path(spark, "test-tokens")
    assert token_files.read_token_files(token_files.write_token_files(docs_frame(spark, []), empty), empty).count() == 0


def test_readers_decompress_only_what_they_need_and_notice_damage(tmp_path):
    path = tmp_path / "x.ids"
    held = {i: packed(range(i, i + 50 + i)) for i in range(200)}
    with path.open("wb") as out:
        writer = token_files.TokenFileWriter(out, frame_ids=1000)
        for i, data in held.items():
            writer.add(i, data)
        writer.close()
    with path.open("rb") as source:
        reader = token_files.TokenFileReader(source, path.stat().st_size)
        assert len(reader.entries) > 20 and reader.document(150) == held[150] and reader.frames_read == 1
    assert {k: v.tobytes() for k, v in token_files.read_documents(path, [3, 199, 999]).items()} == {3: held[3], 199: held[199]}
    data = bytearray(path.read_bytes())
    data[20] ^= 255
    with pytest.raises(Exception):  # noqa: B017  zstandard's or our own
        token_files.read_documents(bytes(data), [0])
    with pytest.raises(ValueError, match="seekable"):
        token_files.read_documents(bytes(100), [0])


@pytest.mark.parametrize("clash", [False, True])
def test_packing_places_every_piece_once(spark, tokenizer, clash):
    rows = awkward(random.Random(2))
    out = packing.packed_documents(docs_frame(spark, rows, clash), capacity=256).collect()
    want = Counter()
    for r in rows:
        whole, at, k = ids(tokenizer, r[1]), 0, 0
        while at < len(whole):
            size = len(whole) if len(whole) <= 256 else (len(whole) % 256 or 256) if at == 0 else 256
            want[r[0], k, at, size, zlib.crc32(packed(whole[at : at + size]))] += 1
            at, k = at + size, k + 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    held = defaultdict(list)
    for r in out:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 256
    assert len(held) <= 1.05 * sum(r["length"] for r in out) / 256 + 2
    assert packing.packed_documents(docs_frame(spark, [])).count() == 0


@pytest.mark.parametrize("n", [1, 40, 3000])
def test_plans_are_near_the_bound(n):
    rng = random.Random(n)
    counts = Counter(min(2047, int(rng.lognormvariate(6.2, 1)) + 1) for _ in range(n))
    kinds = packing.plan_packing(dict(counts))
    used = Counter()
    for lengths, times in kinds:
        assert sum(lengths) <= 2048 and times > 0
        for x in lengths:
            used[x] += times
    assert used == counts
    bins, least = sum(t for _, t in kinds), -(-sum(k * v for k, v in counts.items()) // 2048)
    assert bins <= least * 1.02 + 2
    assert packing.plan_packing({}) == [] and packing.plan_packing({2048: 3}) == [((2048,), 3)]
    assert sum(t for _, t in packing.plan_packing({1025: 10, 1023: 10})) == 10


def brute_quality(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_configuration_programs_reach_their_optimum():
    import warnings

    rng = random.Random(8)
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        for _ in range(60):
            capacity = rng.choice([100, 2048])
            sizes = sorted(rng.sample(range(capacity // 12, capacity), rng.randrange(1, 14)), reverse=True)
            packing.configurations(sizes, [rng.choice([1, 1, 7, 300]) for _ in sizes], capacity)


def test_quality_counts_match_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", "one", "a b c d e", "a b c d e " * 3, "x y\n \nx y\n\nx y\n#*$%&|<>\x0b\x85q", "é " * 40, "ab cd ef"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(40)] + ["\n".join(rng.choice(["l one", "l two ", ""]) for _ in range(9)) for _ in range(9)]
    for t in texts:
        assert quality.text_metrics(t)[:5] == brute_quality(t), t
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in quality.quality_verdicts(docs_frame(spark, rows, True), labels).collect()}
    for i, t in enumerate(texts):
        n, _, _, _, repeated = brute_quality(t)
        assert out[i]["base_failed"] == (n < 10 or 100 * repeated > 20 * n) == (not out[i]["kept"])


def test_cutoffs_are_certified_per_stratum(spark):
    rng = random.Random(4)
    clean = lambda i: " ".join(f"w{rng.randrange(10**6)}" for _ in range(30))
    junk = lambda i: " ".join(f"w{rng.randrange(10**6)}###" for _ in range(30))
    rows = [(i, clean(i) if i % 10 else junk(i), "en" if i < 2000 else "fr" if i < 2500 else "de", "s", 1) for i in range(2560)]
    labels = spark.createDataFrame([(i, int(i % 10 > 0), 0) for i in range(2560)] + [(None, 1, 0), (1, None, None), (10**9, 1, 0)], "doc_id long, quality int, toxic int")
    docs = docs_frame(spark, rows)
    out = quality.quality_verdicts(docs, labels).groupBy((F.col("doc_id") < 2500).alias("large"), (F.col("doc_id") % 10 == 0).alias("junk")).agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    kept = {(r["large"], r["junk"]): r["kept"] for r in out.collect()}
    # the small stratum has too few labels to certify any cutoff
    assert kept == {(True, True): 0.0, (True, False): 1.0, (False, True): 1.0, (False, False): 1.0}
    held = quality.keep_good(docs, labels)
    assert held.columns == docs.columns and held.count() == 2560 - 250
    assert quality.keep_good(docs_frame(spark, awkward(rng), True), labels).columns[:2] == ["doc_id", "text"]


def test_no_documents_no_verdicts(spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(99)], "doc_id long, quality int, toxic int")
    assert quality.quality_verdicts(docs_frame(spark, []), labels).count() == 0
    assert quality.keep_good(docs_frame(spark, []), labels).count() == 0


def test_texts_are_measured_once(spark, tmp_path):
    docs_frame(spark, awkward(random.Random(9))).write.parquet(f"file://{tmp_path}/d")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(99)], "doc_id long, quality int, toxic int")
    plan = quality.keep_good(spark.read.parquet(f"file://{tmp_path}/d"), labels)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_false_rejection_stays_within_its_bound():
    """Repeated holdouts: how often a choice in use truly rejects more than alpha is at most delta."""
    rng = np.random.default_rng(8)
    levels, alpha, delta = quality.LEVELS, 0.05, 0.05
    # the true share of good documents at each level; the base rules reject 2 %
    true = np.concatenate([[0.02], np.full(8, 0.006), np.zeros(levels - 8), [0.0]])
    true[-1] = 1 - true.sum()
    broken, used = 0, 0
    for _ in range(2000):
        good = rng.multinomial(400, true).tolist()
        bad = [0, *[5] * 8, *[0] * (levels - 7)]
        k = quality.choose_levels(good[0], good[1:], bad[1:], alpha, delta)
        used += k > 0
        broken += k > 0 and true[: k + 1].sum() > alpha
    assert used > 200 and broken <= 2000 * delta + 3 * (2000 * delta) ** 0.5


def test_binomial_bounds_are_exact():
    from math import comb

    for n, p in ((7, 0.3), (40, 0.02)):
        for x in range(n):
            assert abs(quality.binomial_cdf(x, n, p) - sum(comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(x + 1))) < 1e-9
    rest = [0] * (quality.LEVELS - 3)
    assert quality.certified_levels(0, [0, 0, 500, *rest, 4500], 0.01, 0.05) == 2
    assert quality.certified_levels(60, [0, 0, 0, *rest, 4940], 0.01, 0.05) == 0  # the base rules alone exceed the bound
    assert quality.certified_levels(0, [0, 0, 0, *rest, 10], 0.01, 0.05) == 0 and quality.certified_levels(0, [0], 0.5, 0.5) == 0
    assert quality.choose_levels(0, [1, 3, 0, *rest, 5000], [9, 2, 0, *rest, 9], 0.05, 0.05) == 1
    assert quality.tested_strata({"a": 1000, "b": 70, "c": 60}, 0.05, 0.05) == ["a"] and quality.tested_strata({"c": 58}, 0.05, 0.05) == []


PAGES = "page_id long, url string, html string"


def test_warc_archive(spark):
    rng = random.Random(6)
    rows = [(i, f"http://h/{i}", rng.choice([None, "", "<p>é</p>", "<p>a</p>", f"<p>{i}</p>" * 9])) for i in range(60)] + [(3, "http://again", "<p>a</p>"), (None, None, "<p>a</p>"), (None, None, "<p>only null</p>")]
    folder = scratch_path(spark, "test-warc")
    pages = spark.createDataFrame(rows, PAGES).withColumns({"digest": F.lit(1), "payload": F.lit(2), "first": F.lit(3)})
    warc.write_archive(pages, folder)
    records = warc.read_archive(spark, folder)
    out = records.withColumns({"kind": warc.field("WARC-Type"), "to": warc.field("WARC-Refers-To")}).collect()
    assert len(out) == len(rows)
    assert spark.read.parquet(f"{folder}/objects").count() == len({r[2] or "" for r in rows})
    by_text = defaultdict(list)
    for r in rows:
        by_text[r[2] or ""].append(r[0])
    for r in out:
        text = bytes(r["payload"]).decode()
        first = min((i for i in by_text[text] if i is not None), default=None)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()
        assert r["kind"] == "response" and r["page_id"] == first or r["to"] == f"<urn:page:{first}>"
    assert Counter(r["kind"] for r in out)["response"] == len(by_text)
    raw = {r["page_id"]: bytes(r["record"]) for r in warc.record_bytes(records.where("page_id = 0")).collect()}[0]
    head, _, body = raw.partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and raw.endswith(b"\r\n\r\n")
    length = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
    assert len(body) == length + 4
    empty = scratch_path(spark, "test-warc")
    warc.write_archive(spark.createDataFrame([], PAGES), empty)
    assert warc.read_archive(spark, empty).count() == 0


def test_warc_headers_keep_to_their_lines(spark):
    """Line ends of any kind in a url make no header fields."""
    bad = ["\u2028", "\u2029", "\x85", "\r\n", "\n", "\x0b"]
    rows = [(i, f"http://h/{c}WARC-Refers-To: <urn:page:77>{c}WARC-Type: revisit", f"<p>{i // 2}</p>") for i, c in enumerate(bad)]
    folder = scratch_path(spark, "test-warc")
    warc.write_archive(spark.createDataFrame(rows, PAGES), folder)
    records = warc.read_archive(spark, folder)
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.archive_report(records).collect()}
    assert got == {i: ("revisit", i - 1) if i % 2 else ("response", None) for i in range(6)}
    assert {r["page_id"]: r["url"] for r in records.collect()} == {i: u for i, u, _ in rows}


def test_warc_report_comes_from_rebuilt_records(spark):
    rows = [(1, "u", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (None, "x", "q"), (None, "y", "q")]
    folder = scratch_path(spark, "test-warc")
    warc.write_archive(spark.createDataFrame(rows, PAGES), folder)
    got = Counter(tuple(r) for r in warc.archive_report(warc.read_archive(spark, folder)).collect())
    sha = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    one, q = "<p>é</p>", sha("q")
    assert got == Counter([(1, 9, sha(one), "response", None), (2, 9, sha(one), "revisit", 1), (3, 0, sha(""), "response", None), (None, 1, q, "response", None), (None, 1, q, "revisit", None)])


def test_warc_small_payloads_are_all_responses(spark):
    folder = scratch_path(spark, "test-warc")
    warc.write_archive(spark.createDataFrame([(i, "u", "ab" if i % 2 else "abcdefgh") for i in range(6)], PAGES), folder, min_bytes=5)
    kinds = {r["page_id"]: r["kind"] for r in warc.read_archive(spark, folder).withColumn("kind", warc.field("WARC-Type")).collect()}
    assert kinds == {0: "response", 1: "response", 2: "revisit", 3: "response", 4: "revisit", 5: "response"}


def test_warc_damage_is_noticed(spark):
    folder = scratch_path(spark, "test-warc")
    warc.write_archive(spark.createDataFrame([(1, "u", "abc")], PAGES), folder)
    spark.read.parquet(f"{folder}/objects").withColumn("payload", F.lit(b"xyz")).write.parquet(f"{folder}/bad")
    spark.read.parquet(f"{folder}/bad").write.mode("overwrite").parquet(f"{folder}/objects")
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_archive(spark, folder).collect()


def check_shards(rows, out, shards):
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in rows)
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


@pytest.mark.parametrize("shape", ["awkward", "hot", "all linked"])
def test_shards_are_even_and_keep_equal_texts_together(spark, shape):
    rng = random.Random(8)
    if shape == "awkward":
        rows = awkward(rng)
    elif shape == "hot":  # one text is a third of the rows, more than four shards hold
        rows = [(i, "same" if i % 3 == 0 else f"pair {i // 6}" if i % 3 == 1 else f"t {i}", "en", "s", 1) for i in range(600)]
    else:
        rows = [(i, f"t {i // 5}", "en", "s", 1) for i in range(500)]
    out = sharding.shard_documents(docs_frame(spark, rows, True), shards=12).collect()
    check_shards(rows, out, 12)
    text = {r[0]: r[1] for r in rows}
    for r in out:
        if r["doc_id"] is not None:
            data = (text[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
    apart = defaultdict(set)
    for r in out:
        apart[text.get(r["doc_id"])].add(r["shard"])
    if shape == "hot":
        assert len(apart["same"]) <= 8 and sum(len(v) > 1 for k, v in apart.items() if k != "same") <= 25
    if shape == "all linked":
        assert sum(len(v) > 1 for v in apart.values()) <= 40
    assert sharding.shard_documents(docs_frame(spark, [])).count() == 0


def test_propagation_never_cuts_more(spark):
    from conformity.llm.common import saved

    cells = saved(spark.createDataFrame([(f"k{i}".encode(), s, 3) for i in range(40) for s in range(4)], "key binary, shard int, n long"), "test-cells")
    cut = lambda df: df.groupBy("key").agg((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))).alias("c")).agg(F.sum("c")).first()[0]
    before = cut(cells)
    after, load = sharding.propagate(cells, [240] * 4)
    assert cut(after) < before and sum(load) == 480 and max(load) <= 240


def test_numbering_is_gapless_in_many_bins(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    out = numbered(df, ["g"], [F.col("id")], "at", per_task=50).groupBy("g").agg(F.sort_array(F.collect_list("at")).alias("at")).collect()
    assert all(r["at"] == list(range(len(r["at"]))) for r in out)


def test_no_python_on_the_sharding_path(spark):
    plan = sharding.shard_documents(docs_frame(spark, awkward(random.Random(1))))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
