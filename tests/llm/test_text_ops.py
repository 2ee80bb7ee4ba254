"""Near-duplicates, repeated strings, decontamination, main text, toxicity: brute force and awkward rows."""

import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from conformity.llm import decontaminate, html_text, near_dup, suffix_dedup, toxicity

from .helpers import awkward, docs_frame, words

# ---- near-duplicates


def brute_components(rows):
    sets = []
    for _, text, *_ in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        sets.append(frozenset(zip(w, w[1:], strict=False)) if len(w) > 1 else frozenset(w))
    of = list(range(len(rows)))

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    known = [i for i, r in enumerate(rows) if r[0] is not None and sets[i]]
    for i in known:
        for j in known:
            if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                of[root(j)] = root(i)
    least = {}
    for i in known:
        least[root(i)] = min(least.get(root(i), rows[i][0]), rows[i][0])
    return Counter((r[0], len(sets[i]), least[root(i)] if i in set(known) else r[0]) for i, r in enumerate(rows))


def variants(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("seed", "clash"), [(1, False), (2, True)])
def test_components_match_brute_force(spark, seed, clash):
    rng = random.Random(seed)
    rows = awkward(rng)
    at = 100
    # a hot group of near copies around the limit, chains, and word orders that differ
    for base, n, edits in ((words(rng, 60), 120, 12), (words(rng, 200), 10, 60), (words(rng, 12), 8, 3)):
        for t in variants(rng, base, n, edits):
            rows.append((at, t, "en", "s", 1))
            at += 1
    rows += [(at, "Two Words", "en", "s", 1), (at + 1, "two words", "en", "s", 1), (at + 2, "words two", "en", "s", 1), (at + 3, "word ", "en", "s", 1), (4, "another text of id four", "en", "s", 1)]
    rng.shuffle(rows)
    out = near_dup.near_duplicates(docs_frame(spark, rows, clash)).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out) == brute_components(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_rows_of_a_repeated_id_go_for_their_own_text_only(spark):
    rng = random.Random(21)
    base, own = words(rng, 80), words(rng, 80)
    rows = [(3, base, "en", "s", 1), (5, base + " more", "en", "s", 1), (5, own, "en", "s", 1), (7, own + " more", "en", "s", 1), (None, base, "en", "s", 1)]
    left = Counter((r["doc_id"], r["text"]) for r in near_dup.drop_near_duplicates(docs_frame(spark, rows, True)).collect())
    assert left == Counter([(3, base), (5, own), (None, base)])


def test_rare_shingles_bound_similarity_from_above(spark):
    rng = random.Random(11)
    template = words(rng, 61, 10**6).split()
    texts = [" ".join(template + words(rng, rng.randrange(5, 20), 10**6).split()) for _ in range(near_dup.RARE + 6)]
    # rare shares just under and over one half, in pairs that differ by few of the frequent or of the rare shingles
    for rare in (56, 59, 60, 61, 64):
        tail = words(rng, rare, 10**6).split()
        texts += [" ".join(template[cut:] + tail[: rare - less]) for cut in (0, 1, 2, 5) for less in (0, 1, 3)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    sets = [set(zip(t.split(), t.split()[1:], strict=False)) for t in texts]
    docs = docs_frame(spark, rows)
    reps = near_dup.signatures(docs).select(F.col("digest").alias("key"), F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n")).localCheckpoint()
    found = near_dup.rare_shingles(reps.select("key"), reps, docs)
    sides = reps.join(found, "key", "left").select("doc", "n", F.struct("n", *near_dup.bounded_side()).alias("s")).localCheckpoint()
    lists = {r["n"] for r in sides.where("s.rare IS NULL").collect()}, {r["n"] for r in sides.where("size(s.rare) > 0").collect()}
    assert lists[0] and lists[1]
    near = sides.alias("l").join(sides.alias("r"), F.col("l.doc") < F.col("r.doc")).where(near_dup._bounded("l.s", "r.s"))
    held = {(r[0], r[1]) for r in near.select("l.doc", "r.doc").collect()}
    alike = {(a, b) for b in range(len(sets)) for a in range(b) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert len(alike) > 200 and alike <= held
    assert len(held) < len(sets) * (len(sets) - 1) / 2


def test_no_documents_no_components(spark):
    assert near_dup.near_duplicates(docs_frame(spark, [])).count() == 0
    rows = [(2, "a b c", "en", "s", 1), (1, "A b c", "en", "s", 1), (3, None, "en", "s", 1), (None, "x", None, None, None)]
    kept = near_dup.drop_near_duplicates(docs_frame(spark, rows, True))
    assert {r["doc_id"] for r in kept.collect()} == {1, 3, None} and "digest" in kept.columns


def test_sketches_estimate_high_similarities():
    rng = np.random.default_rng(3)
    for share in (0.8, 0.95):
        miss = []
        for _ in range(60):
            both = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
            k = int(900 * share)
            own = rng.integers(0, 1 << 63, (2, (900 - k) // 2), dtype=np.uint64)
            a, b = (near_dup.odd_sketch(near_dup.minhash(np.concatenate([both[:k], o]))) for o in own)
            differ = int(np.bitwise_count((a ^ b).view(np.uint64)).sum())
            miss.append(differ - near_dup.differing_bits(share))
            assert differ <= near_dup.differing_bits(near_dup.SKETCH_FLOOR)
        assert abs(np.mean(miss)) < 6


# ---- repeated strings


def brute_removal(rows, length):
    seen = Counter()
    texts = [(r[1] or "").encode() for r in rows]
    for t in texts:
        seen.update(t[i : i + length] for i in range(len(t) - length + 1))
    out = Counter()
    for r, t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[r[0], len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def passages(rng):
    shared = [words(rng, 120, 10**6), "ü" + words(rng, 75, 10**6), "ab" * 450]
    rows = [(i, t[:20_000] if t else t, lang, s, n) for i, t, lang, s, n in awkward(rng)]
    for i in range(40):
        parts = [words(rng, rng.randrange(3, 60), 10**6) for _ in range(3)]
        for p in rng.sample(shared, rng.randrange(4) if i % 2 else 1):
            cut = rng.randrange(0, 200)
            parts.insert(rng.randrange(3), p[cut : cut + rng.randrange(350, 700)])
        rows.append((100 + i, "".join(parts), "en", "s", 1))
    return rows


@pytest.mark.parametrize(("seed", "heavy", "clash"), [(1, 1500, True), (2, 1, False), (3, 3, False)])
def test_removed_bytes_match_brute_force(spark, monkeypatch, seed, heavy, clash):
    monkeypatch.setattr(suffix_dedup, "HEAVY", heavy)
    rows = passages(random.Random(seed))
    out = suffix_dedup.dedup_report(docs_frame(spark, rows, clash)).collect()
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out)
    assert got == brute_removal(rows, suffix_dedup.LENGTH)


def test_removal_keeps_columns_and_empty_tables(spark):
    base = words(random.Random(3), 200)
    rows = [(1, base, "en", "s", len(base)), (2, base + "é", "en", "s", 1), (3, "short", "en", "s", 5), (4, None, None, None, None)]
    docs = docs_frame(spark, rows, True)
    out = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs).collect()}
    assert (out[1]["text"], out[2]["text"], out[2]["n_chars"], out[3]["text"], out[4]["text"]) == ("", "é", 1, "short", None)
    assert suffix_dedup.remove_repeats(docs).columns == docs.columns
    assert suffix_dedup.dedup_report(docs_frame(spark, [])).count() == 0


def without_passages(rows, n, length):
    """Texts without the bytes of windows of n words, or of ``length`` bytes, that also start elsewhere."""
    word, seen, cut = re.compile(rb"[^\x20\x09-\x0D]+"), Counter(), []
    for r in rows:
        data = (r[1] or "").encode()
        spans = [m.span() for m in word.finditer(data)]
        held = [data[a:b] for a, b in spans]
        windows = [(tuple(held[i : i + n]), spans[i][0], spans[i + n - 1][1]) for i in range(len(held) - n + 1)]
        windows += [(data[i : i + length], i, i + length) for i in range(len(data) - length + 1)]
        seen.update(w for w, _, _ in windows)
        cut.append((data, windows))
    out = Counter()
    for r, (data, windows) in zip(rows, cut, strict=True):
        gone = bytearray(len(data))
        for w, a, b in windows:
            if seen[w] > 1:
                gone[a:b] = b"\1" * (b - a)
        out[r[0], None if r[1] is None else bytes(x for x, g in zip(data, gone, strict=True) if not g).decode("utf-8", "ignore")] += 1
    return out


def covered(rows, n):
    """Bytes in windows of n words that also start elsewhere, in how many runs, and whether there are any."""
    texts = [(r[1] or "").encode() for r in rows]
    spans = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", t)] for t in texts]
    windows = [[(tuple(t[a:b] for a, b in s[i : i + n]), s[i][0], s[i + n - 1][1]) for i in range(len(s) - n + 1)] for t, s in zip(texts, spans, strict=True)]
    seen, out = Counter(w for ws in windows for w, _, _ in ws), Counter()
    for r, t, ws in zip(rows, texts, windows, strict=True):
        held = bytearray(len(t))
        for w, a, b in ws:
            if seen[w] > 1:
                held[a:b] = b"\1" * (b - a)
        out[r[0], sum(held), len(re.findall(b"\1+", bytes(held))), any(held)] += 1
    return out


@pytest.mark.parametrize("heavy", [1500, 1])
def test_short_passages_of_many_words_are_cut(spark, monkeypatch, heavy):
    monkeypatch.setattr(suffix_dedup, "HEAVY", heavy)
    rng = random.Random(31)
    few = lambda n: " ".join("".join(rng.choices("abcdeé", k=rng.randrange(1, 7))) for _ in range(n))
    shared = [few(n) for n in (50, 51, 52, 60, 70, 110)]
    rows = [(i, t[:20_000] if t else t, lang, s, n) for i, t, lang, s, n in awkward(rng)]
    for i in range(60):
        parts = [few(rng.randrange(1, 40)) for _ in range(3)]
        for p in rng.sample(shared, rng.randrange(3)):
            at = rng.randrange(10)
            held = p.split(" ")[at if i % 3 else 0 :]
            parts.insert(rng.randrange(3), rng.choice([" ", "\n", " \t"]).join(held))
        rows.append((100 + i, rng.choice([" ", "\n\n"]).join(parts), "en", "s", 1))
    rows.append((200, f"{shared[1]} {few(9)} {shared[2]} {few(9)} {shared[2]}", "en", "s", 1))
    assert all(len(p.encode()) < suffix_dedup.LENGTH for p in shared[:4])
    docs = docs_frame(spark, rows)
    want = without_passages(rows, 51, suffix_dedup.LENGTH)
    assert Counter((r["doc_id"], r["text"]) for r in suffix_dedup.remove_repeats(docs, words=51).collect()) == want
    assert want != without_passages(rows, 10**6, suffix_dedup.LENGTH)
    # the report counts them beside the bytes that are removed, which stay those of ``LENGTH``
    report = suffix_dedup.dedup_report(docs, words=51).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in report) == brute_removal(rows, suffix_dedup.LENGTH)
    found = covered(rows, 51)
    assert Counter((r["doc_id"], r["n_passage_bytes"], r["n_passages"], r["passage_repeated"]) for r in report) == found
    assert any(p and not r["n_removed"] for r in report for p in [r["passage_repeated"]]) and not all(x[3] for x in found)


@pytest.mark.parametrize("few", [500_000, 0])
def test_copied_passages_are_counted_with_few_or_many_hashes(spark, monkeypatch, few):
    monkeypatch.setattr(suffix_dedup, "BROADCAST_ROWS", few)
    rng = random.Random(8)
    text = lambda n: " ".join("".join(rng.choices("abcd", k=rng.randrange(1, 5))) for _ in range(n))
    copy, part = text(90), text(55)
    rows = [(1, copy, "en", "s", 1), (2, copy, "en", "s", 1), (3, f"{text(9)} {part} {text(5)}", "en", "s", 1), (4, f"{part} {text(20)}", "en", "s", 1), (5, text(80), "en", "s", 1)]
    docs = docs_frame(spark, rows)
    report = suffix_dedup.dedup_report(docs, words=51).collect()
    assert Counter((r["doc_id"], r["n_passage_bytes"], r["n_passages"], r["passage_repeated"]) for r in report) == covered(rows, 51)
    classes = suffix_dedup._classes(suffix_dedup.word_anchors(docs, 51), ["k1", "k2", "lo", "hi"])
    assert classes.where("least > 1").count() > 0


def test_every_window_of_words_lies_in_one_piece(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 2048)
    rng = random.Random(32)
    for data in (words(rng, 2000).encode(), ("x" * 5000 + " " + words(rng, 300)).encode(), b"y" * 9000, b" " * 3000, b""):
        found = Counter()
        for at, piece in suffix_dedup.word_pieces(data, 51):
            assert data[at : at + len(piece)] == piece
            a, b = suffix_dedup.word_bounds(np.frombuffer(piece, np.uint8))
            found.update({(at + int(x), at + int(y)) for x, y in zip(a, b[50:], strict=False)})
        a, b = suffix_dedup.word_bounds(np.frombuffer(data, np.uint8))
        assert found.keys() == {(int(x), int(y)) for x, y in zip(a, b[50:], strict=False)}


def test_long_documents_go_in_pieces(spark, monkeypatch):
    rng = random.Random(5)
    a = words(rng, 3000, 10**6)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 2048)
    keys = [(0, 0)]
    data = a.encode()
    found = []
    for at in range(0, len(data) - 399, 1024):
        piece = np.frombuffer(data[at : at + 1024 + 399], np.uint8)
        _, _, first, last = suffix_dedup.pick_anchors(piece, np.array([len(piece)]), 400, 100)
        found += [s for x, y in zip(first, last, strict=True) for s in range(x + at, y + at + 1)]
    assert sorted(found) == list(range(len(data) - 399)) and keys


@pytest.mark.parametrize("seed", range(6))
def test_run_length_index_matches_brute_force(seed):
    rng = random.Random(seed)
    strings = [bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(1, 60))) for _ in range(12)]
    strings += [strings[0], strings[1] + b"a", b"a" * 50]
    for length in (1, 3, 8):
        seen = Counter(s[i : i + length] for s in strings for i in range(len(s) - length + 1))
        want = [[i for i in range(len(s) - length + 1) if seen[s[i : i + length]] > 1] for s in strings]
        index = suffix_dedup.RunLengthIndex(strings)
        assert [x.tolist() for x in index.long_starts(length)] == want
    assert len(index.run_heads) < index.size
    # strings given once with their number of copies are decided like the copies themselves
    distinct = Counter(strings)
    for length in (1, 3, 8):
        seen = Counter(s[i : i + length] for s in strings for i in range(len(s) - length + 1))
        index = suffix_dedup.RunLengthIndex(list(distinct), list(distinct.values()))
        want = [[i for i in range(len(s) - length + 1) if seen[s[i : i + length]] > 1] for s in distinct]
        assert [x.tolist() for x in index.long_starts(length)] == want


# ---- decontamination

BENCHMARK = "item_id long, text string"


def test_passages_are_found_with_words_replaced_and_clean_text_is_left(spark):
    rng = random.Random(7)
    items = [(i, words(rng, n, 10**6)) for i, n in enumerate([40, 40, 25, 8, 7, 3, 60])] + [(90, None), (91, ""), (None, "an item without any id " + words(rng, 20, 10**6))]
    rows = [(i, words(rng, 200, 10**6), "en", "s", 1) for i in range(40)]

    def planted(i, item, every):
        w = items[item][1].split()
        w = [f"q{i}{k}" if every and k % every == every - 1 else x for k, x in enumerate(w)]
        return (i, f"{words(rng, 50, 10**6)} {' '.join(w)} {words(rng, 30, 10**6)}", "en", "s", 1)

    plants = [(100, 0, 0), (101, 1, 7), (102, 2, 6), (103, 3, 0), (104, 6, 5), (105, 4, 0)]
    rows += [planted(*p) for p in plants]
    rows += [(110, items[0][1].upper().replace(" ", ",\n"), "en", "s", 1), (111, " ".join(items[6][1].split()[:30]), "en", "s", 1), (112, " ".join(items[6][1].split()[:9]), "en", "s", 1)]
    rows += [(113, items[5][1], "en", "s", 1), (114, items[-1][1], "en", "s", 1), *awkward(rng)]
    benchmark = spark.createDataFrame(items, BENCHMARK)
    out = decontaminate.contaminated(docs_frame(spark, rows, True), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == {(i, k) for i, k, _ in plants} | {(110, 0), (111, 6), (113, 5), (114, None)}
    docs = docs_frame(spark, rows)
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r[0] for r in rows if r[0] not in {i for i, _, _ in plants} | {110, 111, 113, 114})


def test_indexes_are_built_once_for_each_block_or_group(monkeypatch):
    class Held:
        def __init__(self, value):
            self.value = value

    built = []
    monkeypatch.setattr(decontaminate, "SeedIndex", lambda items: built.append(items) or len(built))
    blocks = [Held([(k, "x" * 100)]) for k in range(8)]
    batches = [["t" * 50] * 4] * 30
    decontaminate._indexes.clear()
    for group in decontaminate._groups(batches, list, len(blocks)):  # all indexes are kept
        [decontaminate._index(b) for b in blocks]
    assert len(built) == 8
    monkeypatch.setattr(decontaminate, "INDEXED_BYTES", 300)
    monkeypatch.setattr(decontaminate, "GROUP_CHARS", 2000)  # ten batches
    decontaminate._indexes.clear()
    built.clear()
    groups = list(decontaminate._groups(batches, list, len(blocks)))
    assert [len(g) for g in groups] == [10, 10, 10]
    for _ in groups:
        [decontaminate._index(b) for b in blocks]
    assert len(built) == 24 and len(decontaminate._indexes) <= 3
    assert [len(g) for g in decontaminate._groups(batches, list, 1)] == [1] * 30
    decontaminate._indexes.clear()


@pytest.mark.parametrize("n", range(6, 18))
def test_every_placement_of_replaced_words_is_found(n):
    item = [f"v{i}" for i in range(n)]
    index = decontaminate.SeedIndex([(1, " ".join(item))])
    window = min(n, decontaminate.WINDOW)
    most = int(window * (1 - decontaminate.SHARE))
    places = list(combinations(range(window), most))
    texts = [" ".join(f"x{i}" if i in set(at) else w for i, w in enumerate(item)) for at in places]
    assert all(index.find(texts))
    short = [" ".join(f"x{i}" if i in set(at) else w for i, w in enumerate(item[:window])) for at in combinations(range(window), most + 1)]
    assert not any(index.find(short))


def test_benchmark_blocks_find_the_same(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i, words(rng, 30, 10**6)) for i in range(12)]
    rows = [(i, f"{words(rng, 20)} {t} {words(rng, 20)}", "en", "s", 1) for i, t in items]
    benchmark, docs = spark.createDataFrame(items, BENCHMARK), docs_frame(spark, rows)
    assert len(list(decontaminate.blocks_of(benchmark, 800))) == 4
    lines = spark.createDataFrame([(i, t.replace(" ", "\n")) for i, t in items], BENCHMARK)
    assert len(list(decontaminate.blocks_of(lines, 800))) == 4  # the size does not depend on blanks
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 800)
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, benchmark).collect()} == {(i, i) for i, _ in items}
    empty = spark.createDataFrame([], BENCHMARK)
    assert decontaminate.contaminated(docs, empty).count() == 0 and decontaminate.drop_contaminated(docs, empty).count() == 12
    assert decontaminate.contaminated(docs_frame(spark, []), benchmark).count() == 0


@pytest.mark.parametrize("n", range(1, 6))
def test_short_items_are_found_whole_only(n):
    item = [f"t{i}" for i in range(n)]
    index = decontaminate.SeedIndex([(7, " ".join(item)), (8, " ".join(item)), (9, "")])
    filler = " ".join(f"f{i}" for i in range(9))
    hit, broken = f"{filler} {' '.join(item)} {filler}", f"{filler} {' '.join([*item[:-1], 'x'])} {filler}"
    (found,), none, alone = index.find([hit, broken, " ".join(item)])
    assert found[1:] == (9, 9 + n, 0, n) and index.ids[found[0]] == [7, 8] and not none and alone


def brute_hits(docs, items):
    """Every document and item with a window of the item's words that agrees well enough, by trying all shifts."""
    out = set()
    for d, text in docs:
        a = decontaminate.WORD.findall((text or "").lower())
        for i, item in items:
            b = decontaminate.WORD.findall((item or "").lower())
            need = min(decontaminate.WINDOW, len(b))
            least = (decontaminate.SHARE if need >= decontaminate.MIN_WORDS else 1) * need
            if any(sum(x == y for x, y in zip(a[s : s + need], b[k : k + need], strict=False)) >= least for k in range(len(b) - need + 1) for s in range(len(a) - need + 1) if need):
                out.add((d, i))
    return out


def test_contamination_matches_brute_force(spark):
    rng = random.Random(31)
    items = [(i, words(rng, n, 60)) for i, n in enumerate([3, 5, 6, 8, 11, 15, 16, 20, 30])] + [(20, None), (21, "")]
    rows = []
    for i in range(200):
        w = words(rng, rng.randrange(0, 60), 60).split()
        src = rng.choice(items[:9])[1].split()
        a = rng.randrange(len(src))
        part = [x if rng.random() > 0.15 else "zz" for x in src[a : a + rng.randrange(4, 25)]]
        at = rng.randrange(len(w) + 1)
        rows.append((i, " ".join(w[:at] + part + w[at:]), "en", "s", 1))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs_frame(spark, rows), spark.createDataFrame(items, BENCHMARK)).collect()}
    want = brute_hits([r[:2] for r in rows], items)
    assert got == want and len(want) > 10


# ---- main text

SHELL = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head><body>
<header><a href="/">Home</a></header><div class="cookie-notice">We use cookies</div><nav><ul><li><a href="/a">A</a></li></ul></nav>
<div class="layout"><div id="post-{i}"><h1>Title &amp; {i}</h1><p>First <b>bold</b>part&nbsp;of {text}<br>next<p>Second {i}</div>
<div class="col2"><p>All rights reserved.</p><p>Since 1999</p></div></div>
<aside>Side</aside><form><input value="x">Search</form><section class="comments"><p>Nice {i}!</p></section><footer>F {i}</footer></body></html>"""


def test_main_text(spark):
    rng = random.Random(9)
    rows = [(i, f"http://Host.example/{i}", SHELL.format(i=i, text=words(rng, 30, 10**6))) for i in range(12)]
    rows += [rows[0], (50, None, None), (51, "http://h", ""), (52, "not a url", "plain & text"), (None, "http://h/x", "<p>unclosed <i>it"), (53, "http://h", "<div>" * 2000 + "deep"), (54, "http://h", "<p a='<b>'>x</p><!-- <p>no</p> --> y <script>z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit(1), "path": F.lit(2), "low": F.lit("q"), "text": F.lit("z")})
    out = {r["page_id"]: r for r in html_text.extract_main_text(pages).collect()}
    for i in range(12):
        want = rows[i][2].split("part&nbsp;of ")[1].split("<br>")[0]
        # the boilerplate column is on every page of the host: its branch has no importance
        assert out[i]["text"] == f"Title & {i} First boldpart of {want} next Second {i}"
        assert out[i]["n_chars"] == len(out[i]["text"]) and out[i]["url"] == rows[i][1]
    assert [out[k]["text"] for k in (50, 51, 52, None, 53, 54)] == ["", "", "plain & text", "unclosed it", "deep", "x y"]
    assert html_text.extract_main_text(pages.limit(0)).count() == 0


def test_article_content_with_names_like_roles_stays(spark):
    inner = '<div class="related"><p>Related work</p></div><div id="social-history"><p>Society</p></div><table class="toc"><tr><td>Cell</td></tr></table><math>x</math>'
    drop = '<div class="ad">Buy</div><aside>Aside</aside><nav>Menu</nav><form>Search</form><div class="comments"><p>Nice</p></div><p hidden>no</p>'
    page = "<html><body><div class='topbar'>Bar</div><{w}><h1>Title {i}</h1>{inner}{drop}<p>Text {i}</p></{w}><footer>Foot</footer></body></html>"
    rows = [(i, f"http://h/{i}", page.format(i=i, w=w, inner=inner.replace("ork", f"ork {i}").replace("iety", f"iety {i}").replace("Cell", f"Cell {i}").replace("x<", f"x {i}<"), drop=drop)) for i, w in enumerate(["main", "article"] * 4)]
    rows += [(20 + i, f"http://w/{i}", f"<body><div class='sidebar-layout'><h1>T {i}</h1><p>All of the text {i}</p></div><div class='sidebar'>s{i}</div></body>") for i in range(6)]
    out = {r["page_id"]: r["text"] for r in html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == {i: f"Title {i} Related work {i} Society {i} Cell {i} x {i} Text {i}" for i in range(8)} | {20 + i: f"T {i} All of the text {i}" for i in range(6)}


def test_menus_go_without_any_mark(spark, monkeypatch):
    """Menus of links that differ from page to page, and what is on all pages, go by importance alone."""
    rng = random.Random(3)
    row = "<html><body><div class='xa'><ul>{links}</ul></div><div class='xb'><p>Rights reserved</p></div><div class='xc'><p>{text}</p></div></body></html>"
    rows = [(i, f"http://h/{i}", row.format(links="".join(f"<li><a href='/{w}'>{w}</a></li>" for w in words(rng, 5).split()), text=f"Text {words(rng, 20, 10**6)}")) for i in range(10)]
    out = html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r["text"].startswith("Text ") for r in out)


def brute_importance(pages):
    """Importance of every node of one host's tree, from the definition; pages differ in their main content."""
    import math
    from collections import defaultdict

    content, style, on, chars, links = defaultdict(Counter), defaultdict(Counter), defaultdict(set), Counter(), Counter()
    for k, page in enumerate(pages):
        found, styles = html_text.blocks(page)
        for path, text in {(b[0], b[1]) for b in found}:
            content[path][text] += 1
            on[0, path].add(k)
        for path, text, n, link in {(b[0], b[1], b[2], b[3]) for b in found}:
            chars[path] += n
            links[path] += link
        for path, children in set(styles):
            style[path][children] += 1
            on[1, path].add(k)
    own = {}
    for path in {p[: p.find(">", i)] if p.find(">", i) > 0 else p for p in content for i in [k + 1 for k, c in enumerate(p) if c == ">"]}:
        below = [q for q in content if q == path or q.startswith(path + ">")]
        total = sum(len(content[q]) for q in below)
        value = 0.0
        for q in below:
            m = len(on[0, q])
            mean = sum(math.log(c) / math.log(max(m, 2)) for c in content[q].values()) / len(content[q])
            value += (1.0 if m <= 1 else 1 - mean) * len(content[q]) / total
        if path in style:
            m = len(on[1, path])
            entropy = -sum(c / m * math.log(c / m) for c in style[path].values()) / math.log(max(m, 2)) if m > 1 else 1.0
            value = (1 - html_text.GAMMA) * entropy + html_text.GAMMA * value
        value *= 1 - sum(links[q] for q in below) / max(1, sum(chars[q] for q in below))
        marked = path.endswith(html_text.MARK) and sum(chars[q] for q in below) <= html_text.WRAPPER * sum(chars.values())
        own[path] = (len({k for q in below for k in on[0, q]}), max(len(on[0, q]) for q in below), value, html_text.MARKED if marked else 1)
    return own


def test_importance_matches_brute_force(spark):
    rng = random.Random(12)
    pages = [SHELL.format(i=i % 7, text=words(rng, 30, 10**6)) for i in range(12)]
    pages += [f"<html><body><article><h1>H {i}</h1><p>{words(rng, 9)}</p><p>same</p></article><nav><a href='/'>x {i % 3}</a> y</nav></body></html>" for i in range(9)]
    rows = [(i, "http://h/", p) for i, p in enumerate(pages)]
    hosted = html_text.with_host(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = {r["path"]: (r["pages"], r["importance"]) for r in html_text.branch_importance(html_text.tree_features(hosted)).collect()}
    want = brute_importance(pages)
    assert got.keys() == {p for p in want if p.count(">") >= 1} and len(want) > 15
    for path, (_, most, value, mark) in want.items():
        seen = most - 1
        prior = (seen * value + 1) / (seen + 1)  # one host: the corpus is this host and a page of importance 1
        assert got[path][0] == most and got[path][1] == pytest.approx(mark * (seen * value + html_text.PRIOR_PAGES * prior) / (seen + html_text.PRIOR_PAGES)), path


@pytest.mark.parametrize("wrap", ["article", "div"])
def test_copies_of_few_articles_keep_their_text(spark, wrap):
    texts = [f"Report {k} on rivers and lakes of the north." for k in range(2)]
    page = "<html><body><div class='ad-box'>Offer {i}</div><div class='left'><a href='/{i}'>Link {i}</a></div><{w}><p>{t}</p></{w}></body></html>"
    rows = [(i, "http://mirror.org/%d" % i, page.format(i=i, t=texts[i % 2], w=wrap)) for i in range(12)]
    rows += [(20 + i, "http://one.org/%d" % i, page.format(i=i, t=texts[0], w=wrap)) for i in range(6)]
    out = html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(texts[r["page_id"] % 2 if r["page_id"] < 20 else 0] in r["text"] for r in out) and len(out) == 18


def test_importance_follows_entropy(spark):
    rng = random.Random(10)
    rows = [(i, "http://h/", SHELL.format(i=i, text=words(rng, 30, 10**6))) for i in range(10)]
    rows += [rows[0]] * 30  # equal pages count once
    pages = html_text.with_host(spark.createDataFrame(rows, "page_id long, url string, html string"))
    held = {r["path"]: r for r in html_text.branch_importance(html_text.tree_features(pages)).collect()}
    body = ">html>body>div.layout"
    assert held[f"{body}>div.col"]["importance"] < 0.1 < 0.8 < held[f"{body}>div.post->p"]["importance"]
    assert held[f"{body}>div.col"]["pages"] == 10


@pytest.mark.parametrize(
    ("page", "found"),
    [("<a " * 300_000, 1), ("<div>" * 100_000 + "deep", 1), ("<a \"" * 200_000, 1), ("<a '\"" * 150_000, 1), ("<div>" * 50_000 + "</p>" * 50_000, 0), ("<script>" * 100_000, 0), ("<!x " * 200_000, 1), ("<div>x" * 30_000, 30_000)],
)
def test_hostile_pages_take_linear_time_and_memory(page, found):
    import time
    import tracemalloc

    began = time.process_time()
    assert len(html_text.blocks(page)[0]) == found
    assert time.process_time() - began < 20
    tracemalloc.start()
    html_text.blocks(page[: len(page) // 8])
    assert tracemalloc.get_traced_memory()[1] < 200 * len(page)
    tracemalloc.stop()


def test_small_hosts_lean_on_the_corpus(spark):
    rng = random.Random(13)
    pages = [(i, f"http://h{i // 10 if i < 40 else i}/", SHELL.format(i=i, text=words(rng, 30, 10**6))) for i in range(44)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    out = {r["page_id"]: r["text"] for r in html_text.extract_main_text(df).collect()}
    # hosts of one page lose the column that is boilerplate on all other hosts, and keep their text
    assert all("All rights" not in t and "Second" in t for t in out.values())


# ---- toxicity


def test_toxic_documents_are_scored_and_tagged(spark):
    rng = random.Random(11)
    bad = ["idiot", "scumbag", "moronic"]
    rows, labels = [], []
    for i in range(900):
        w = words(rng, 60, 3000).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                w[rng.randrange(60)] = rng.choice(bad).capitalize() + rng.choice(["", "!", ","])
        rows.append((i, " ".join(w), "en", "s", 1))
        if i % 3:
            labels.append((i, 1, int(toxic)))
    labels += [(None, 1, 1), (5, 1, None), (1, 1, 0), (10**9, 1, 1)]
    held = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = docs_frame(spark, rows)
    tagger = toxicity.train_on(docs, held)
    out = toxicity.score_documents(docs, tagger).collect()
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)
    unseen = [r for r in out if r["held_out"]]
    assert sum(r["predicted"] == int(r["doc_id"] % 5 == 0) for r in unseen) >= 0.98 * len(unseen)
    text = "w1 w2 idiot! scumbag w3 " + words(rng, 30)
    (span,) = tagger.scored([text])[1][0]
    assert text[span[0] : span[1]] == "idiot! scumbag" and span[2] > 0.5
    spans = toxicity.toxic_spans(docs, tagger).count()
    assert 150 <= spans <= 200
    awkward_out = toxicity.score_documents(docs_frame(spark, awkward(rng), True), tagger).collect()
    assert len(awkward_out) == len(awkward(rng)) and all(0 <= r["score"] <= 1 for r in awkward_out)
    assert toxicity.score_documents(docs_frame(spark, []), tagger).count() == 0
    # the bound in bytes passes a text over that is longer alone, and reads it no further
    whole = {tuple(r) for r in toxicity.score_documents(docs, tagger).select("doc_id", "predicted").collect()}
    huge = docs.union(docs_frame(spark, [(6002, "idiot " * 200_000, "en", "s", 1)])).alias("d")
    more = held.union(spark.createDataFrame([(6002, 1, 1)], held.schema))
    least = toxicity.train_on(huge, more, most_bytes=1_000_000)
    assert (least.weights == tagger.weights).all() and {tuple(r) for r in toxicity.score_documents(docs, least).select("doc_id", "predicted").collect()} == whole
    assert toxicity.train_on(docs, held, most_bytes=50_000).weights.any() and not toxicity.train_on(docs, held, most_bytes=5).weights.any()
    none = toxicity.train_on(docs, held.where("toxic = 0"))
    assert {r["predicted"] for r in toxicity.score_documents(docs, none).collect()} == {0}
    assert {r["predicted"] for r in toxicity.score_documents(docs, toxicity.train_on(docs, held.limit(0))).collect()} == {0}


def test_marginals_match_enumeration():
    rng = np.random.default_rng(12)
    emission, t = rng.normal(size=(3, 6)), rng.normal(size=(2, 2))
    got = toxicity.marginals(emission, t)[2]
    for row, p in zip(emission, got, strict=True):
        total = np.zeros(6)
        norm = 0.0
        for code in range(64):
            y = [code >> k & 1 for k in range(6)]
            weight = np.exp(sum(e * s for e, s in zip(row, y, strict=True)) + sum(t[a, b] for a, b in zip(y, y[1:], strict=False)))
            total += weight * np.array(y)
            norm += weight
        assert np.allclose(total / norm, p)


def test_long_chains_are_not_cut():
    rng = np.random.default_rng(14)
    t, lengths = rng.normal(size=(2, 2)) * 2, np.array([1, 300, 0, 64, 65, 128, 7, 1000])
    chains = [rng.normal(size=n) * 2 for n in lengths]
    place, first = toxicity.rows_of(lengths, 16)
    table, real = np.full(len(first) * 16, 9.0), np.zeros(len(first) * 16, bool)
    table[place], real[place] = np.concatenate(chains), True
    got = toxicity.marginals(table.reshape(-1, 16), t, real.reshape(-1, 16), first)[2].reshape(-1)[place]
    want = [toxicity.marginals(c[None, :], t)[2][0] for c in chains if len(c)]
    assert np.allclose(got, np.concatenate(want), atol=1e-9)
