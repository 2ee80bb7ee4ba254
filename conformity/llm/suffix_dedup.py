"""Removal of repeated long byte strings with run-length indexes.

A byte is removed if some ``LENGTH``-byte string that covers it also starts anywhere else in the corpus.

1. *Anchors.* Each window of ``LENGTH`` bytes picks its least ``GRAM``-byte gram (leftmost of equal ones);
   runs of windows with one pick are an anchor: the gram's hash, the window starts [lo, hi], and a 128-bit
   digest of the bytes they span. Equal windows pick the same gram at the same place, so they belong to
   anchors with one hash, wherever they are. Each window belongs to exactly one anchor.
2. *Classes.* Anchors with equal hash and digest are one class and counted. A hash seen once holds no
   repeat; what has one seen more often is a repetitive collection.
   All starts of a class that is counted twice are repeats: that is decided by counting, on 128-bit digests,
   not by an index.
3. *Indexes.* The bytes of one occurrence of each class are fetched, and batches of whole hashes are
   indexed. The index is the Burrows-Wheeler transform in runs with the text positions of the run ends. It has
   the string of a class once; that a class has copies is an input of its statistics (a match to the string's end).
   Longest matches with the neighbours in suffix order are computed at run ends only; along the text they
   fall by one per byte until the next sampled position (which holds for all positions inside runs), so a
   single stream over the text gives every position's matching statistic against all other positions.
   Starts with a statistic of ``LENGTH`` or more are repeats.
4. *Heavy hashes* (more than ``HEAVY`` classes) are not put in one index: their windows are split by their
   distance from the gram into ranges with the bytes common to the range as a longer anchor, and the ranges
   are indexed. Ranges that still have more than ``HEAVY`` classes are decided window by window on 128-bit
   digests, all in shuffles with partial counts.

Repeated starts go back to the anchors of all documents and from there to byte spans of documents.

Passages of ``n`` words that occur elsewhere are found too, however few bytes they have: ``dedup_report`` counts them
beside what is removed, ``remove_repeats(words=n)`` also cuts them. The
steps are the same with words (between white space) as symbols: windows of ``n`` words pick a gram of ``WORD_GRAM``
words, classes still compare bytes, and indexes hold words, so that white space between them may differ. Words are
compared by 64-bit hashes. The windows of heavy hashes are decided on 128-bit digests at once, since an anchor has
few windows of words.

Null texts are empty. Texts shorter than ``LENGTH`` have nothing to remove. Repeated rows are strings that
also start elsewhere. Rows with null doc_id take part like others. An empty table gives no rows. When
removal cuts a character, its remaining bytes count in the byte results; the text returned by
``remove_repeats`` leaves such fragments out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import BROADCAST_ROWS, claim, drop_saved, prepare, saved, small

LENGTH = 400
GRAM = 100
#: Bytes of text that one index covers at most (apart from a single hash's classes).
INDEX_BYTES = 1 << 19
HEAVY = 1000
RANGE = 16
WORD_GRAM = 8
#: Passages of over 50 words are reported.
PASSAGE_WORDS = 51
#: Bytes whose windows are picked at once; positions inside need ``POSITION`` bits.
CHUNK, POSITION = 1 << 20, 21
ANCHORS = "h long, rh binary, k1 long, k2 long, lo int, hi int"

_table = np.random.default_rng(4711).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_base = 0x9E3779B97F4A7C15 | 5
_inverse = pow(_base, -1, 1 << 64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of them."""
    if 0 not in _powers or len(_powers[0][0]) < n:
        n = max(n, CHUNK + LENGTH)
        both = []
        for b in (_base, _inverse):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _powers[0] = (both[0], both[1])
    return _powers[0]


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes, or symbols of 64 bits, at each position."""
    q, down = _sums(data if data.dtype == np.uint64 else _table[data])
    return _mixed((q[gram:] - q[:-gram]) * down[: len(data) - gram + 1])


def _sums(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of values times powers up to each position, and the powers that undo a start's."""
    up, down = _power(len(values) + 1)
    q = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=q[1:])
    return q, down


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word, and the byte after its last."""
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    return edges[::2], edges[1::2]


def word_symbols(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and the words' bounds."""
    first, after = word_bounds(data)
    q, down = _sums(_table[data])
    return _mixed((q[after] - q[first]) * down[first]), first, after


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of every ``width`` neighbours."""
    n = len(values)
    pad = -n % width
    v = np.concatenate([values, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(v, axis=1).ravel()
    back = np.minimum.accumulate(v[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def pick_anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, gram position, first start, last start) of the anchors of concatenated texts ending at ``ends``."""
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    h = gram_hashes(data, gram)
    mask = np.uint64((1 << POSITION) - 1)
    least = sliding_least((h & ~mask) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
    pick = (least & mask).astype(np.int64)
    # windows that lie in one text; the text's number breaks runs between texts
    text = np.searchsorted(ends, np.arange(len(pick)), "right")
    inside = np.arange(len(pick)) + length <= ends[np.minimum(text, len(ends) - 1)]
    pick = np.where(inside, pick, -1)
    cut = np.flatnonzero(np.diff(pick)) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut - 1, [len(pick) - 1]])
    real = pick[first] >= 0
    first, last = first[real], last[real]
    at = pick[first]
    return h[at].view(np.int64), at, first, last


def keyed(docs: DataFrame) -> DataFrame:
    """k1, k2 (of doc_id and text) and the text of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("k1"), F.xxhash64(text).alias("k2"), text.alias("text"))


def _least_bytes(words: int | None) -> int:
    """What a text must have to hold a window."""
    return LENGTH if words is None else 2 * words - 1


def anchors(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The anchors of all texts (columns of ``ANCHORS``)."""

    def emit(keys: list, texts: list[bytes], bases: list[int]) -> pa.RecordBatch:
        joined = b"".join(texts)
        data = np.frombuffer(joined, np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        h, at, first, last = pick_anchors(data, ends, length, gram)
        owner = np.searchsorted(ends, first, "right")
        start = np.concatenate([[0], ends[:-1]])[owner] - np.array(bases, np.int64)[owner]
        view = memoryview(joined)
        digest = xxhash.xxh3_128_digest
        rh = [digest(view[a : b + length], seed=p - a) for a, b, p in zip(first.tolist(), last.tolist(), at.tolist(), strict=True)]
        k1, k2 = np.array([k for k, _ in keys], np.int64)[owner], np.array([k for _, k in keys], np.int64)[owner]
        return pa.RecordBatch.from_arrays(
            [pa.array(h), pa.array(rh, pa.binary()), pa.array(k1), pa.array(k2), pa.array((first - start).astype(np.int32)), pa.array((last - start).astype(np.int32))],
            names=["h", "rh", "k1", "k2", "lo", "hi"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("suffix", _powers.clear)
        keys, texts, bases, held = [], [], [], 0
        for batch in batches:
            for k1, k2, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                # a long text goes in pieces that overlap by length - 1 bytes: each window is in one piece
                for at in range(0, max(1, len(data) - length + 1), CHUNK // 2):
                    piece = data[at : at + CHUNK // 2 + length - 1]
                    if len(piece) < length:
                        continue
                    if held + len(piece) > CHUNK:
                        yield emit(keys, texts, bases)
                        keys, texts, bases, held = [], [], [], 0
                    keys.append((k1, k2)), texts.append(piece), bases.append(at)
                    held += len(piece)
        if texts:
            yield emit(keys, texts, bases)

    return keyed(docs).where(F.octet_length("text") >= length).mapInArrow(run, ANCHORS)


def word_pieces(data: bytes, words: int) -> Iterator[tuple[int, bytes]]:
    """Parts of a text, each with its place, so that every window of ``words`` words lies in one."""
    if len(data) <= CHUNK // 2:
        yield 0, data
        return
    first, after = word_bounds(np.frombuffer(data, np.uint8))
    a = 0
    while a + words <= len(first):
        b = min(max(int(np.searchsorted(after, first[a] + CHUNK // 2, "right")), a + words), len(first))
        yield int(first[a]), data[first[a] : after[b - 1]]
        a = b - words + 1


def word_anchors(docs: DataFrame, words: int) -> DataFrame:
    """Like ``anchors`` for windows of ``words`` words; ``lo`` is the first one's byte, the last ends at ``hi + LENGTH``."""

    def emit(keys: list, texts: list[bytes], bases: list[int]) -> pa.RecordBatch:
        joined = b"\n".join(texts)
        symbols, start, after = word_symbols(np.frombuffer(joined, np.uint8))
        ends = np.cumsum([len(t) + 1 for t in texts])
        h, at, first, last = pick_anchors(symbols, np.searchsorted(start, ends), words, WORD_GRAM)
        lo, hi = start[first], after[last + words - 1]
        owner = np.searchsorted(ends, lo, "right")
        begin = np.concatenate([[0], ends[:-1]])[owner] - np.array(bases, np.int64)[owner]
        view = memoryview(joined)
        digest = xxhash.xxh3_128_digest
        rh = [digest(view[a:b], seed=p) for a, b, p in zip(lo.tolist(), hi.tolist(), (at - first).tolist(), strict=True)]
        k1, k2 = np.array([k for k, _ in keys], np.int64)[owner], np.array([k for _, k in keys], np.int64)[owner]
        return pa.RecordBatch.from_arrays(
            [pa.array(h), pa.array(rh, pa.binary()), pa.array(k1), pa.array(k2), pa.array((lo - begin).astype(np.int32)), pa.array((hi - begin - LENGTH).astype(np.int32))],
            names=["h", "rh", "k1", "k2", "lo", "hi"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("suffix", _powers.clear)
        keys, texts, bases, held = [], [], [], 0
        for batch in batches:
            for k1, k2, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for at, piece in word_pieces(text.encode("utf-8", "surrogatepass"), words):
                    if texts and held + len(piece) + 1 > CHUNK:
                        yield emit(keys, texts, bases)
                        keys, texts, bases, held = [], [], [], 0
                    keys.append((k1, k2)), texts.append(piece), bases.append(at)
                    held += len(piece) + 1
        if texts:
            yield emit(keys, texts, bases)

    return keyed(docs).where(F.octet_length("text") >= _least_bytes(words)).mapInArrow(run, ANCHORS)


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffix array of ``symbols`` and the ranks of prefixes of 1, 2, 4, ... symbols, by doubling.

    The shortest prefixes are their own ranks, as numbers; later rounds sort only suffixes that are still
    equal. A rank is the place of the first of equal prefixes. The last symbol must occur once.
    """
    n, size = len(symbols), 1
    key, width = symbols.astype(np.int64) + 1, int(symbols.max()) + 2
    ranks: list[tuple[int, np.ndarray]] = [(1, key)]
    while width <= 1 << 31 and size < n:
        after = np.zeros(n, np.int64)
        after[:-size] = key[size:]
        key, width, size = key * width + after, width * width, size * 2
        ranks.append((size, key))
    ranks.pop()
    order = np.argsort(key)
    places, suffixes, keys = np.arange(n), order, key[order]
    rank = np.zeros(n, np.int32)
    while True:
        head = np.concatenate([[True], keys[1:] != keys[:-1]])
        rank = rank.copy()
        rank[suffixes] = places[np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))]
        ranks.append((size, rank))
        equal = ~(head & np.concatenate([head[1:], [True]]))
        if not equal.any():
            return order, ranks
        places, suffixes = places[equal], suffixes[equal]
        after = np.where(suffixes + size < n, rank[np.minimum(suffixes + size, n - 1)] + 1, 0)
        keys = rank[suffixes] * np.int64(n + 1) + after
        sort = np.argsort(keys)
        suffixes, keys = suffixes[sort], keys[sort]
        order[places] = suffixes
        size *= 2


def common_prefix(a: np.ndarray, b: np.ndarray, ranks: list[tuple[int, np.ndarray]], least: int = 1) -> np.ndarray:
    """Longest common prefixes of suffixes a and b, from the ranks of doubled prefixes; those below ``least`` may be 0."""
    n = len(ranks[0][1])
    out = np.zeros(len(a), np.int64)
    size, rank = max((r for r in ranks if r[0] <= least), key=lambda r: r[0])
    if size > 1:  # most neighbours share less
        some = np.flatnonzero(rank[a] == rank[b])
        out[some] = common_prefix(a[some], b[some], ranks)
        return out
    for size, rank in reversed(ranks):
        x, y = a + out, b + out
        inside = (x < n) & (y < n)
        same = inside & (rank[np.minimum(x, n - 1)] == rank[np.minimum(y, n - 1)])
        out += np.where(same, size, 0)
    return out


class RunLengthIndex:
    """Run-length Burrows-Wheeler transform of some strings with text positions sampled at run ends.

    Strings are bytes, or arrays of small numbers.
    ``copies`` says how often each string occurs (once unless given). Copies are not put into the transform, whose
    runs they would only make longer: the start of a string with copies is a further sample, which matches to the
    string's end. Matches shorter than ``least`` may count as none.
    """

    def __init__(self, strings: list[bytes] | list[np.ndarray], copies: list[int] | None = None, least: int = 1):
        self.lengths = np.array([len(s) for s in strings], np.int64)
        self.ends = np.cumsum(self.lengths + 1) - 1
        if isinstance(strings[0], bytes):
            joined = np.frombuffer(b"".join(s + b"\0" for s in strings), np.uint8)
            # few numbers, so that many symbols are sorted at once
            joined = np.cumsum(np.bincount(joined, minlength=256) > 0)[joined] + 1
        else:
            joined = np.concatenate([x for s in strings for x in (s, np.zeros(1, np.int64))]) + 2
        # strings end with the same symbol, the last with one of its own: matches may run over it, and are cut there by
        # ``statistics``
        joined[self.ends] = 1
        joined[-1] = 0
        order, ranks = suffix_order(joined)
        transform = joined[order - 1]
        head = np.concatenate([[True], transform[1:] != transform[:-1]])
        self.run_heads = np.flatnonzero(head)
        self.run_symbols = transform[self.run_heads]
        tails = np.concatenate([self.run_heads[1:] - 1, [len(order) - 1]])
        self.head_positions, self.tail_positions = order[self.run_heads], order[tails]
        # matches with the suffix before a run's head and after its tail
        self.head_matches, self.tail_matches = np.zeros(len(tails), np.int64), np.zeros(len(tails), np.int64)
        if len(tails) > 1:
            between = common_prefix(self.tail_positions[:-1], self.head_positions[1:], ranks, least)
            self.head_matches[1:] = between
            self.tail_matches[:-1] = between
        self.size = len(order)
        several = np.array(copies if copies is not None else [1] * len(strings), np.int64) > 1
        self.copied_starts = (self.ends - self.lengths)[several]
        self.copied_matches = self.lengths[several]

    def statistics(self) -> np.ndarray:
        """For every text position the longest match with any other position, streamed from the samples."""
        here = np.arange(self.size)
        best = np.zeros(self.size, np.int64)
        sampled = ((self.head_positions, self.head_matches), (self.tail_positions, self.tail_matches), (self.copied_starts, self.copied_matches))
        for positions, matches in sampled:
            reach = np.full(self.size, -1, np.int64)
            reach[positions] = matches + positions
            np.maximum(best, np.maximum.accumulate(reach) - here, out=best)
        return np.minimum(best, np.repeat(self.ends, self.lengths + 1) - here)

    def long_starts(self, length: int) -> list[np.ndarray]:
        """For every string the starts whose ``length`` bytes also start elsewhere."""
        marks = self.statistics() >= length
        out, at = [], 0
        for n in self.lengths.tolist():
            out.append(np.flatnonzero(marks[at : at + n]))
            at += n + 1
        return out


def ranges(starts: np.ndarray) -> list[tuple[int, int]]:
    """Runs of consecutive numbers as (first, last)."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.concatenate([[0], cut + 1])].tolist(), starts[np.concatenate([cut, [len(starts) - 1]])].tolist(), strict=True))


def _classes(table: DataFrame, carried: list[str]) -> DataFrame:
    """Classes (h, rh) of a table with their count, one occurrence ``rep``, and the hash's class count and its least
    count of a class; hashes seen once are left out."""
    weight = F.sum("cnt") if "cnt" in table.columns else F.count(F.lit(1))
    hashes = saved(table.groupBy("h").agg(weight.alias("seen")).where("seen > 1").select("h"), "repeat-hashes")
    n = hashes.count()
    if n <= BROADCAST_ROWS:  # other rows are neither sorted nor shuffled
        table = table.join(small(hashes, n), "h", "left_semi")
    classes = table.groupBy("h", "rh").agg(weight.alias("cnt"), F.min(F.struct(*carried)).alias("rep"))
    held = saved(classes if n <= BROADCAST_ROWS else classes.join(hashes, "h"), "repeat-classes")
    drop_saved(hashes)
    many = held.groupBy("h").agg(F.count(F.lit(1)).alias("classes"), F.min("cnt").alias("least"))
    return saved(held.join(many, "h"), "repeat-counts")


def _texts_of(wanted: DataFrame, docs: DataFrame, name: str, least: int) -> DataFrame:
    """h, rh, cnt, classes and the bytes of one occurrence of every class in ``wanted``, from texts of ``least`` bytes."""
    by_doc = wanted.groupBy(F.col("rep.k1").alias("k1"), F.col("rep.k2").alias("k2")).agg(
        F.collect_list(F.struct("h", "rh", "cnt", "classes", F.col("rep.lo").alias("lo"), F.col("rep.hi").alias("hi"))).alias("want")
    )
    by_doc = saved(by_doc, f"{name}-docs")
    source = keyed(docs).where(F.octet_length("text") >= least)
    n = by_doc.count()
    if n <= BROADCAST_ROWS:  # texts without such a class are not shuffled
        source = source.join(small(by_doc.select("k1", "k2"), n), ["k1", "k2"], "left_semi")
    met = source.join(by_doc, ["k1", "k2"])
    # repeated rows of a document bring the same bytes: one of them stays
    sliced = met.select(F.encode("text", "UTF-8").alias("text"), F.explode("want").alias("w")).select(
        "w.*", F.substring("text", F.col("w.lo") + 1, F.col("w.hi") - F.col("w.lo") + LENGTH).alias("bytes")
    )
    return saved(sliced, name)


def _word_parts(strings: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Symbols of the words of each string, and their bounds in it."""
    symbols, first, after = word_symbols(np.frombuffer(b"\n".join(strings), np.uint8))
    begin = np.concatenate([[0], np.cumsum([len(s) + 1 for s in strings])])
    at = np.searchsorted(first, begin)
    return [(symbols[a:b], first[a:b] - c, after[a:b] - c) for a, b, c in zip(at[:-1].tolist(), at[1:].tolist(), begin.tolist(), strict=False)]


def _indexed(regions: DataFrame, words: int | None = None) -> DataFrame:
    """h, rh, first, last: runs of window starts (from the class's first) that start elsewhere too.

    With ``words``, windows are of so many words, and a run's last window ends ``LENGTH`` bytes after ``last``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("suffix", _powers.clear)
        rows: list[tuple[int, bytes, bytes, int]] = []
        held, last, seen = 0, None, set()

        def flush() -> pa.RecordBatch:
            out: tuple[list, ...] = ([], [], [], [])
            strings, copies = [r[2] for r in rows], [r[3] for r in rows]
            if words is None:
                found = [ranges(starts) for starts in RunLengthIndex(strings, copies, LENGTH).long_starts(LENGTH)]
            else:
                parts = _word_parts(strings)
                numbers = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)[1].astype(np.int64)
                index = RunLengthIndex(np.split(numbers, np.cumsum([len(p[0]) for p in parts])[:-1]), copies, words)
                found = [
                    [(int(first[a]), int(after[b + words - 1]) - LENGTH) for a, b in ranges(starts)]
                    for (_, first, after), starts in zip(parts, index.long_starts(words), strict=True)
                ]
            for (h, rh, *_), spans in zip(rows, found, strict=True):
                for a, b in spans:
                    for column, value in zip(out, (h, rh, a, b), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["h", "rh", "first", "last"])

        for batch in batches:
            for h, rh, data, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if h != last:
                    seen = set()
                    if held > INDEX_BYTES:
                        yield flush()
                        rows, held = [], 0
                    last = h
                if rh not in seen:
                    seen.add(rh)
                    rows.append((h, rh, data, copies))
                    held += len(data)
        if rows:
            yield flush()

    dealt = regions.select("h", "rh", "bytes", "cnt").repartition("h").sortWithinPartitions("h", "rh")
    return dealt.mapInArrow(run, "h long, rh binary, first int, last int")


def _heavy(regions: DataFrame) -> DataFrame:
    """Like ``_indexed``, for hashes with any number of classes: ranges of windows, then single windows."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("suffix", _powers.clear)
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            out: tuple[list, ...] = tuple([] for _ in range(7))
            for h, rh, cnt, data in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                n = len(data) - LENGTH + 1
                at = int(np.argmin(gram_pick(data)))
                # windows by their distance from the gram: the range's common bytes are its anchor
                a = 0
                while a < n:
                    q = (at - a) // RANGE
                    b = min(n - 1, at - q * RANGE)
                    core = data[at - q * RANGE : at - q * RANGE - RANGE + 1 + LENGTH]
                    name = xxhash.xxh3_64_intdigest(core, seed=(h + q) & (1 << 63) - 1) - (1 << 63)
                    part = data[a : b + LENGTH]
                    for column, value in zip(out, (name, digest(part, seed=b - a), h, rh, a, part, cnt), strict=True):
                        column.append(value)
                    a = b + 1
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.int64())
            names = ["h", "rh", "of_h", "of_rh", "lo", "bytes", "cnt"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            out: tuple[list, ...] = tuple([] for _ in range(5))
            for h, rh, data, cnt in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                for s in range(len(data) - LENGTH + 1):
                    for column, value in zip(out, (h, rh, s, digest(data[s : s + LENGTH]), cnt), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["h", "rh", "start", "digest", "cnt"])

    once = regions.dropDuplicates(["h", "rh"]).select("h", "rh", "cnt", "bytes")
    parts = saved(once.mapInArrow(split, "h long, rh binary, of_h long, of_rh binary, lo int, bytes binary, cnt long"), "repeat-parts")
    classes = parts.groupBy("h", "rh").agg(F.sum("cnt").alias("cnt"), F.first("bytes").alias("bytes"))
    hashes = parts.groupBy("h").agg(F.sum("cnt").alias("seen")).where("seen > 1").select("h")
    classes = saved(classes.join(hashes, "h"), "repeat-part-sums")
    classes = saved(classes.join(classes.groupBy("h").agg(F.count(F.lit(1)).alias("classes")), "h"), "repeat-part-classes")
    marked = _indexed(classes.where(F.col("classes") <= HEAVY))
    many = classes.where(F.col("classes") > HEAVY).select("h", "rh", "bytes", "cnt")
    if many.limit(1).count():
        single = saved(many.mapInArrow(windows, "h long, rh binary, start int, digest binary, cnt long"), "repeat-windows")
        twice = single.groupBy("h", "digest").agg(F.sum("cnt").alias("n")).where("n > 1").select("h", "digest")
        some = single.join(twice, ["h", "digest"]).select("h", "rh", F.col("start").alias("first"), F.col("start").alias("last"))
        marked = marked.unionByName(some)
    return parts.drop("bytes", "cnt").join(marked, ["h", "rh"]).select(
        F.col("of_h").alias("h"), F.col("of_rh").alias("rh"), (F.col("lo") + F.col("first")).alias("first"), (F.col("lo") + F.col("last")).alias("last")
    )


def _heavy_words(regions: DataFrame, words: int) -> DataFrame:
    """Like ``_indexed`` with ``words``, for hashes with any number of classes: every window on its digest."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("suffix", _powers.clear)
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            if not batch.num_rows:
                continue
            out: tuple[list, ...] = tuple([] for _ in range(6))
            hs, rhs, texts, counts = (batch.column(i).to_pylist() for i in range(4))
            for h, rh, cnt, (symbols, first, after) in zip(hs, rhs, counts, _word_parts(texts), strict=True):
                view = symbols.tobytes()
                for s in range(len(symbols) - words + 1):
                    window = (h, rh, int(first[s]), int(after[s + words - 1]) - LENGTH, digest(view[8 * s : 8 * (s + words)]), cnt)
                    for column, value in zip(out, window, strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["h", "rh", "first", "last", "digest", "cnt"])

    once = regions.dropDuplicates(["h", "rh"]).select("h", "rh", "bytes", "cnt")
    single = saved(once.mapInArrow(windows, "h long, rh binary, first int, last int, digest binary, cnt long"), "repeat-windows")
    twice = single.groupBy("h", "digest").agg(F.sum("cnt").alias("n")).where("n > 1").select("h", "digest")
    return single.join(twice, ["h", "digest"]).select("h", "rh", "first", "last")


def gram_pick(data: bytes) -> np.ndarray:
    """Order values of a region's grams that any of its windows can pick; the picked one is the least."""
    h = gram_hashes(np.frombuffer(data, np.uint8), GRAM)
    mask = np.uint64((1 << POSITION) - 1)
    n = len(data) - LENGTH + 1
    value = (h & ~mask) | np.arange(len(h), dtype=np.uint64)
    # all windows pick one gram, so it is within each: from the last start to the first window's last gram
    value[: n - 1] = np.iinfo(np.uint64).max
    value[LENGTH - GRAM + 1 :] = np.iinfo(np.uint64).max
    return value


def repeated_spans(docs: DataFrame, words: int | None = None) -> DataFrame:
    """k1, k2 and spans (array of [from, to) bytes, not merged) of every document with repeats, of ``LENGTH`` bytes or
    of so many ``words``."""
    prepare(docs.sparkSession)
    held = saved(anchors(docs) if words is None else word_anchors(docs, words), "repeat-anchors")
    classes = _classes(held, ["k1", "k2", "lo", "hi"])
    # passages of hashes whose classes all have copies are decided by counting alone
    unsure = classes if words is None else classes.where("least = 1")
    regions = _texts_of(unsure, docs, "repeat-regions", _least_bytes(words))
    marks = _indexed(regions.where(F.col("classes") <= HEAVY), words)
    heavy = regions.where(F.col("classes") > HEAVY)
    if heavy.limit(1).count():
        marks = marks.unionByName(_heavy(heavy) if words is None else _heavy_words(heavy, words))
    if words is not None:
        whole = classes.where("least > 1").select("h", "rh", F.lit(0).alias("first"), (F.col("rep.hi") - F.col("rep.lo")).alias("last"))
        marks = marks.unionByName(whole)
    marks = saved(marks.groupBy("h", "rh").agg(F.collect_list(F.struct("first", "last")).alias("marks")), "repeat-marks")
    met = held.join(marks, ["h", "rh"]).select("k1", "k2", "lo", F.explode("marks").alias("m"))
    spans = met.select("k1", "k2", F.struct((F.col("lo") + F.col("m.first")).alias("a"), (F.col("lo") + F.col("m.last") + LENGTH).alias("b")).alias("s"))
    # bounded by a document's own length; equal rows of one document add nothing to the set
    out = saved(spans.groupBy("k1", "k2").agg(F.collect_set("s").alias("spans")), "repeat-spans")
    drop_saved(held, classes, regions, marks)
    return out


def merged(spans) -> list[tuple[int, int]]:
    """Maximal spans of a document's covered bytes."""
    out: list[list[int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans) if spans is not None else []:
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def kept_bytes(text: str | None, spans) -> tuple[bytes, list[tuple[int, int]]]:
    data = (text or "").encode("utf-8", "surrogatepass")
    gone = merged(spans)
    parts, at = [], 0
    for a, b in gone:
        parts.append(data[at:a])
        at = b
    parts.append(data[at:])
    return b"".join(parts), gone


def _with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("k1"),
        F.xxhash64(text).alias("k2"),
    )
    n = spans.agg(F.sum(sum(F.size(c) for c in spans.columns if c not in ("k1", "k2")))).first()[0] or 0
    return row.join(small(spans, n), ["k1", "k2"], "left")


def spans_and_passages(docs: DataFrame, words: int) -> DataFrame:
    """k1, k2, the spans of ``repeated_spans`` and, as ``passages``, those of passages of so many words."""
    spans, passages = repeated_spans(docs), repeated_spans(docs, words)
    both = spans.unionByName(passages.withColumnRenamed("spans", "passages"), allowMissingColumns=True)
    out = saved(both.groupBy("k1", "k2").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "passages")]), "repeat-both")
    drop_saved(spans, passages)
    return out


def dedup_report(docs: DataFrame, words: int = PASSAGE_WORDS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and repeated (whether bytes were removed) of every document.

    Passages of ``words`` words that occur elsewhere follow, of any number of bytes and removed or not: the bytes that
    they cover (n_passage_bytes), how many maximal runs these are (n_passages) and passage_repeated, whether there is one.
    """
    joined = _with_spans(docs.select("doc_id", F.col("text").cast("string").alias("text")), spans_and_passages(docs, words))

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for text, spans, passages in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                kept, gone = kept_bytes(text, spans)
                removed, held = sum(b - a for a, b in gone), merged(passages)
                row = (len(kept) + removed, removed, len(gone), hashlib.sha256(kept).hexdigest(), sum(b - a for a, b in held), len(held))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_bytes", "n_passages"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(out, kinds, strict=True)]], names=names)

    narrow = joined.select(F.col("__row.doc_id").cast("long").alias("doc_id"), F.col("__row.text").alias("text"), "spans", "passages")
    found = narrow.mapInArrow(report, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passage_bytes long, n_passages long")
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", (F.col("n_removed") > 0).alias("repeated"), "n_passage_bytes", "n_passages")
    return found.select(*columns, (F.col("n_passages") > 0).alias("passage_repeated"))


def remove_repeats(docs: DataFrame, words: int | None = None) -> DataFrame:
    """``docs`` with repeated strings cut out of ``text`` (and ``n_chars``, if it is there, counted anew).

    With ``words``, passages of so many words that occur elsewhere go too.
    """
    if words is None:
        spans = repeated_spans(docs)
    else:
        spans = spans_and_passages(docs, words).select("k1", "k2", F.concat("spans", "passages").alias("spans"))
    joined = _with_spans(docs, spans)

    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if s is None or t is None else kept_bytes(t, s)[0].decode("utf-8", "ignore") for t, s in zip(texts, spans, strict=True)])

    text = F.when(F.col("spans").isNull(), F.col("__row.text")).otherwise(pandas_udf(cut, "string")(F.col("__row.text").cast("string"), "spans"))
    out = joined.withColumn("__text", text)
    columns: list[Column] = []
    for c in docs.columns:
        value = F.col("__text") if c == "text" else F.length("__text").cast(docs.schema[c].dataType) if c == "n_chars" else F.col(f"__row.`{c}`")
        columns.append(value.alias(c))
    return out.select(*columns)


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
