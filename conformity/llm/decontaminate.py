"""Benchmark decontamination with spaced seeds.

Words (``\\w+``, lower case) become 64-bit hashes. A seed is the hash of the words that a fixed mask picks
from consecutive words; the masks of an item's length ignore different positions, so that a passage with
as many words replaced as are allowed still has a seed in common with its item, wherever they are. Seeds of every document meet the seeds of all benchmark
items in a hash join (a bitmap, then the sorted seeds); each hit fixes an alignment, and the alignment is
verified on the words themselves: a document is contaminated by an item if some ``WINDOW`` consecutive
words of the item (all of it, if it is shorter) agree with the document's in at least ``SHARE`` of the
places.

Items of under ``MIN_WORDS`` words allow no replaced word: they are found where all their words follow one
another. An item's passage of under ``WINDOW`` words is no evidence, wherever in a document it stands.

The benchmark goes through the documents in blocks of about ``BLOCK_BYTES`` bytes of text, each small
enough to be with every task; documents are never shuffled. Items with equal words are searched once and
reported each. Null items and items without words are in no document. Null and empty texts have no hits.
Repeated rows are reported each. With an empty table there are no hits.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import claim, prepare

#: Positions that count, by mask, for items of at least so many words: wherever the replaced words that ``SHARE``
#: allows in the shortest such item (or ``WINDOW``) are, some mask at some start picks none of them.
MASKS = {
    15: ((0, 1, 2, 4, 6, 7), (0, 1, 4, 8, 9, 10), (0, 1, 3, 7, 10, 11), (0, 1, 3, 6, 8, 9), (0, 1, 2, 7, 11, 12), (0, 3, 8, 10, 11, 12)),
    11: (
        (0, 1, 2, 4, 5, 6), (0, 1, 2, 5, 7, 8), (0, 1, 3, 6, 7, 8), (0, 3, 4, 5, 6, 7),
        (0, 1, 2, 9, 10, 11), (0, 1, 2, 3, 4, 7), (0, 1, 5, 7, 9, 10), (0, 3, 5, 6, 8, 11),
    ),
    7: ((0, 1, 2, 3, 5), (0, 3, 4, 5, 6), (0, 1, 2, 5, 6), (0, 1, 2, 4, 7), (0, 2, 4, 6, 7), (0, 1, 3, 4, 5), (0, 1, 3, 6, 7)),
    6: ((0, 1, 2, 3, 4), (0, 1, 2, 3, 5), (0, 1, 2, 4, 5), (0, 1, 3, 4, 5), (0, 2, 3, 4, 5)),
    **{n: (tuple(range(n)),) for n in range(1, 6)},
}
WINDOW, SHARE = 16, 0.75
MIN_WORDS = 6
BLOCK_BYTES = 8 << 20
#: Bytes of blocks whose indexes a worker keeps, and characters of text that meet each of several blocks together.
INDEXED_BYTES, GROUP_CHARS = 32 << 20, 16 << 20
KEPT_WORDS = 150_000
WORD = re.compile(r"\w+")
MULTIPLIERS = np.array([xxhash.xxh3_64_intdigest(str(i)) | 1 for i in range(13)], np.uint64)
HITS = "doc_id long, item_id long, start_word int, end_word int, item_start int, n_equal int"
_hashes: dict[str, int] = {}


def word_hashes(text: str) -> np.ndarray:
    words = WORD.findall(text.lower())
    if len(_hashes) > KEPT_WORDS:
        _hashes.clear()
    try:
        return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    except KeyError:
        for w in set(words):
            if w not in _hashes:
                _hashes[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def seeds(h: np.ndarray, mask: tuple[int, ...], number: int) -> np.ndarray:
    """Seed of each start in ``h``; masks are told apart by their number."""
    n = len(h) - max(mask)
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, number * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
    for j in mask:
        out += h[j : j + n] * MULTIPLIERS[j]
    return out ^ (out >> np.uint64(29))


class SeedIndex:
    """The seeds of a block of benchmark items."""

    BITS = 22

    def __init__(self, items: list[tuple[int, str]]):
        by_words: dict[bytes, tuple[np.ndarray, list[int]]] = {}
        for item_id, text in items:
            h = word_hashes(text or "")
            by_words.setdefault(h.tobytes(), (h, []))[1].append(item_id)
        self.words = [h for h, _ in by_words.values()]
        self.ids = [ids for _, ids in by_words.values()]
        least = [max((n for n in MASKS if n <= len(h)), default=0) for h in self.words]
        numbered = {n: [(mask, 100 * n + i) for i, mask in enumerate(MASKS[n])] for n in sorted(set(least) - {0})}
        self.masks: list[tuple[tuple[int, ...], int]] = [m for masks in numbered.values() for m in masks]
        parts = []
        for k, h in enumerate(self.words):
            if least[k]:
                for mask, number in numbered[least[k]]:
                    s = seeds(h, mask, number)
                    parts.append((s, np.full(len(s), k, np.int64), np.arange(len(s))))
        none = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        seed, item, at = (np.concatenate([p[i] for p in [*parts, none]]) for i in range(3))
        order = np.argsort(seed, kind="stable")
        self.seed, self.item, self.at = seed[order], item[order], at[order]
        self.bitmap = np.zeros(1 << self.BITS, bool)
        self.bitmap[self.seed >> np.uint64(64 - self.BITS)] = True

    def find(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int, int]]]:
        """For each text its hits (item number, start, end, item start, equal words), best per item."""
        hashed = [word_hashes(t) if t else np.zeros(0, np.uint64) for t in texts]
        found: list[list[tuple[int, int, int, int, int]]] = [[] for _ in texts]
        if not len(self.seed) or not hashed:
            return found
        h = np.concatenate(hashed)
        ends = np.cumsum([len(x) for x in hashed])
        starts = np.concatenate([[0], ends[:-1]])
        tried: set[tuple[int, int, int]] = set()
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for mask, number in self.masks:
            s = seeds(h, mask, number)
            at = np.flatnonzero(self.bitmap[s >> np.uint64(64 - self.BITS)])
            if not len(at):
                continue
            lo, hi = np.searchsorted(self.seed, s[at], "left"), np.searchsorted(self.seed, s[at], "right")
            for p, a, b in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
                doc = int(np.searchsorted(ends, p, "right"))
                if p + max(mask) >= ends[doc]:
                    continue  # the seed runs over the document's end
                for j in range(a, b):
                    item, shift = int(self.item[j]), p - int(starts[doc]) - int(self.at[j])
                    if (doc, item, shift) in tried:
                        continue
                    tried.add((doc, item, shift))
                    hit = aligned(hashed[doc], self.words[item], shift)
                    if hit and hit[3] > best.get((doc, item), (0, 0, 0, 0))[3]:
                        best[doc, item] = hit
        for (doc, item), hit in sorted(best.items()):
            found[doc].append((item, *hit))
        return found


def aligned(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int, int] | None:
    """(start, end, item start, equal words) of the agreeing stretch with item word i at doc word i + shift."""
    lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
    need = min(WINDOW, len(item))
    if hi - lo < need:
        return None
    equal = doc[lo + shift : hi + shift] == item[lo:hi]
    total = np.concatenate([[0], np.cumsum(equal)])
    good = np.flatnonzero(total[need:] - total[:-need] >= (SHARE if need >= MIN_WORDS else 1) * need)
    if not len(good):
        return None
    a, b = lo + int(good[0]), lo + int(good[-1]) + need
    return a + shift, b + shift, a, int(total[b - lo] - total[a - lo])


_indexes: dict[int, tuple[list, SeedIndex, int]] = {}


def _release() -> None:
    _hashes.clear()
    _indexes.clear()


def _index(shared) -> SeedIndex:
    """This worker's index of a broadcast block. Built indexes stay while their blocks are within
    ``INDEXED_BYTES``; beyond that the oldest goes."""
    claim("decontaminate", _release)
    items = shared.value
    held = _indexes.get(id(items))
    if held is None:
        size = sum(len(text) for _, text in items)
        while _indexes and size + sum(n for *_, n in _indexes.values()) > INDEXED_BYTES:
            del _indexes[next(iter(_indexes))]
        held = _indexes[id(items)] = (items, SeedIndex(items), size)
    return held[1]


def _groups(batches: Iterator, texts_of: Callable, blocks: int) -> Iterator[list]:
    """Batches with their texts, as many at a time as make ``GROUP_CHARS``: each group meets every block once,
    so indexes that cannot all be kept are not built again for each batch. A single block needs no groups."""
    group, held = [], 0
    for batch in batches:
        texts = texts_of(batch)
        group.append((batch, texts))
        held += sum(len(t) for t in texts if t)
        if blocks <= 1 or held >= GROUP_CHARS:
            yield group
            group, held = [], 0
    if group:
        yield group


def blocks_of(benchmark: DataFrame, most: int | None = None) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of about ``most`` bytes of text (``BLOCK_BYTES`` unless given)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    count = -(-int(size) // (most or BLOCK_BYTES))
    for k in range(count):
        part = items if count == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        yield [(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item that contaminates it, with the best agreeing stretch in words."""
    spark = prepare(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = [spark.sparkContext.broadcast(block) for block in blocks_of(benchmark)]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, lambda b: b.column(1).to_pylist(), len(blocks)):
            for shared in blocks:
                index = _index(shared)
                for batch, texts in group:
                    rows = [
                        (doc_id, item_id, *hit)
                        for doc_id, hits in zip(batch.column(0).to_pylist(), index.find(texts), strict=True)
                        for item, *hit in hits
                        for item_id in index.ids[item]
                    ]
                    if rows:
                        kinds = (pa.int64(), pa.int64(), *[pa.int32()] * 4)
                        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "start_word", "end_word", "item_start", "n_equal"])

    return narrow.mapInArrow(search, HITS)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates."""
    spark = prepare(docs.sparkSession)
    blocks = [spark.sparkContext.broadcast(block) for block in blocks_of(benchmark)]

    @pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for group in _groups(batches, list, len(blocks)):
            hit = [np.zeros(len(texts), bool) for _, texts in group]
            for shared in blocks:
                index = _index(shared)
                for found, (_, texts) in zip(hit, group, strict=True):
                    found |= np.array([bool(hits) for hits in index.find(texts)], bool)
            yield from (pd.Series(~found) for found in hit)

    return docs.where(clean(F.col("text").cast("string"))) if blocks else docs


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Contaminated documents: each with the benchmark item and where they agree."""
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
