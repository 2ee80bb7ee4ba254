"""Best-fit packing of token sequences by a linear grouping scheme.

Everything that decides where pieces go happens on the histogram of piece lengths, which has as many rows
as a sequence has tokens, however many documents there are:

1. pieces longer than ``capacity / 6`` are sorted by length and dealt to groups of equal cardinality; each
   length is rounded up to its group's longest;
2. the few rounded sizes are packed by the configuration linear program (column generation, with a
   dynamic-programming knapsack for pricing) and its solution rounded down;
3. the slots of the configurations take actual pieces of their groups, longest first, which leaves each
   sequence at least the room that was planned;
4. what is left (the rounding's remainder and all small pieces) is best-fit, longest first, into the room
   that the sequences really have.

The plan is a list of runs "the pieces of length l ranked r0.. go to sequences s0.. at offset o", and the
pieces find their place by their rank within their length (numbered in many bins, so that one length may
hold any share of the rows).

Null texts count as empty: the end id alone is their one piece. Only documents over ``capacity`` ids are
cut, into ``capacity``-sized pieces after a first piece with the remainder. Repeated rows are packed each.
An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import struct
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, prepare, saved
from .tokens import default_vocabulary, encoder

CAPACITY = 2048
GROUPS = 96
LARGE_SHARE = 6
PIECES = "doc_id long, piece int, start long, length long, ids binary"


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length and ids (little-endian unsigned 32-bit) of each document's pieces."""
    prepare(docs.sparkSession)
    vocabulary = vocabulary or default_vocabulary()
    end = struct.pack("<I", end_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(texts), strict=True):
                ids += end
                n, at, k = len(ids) // 4, 0, 0
                while at < n:
                    size = n if n <= capacity else (n % capacity or capacity) if at == 0 else capacity
                    for column, value in zip(out, (doc_id, k, at, size, ids[at * 4 : (at + size) * 4]), strict=True):
                        column.append(value)
                    at, k = at + size, k + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids"],
            )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(cut, PIECES)


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """Configurations (how many of each size) and how often to use each, from the rounded-down program."""
    m = len(sizes)
    s, b = np.array(sizes), np.array(demand, float)
    basis = np.diag([float(capacity // x) for x in sizes])
    inverse = np.diag(1.0 / np.diag(basis))
    use = inverse @ b
    most = capacity // min(sizes)
    for _ in range(40 * m + 200):
        prices = inverse.T @ np.ones(m)
        # best[c]: the dearest choice of at most j items within c; came[j][c]: its last item
        best, came = np.zeros(capacity + 1), []
        for _ in range(most):
            trial = np.full((m, capacity + 1), -1.0)
            for i, x in enumerate(sizes):
                trial[i, x:] = best[: capacity + 1 - x] + prices[i]
            pick = trial.argmax(0)
            value = trial[pick, np.arange(capacity + 1)]
            better = value > best + 1e-12
            came.append(np.where(better, pick, -1))
            best = np.where(better, value, best)
        if best[capacity] <= 1 + 1e-7:
            break
        column, c = np.zeros(m), capacity
        for layer in reversed(came):
            if layer[c] >= 0:
                column[layer[c]] += 1
                c -= int(s[layer[c]])
        step = inverse @ column
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, use / step, np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        theta = max(0.0, float(ratio[out]))
        use = np.maximum(use - theta * step, 0)
        use[out] = theta
        basis[:, out] = column
        row = inverse[out] / step[out]
        inverse = inverse - np.outer(step, row)
        inverse[out] = row
    else:  # the last plan is a plan too, only not proven to be the best
        warnings.warn("The configuration program stopped before its optimum", RuntimeWarning, stacklevel=2)
    return [(basis[:, j].astype(int).tolist(), int(use[j] + 1e-6)) for j in range(m) if use[j] + 1e-6 >= 1]


class _Bins:
    """Kinds of sequences by free room: a kind is (places, count), places the (length, how many) in it."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
        self.rooms: list[int] = []

    def put(self, lengths: tuple[int, ...], count: int, room: int) -> None:
        if room not in self.by_room:
            self.by_room[room] = []
            bisect.insort(self.rooms, room)
        self.by_room[room].append((lengths, count))

    def take(self, length: int) -> tuple[tuple[int, ...], int, int] | None:
        """A kind with the least room that fits ``length``."""
        at = bisect.bisect_left(self.rooms, length)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        lengths, count = self.by_room[room].pop()
        if not self.by_room[room]:
            del self.by_room[room], self.rooms[at]
        return lengths, count, room


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[tuple[tuple[int, ...], int]]:
    """Kinds of sequences and how many of each, for ``counts`` pieces by length."""
    left = {k: v for k, v in counts.items() if v > 0}
    bins = _Bins(capacity)
    done: list[tuple[tuple[int, ...], int]] = []
    if capacity in left:
        done.append(((capacity,), left.pop(capacity)))
    large = [(k, left[k]) for k in sorted(left, reverse=True) if k > capacity // LARGE_SHARE]
    total = sum(n for _, n in large)
    if total > groups:
        # groups of equal cardinality, as runs of (length, count)
        most = -(-total // groups)
        grouped: list[list[list[int]]] = [[]]
        room = most
        for length, n in large:
            while n:
                if not room:
                    grouped.append([])
                    room = most
                k = min(n, room)
                grouped[-1].append([length, k])
                n, room = n - k, room - k
        merged: dict[int, list[list[int]]] = {}
        for runs in grouped:  # groups with one longest length are one size
            merged.setdefault(runs[0][0], []).extend(runs)
        sizes = sorted(merged, reverse=True)
        for choice, times in configurations(sizes, [sum(n for _, n in merged[x]) for x in sizes], capacity):
            slots = [x for x, k in zip(sizes, choice, strict=True) for _ in range(k)]
            while times and slots:
                wanted: dict[int, int] = {}
                lengths, run = [], times
                for x in slots:  # a slot takes the group's next run that this sequence has not claimed
                    at = wanted.get(x, 0)
                    if at >= len(merged[x]):
                        continue
                    length, n = merged[x][at]
                    wanted[x] = at + 1
                    lengths.append((x, at, length))
                    run = min(run, n)
                if not lengths:
                    break
                if len({x for x in slots}) != len(slots):  # equal slots may share one run instead
                    share: dict[int, int] = {}
                    for x in slots:
                        share[x] = share.get(x, 0) + 1
                    fits = {x: merged[x][0][1] // k for x, k in share.items() if merged[x]}
                    if fits and min(fits.values()) >= 1 and len(fits) == len(share):
                        run = min(times, *fits.values())
                        lengths = [(x, 0, merged[x][0][0]) for x in slots]
                for x, at, _ in lengths:
                    merged[x][at][1] -= run
                for x in share if len({*slots}) != len(slots) else slots:
                    merged[x] = [r for r in merged[x] if r[1] > 0]
                placed = tuple(length for _, _, length in lengths)
                bins.put(placed, run, capacity - sum(placed))
                times -= run
        left = {k: v for k, v in left.items() if k <= capacity // LARGE_SHARE}
        for runs in merged.values():
            for length, n in runs:
                if n:
                    left[length] = left.get(length, 0) + n
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            found = bins.take(length)
            if found is None:
                each = capacity // length
                if n >= each:
                    kind, made, used = (length,) * each, n // each, each
                else:
                    kind, made, used = (length,) * n, 1, n
                bins.put(kind, made, capacity - used * length)
                n -= made * used
                continue
            lengths, count, room = found
            if count <= n:
                bins.put((*lengths, length), count, room - length)
                n -= count
            else:
                bins.put((*lengths, length), n, room - length)
                bins.put(lengths, count - n, room)
                n = 0
    for kinds in bins.by_room.values():
        done += kinds
    return done


def intervals(kinds: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted: where each length's ranks go."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, count in kinds:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            rows.append((length, rank, sequence, offset))
            used[length] = rank + count
            offset += length
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, start, length and more columns).

    ``pieces`` should be a saved table: it is read twice.
    """
    counts = {int(r["length"]): int(r["count"]) for r in pieces.groupBy("length").count().collect()}  # one row per length
    plan = intervals(plan_packing(counts, capacity, groups))
    order = [F.col(c) for c in ("doc_id", "piece", "start")]
    if "ids_crc32" in pieces.columns:
        order.append(F.col("ids_crc32"))
    ranked = numbered(pieces, ["length"], order, "__rank")
    key = plan[:, 0] << 44 | plan[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "__rank"))
            row = plan[np.searchsorted(key, length << 44 | rank, "right") - 1]
            columns = [batch.column(i) for i, f in enumerate(batch.schema.names) if f != "__rank"]
            names = [f for f in batch.schema.names if f != "__rank"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(row[:, 2] + rank - row[:, 1]), pa.array(row[:, 3])], names=[*names, "sequence_id", "offset"]
            )

    schema = ranked.drop("__rank").schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(place, schema)


def packed_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """Pieces with their checksum and place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    digested = token_pieces(docs, capacity, vocabulary).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack_pieces(saved(digested, "token-pieces"), capacity)


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return packed_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
