"""Large JSON files as JSON lines, cut in many tasks.

``multiLine`` reading gives a whole file to one task. Here a file is cut at fixed offsets. Whether a cut is inside a
string, and how deep in brackets, only the bytes before it say; so a first job tells of every range how many quotes
it has and how far the depth moves, both for a start inside a string and outside of one. Chained, these few numbers
give the state at every cut. Then each range finds the records that begin in it, reads on to the end of its last,
and writes one line for each, which Spark reads, infers and prunes like any JSON lines.

A file holds an array of records, an object whose ``results`` are that array, or one record. Elements that are no
objects give no row.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import scratch

RANGE_BYTES = 4 << 20
#: Bytes before a cut that are read for backslashes and for the key of an array.
BEFORE = 4096
QUOTE, BACKSLASH = ord('"'), ord("\\")
STEP = np.zeros(256, np.int8)
STEP[[ord("{"), ord("[")]], STEP[[ord("}"), ord("]")]] = 1, -1


def _open(path: str):
    from pyarrow import fs

    system, at = fs.FileSystem.from_uri(path) if re.match(r"[a-z0-9+.-]+:", path) else (fs.LocalFileSystem(), path)
    return system.open_input_file(at)


def _read(file, start: int, size: int) -> tuple[np.ndarray, bool]:
    """Bytes of a file, and whether an odd number of backslashes stands before them."""
    odd, at = False, start
    while at > 0:
        back = max(0, at - BEFORE)
        file.seek(back)
        before = file.read(at - back)
        run = len(before) - len(before.rstrip(b"\\"))
        odd ^= bool(run % 2)
        if run < len(before):
            break
        at = back
    file.seek(start)
    return np.frombuffer(file.read(size), np.uint8), odd


def _quotes(data: np.ndarray, odd: bool) -> np.ndarray:
    """Where quotes stand that no backslash escapes."""
    at = np.flatnonzero(data == QUOTE)
    if not len(at):
        return at
    plain = np.where(data != BACKSLASH, np.arange(len(data)), -1)
    last = np.maximum.accumulate(plain)
    before = np.where(at > 0, last[at - 1], -1)  # the last byte before the quote that is no backslash
    run = at - 1 - before + np.where(before < 0, int(odd), 0)
    return at[run % 2 == 0]


def _depths(data: np.ndarray, odd: bool, inside: bool, depth: int) -> tuple[np.ndarray, np.ndarray, bool, int]:
    """Where brackets outside strings stand, the depth after each, and the state at the end."""
    quotes = _quotes(data, odd)
    brackets = np.flatnonzero(STEP[data])
    outside = (np.searchsorted(quotes, brackets) + int(inside)) % 2 == 0
    brackets = brackets[outside]
    after = depth + np.cumsum(STEP[data[brackets]], dtype=np.int64)
    return brackets, after, bool((len(quotes) + int(inside)) % 2), int(after[-1]) if len(after) else depth


def range_moves(file, start: int, size: int) -> tuple[int, int, int]:
    """Parity of a range's quotes, and how far it moves the depth if it begins outside or inside a string."""
    data, odd = _read(file, start, size)
    moves = [_depths(data, odd, inside, 0)[3] for inside in (False, True)]
    return len(_quotes(data, odd)) % 2, *moves


def array_borders(file, start: int, size: int, inside: bool, depth: int, key: str) -> tuple[list[int], list[int]]:
    """Where arrays named ``key`` begin in the outermost object, and where its members of any kind end."""
    data, odd = _read(file, start, size)
    at, after, *_ = _depths(data, odd, inside, depth)
    begins, named = [], re.compile(rb'"' + re.escape(key.encode()) + rb'"\s*:\s*$')
    for k in at[(after == 2) & (data[at] == ord("["))].tolist():
        back = max(0, start + k - BEFORE)
        file.seek(back)
        if named.search(file.read(start + k - back)):
            begins.append(start + k)
    return begins, (start + at[(after == 1) & (STEP[data[at]] < 0)]).tolist()


def records_of(file, start: int, size: int, end: int, inside: bool, depth: int, level: int, first: int, last: int) -> Iterator[bytes]:
    """The records that begin in a range, whole: objects at depth ``level`` within [first, last) of the file."""
    data, odd = _read(file, start, size)
    at, after, inside, depth_now = _depths(data, odd, inside, depth)
    begin: int | None = None
    held, base = [], start
    while True:
        opens, closes = (after == level + 1) & (data[at] == ord("{")), (after == level) & (data[at] == ord("}"))
        borders = np.sort(np.concatenate([at[opens], at[closes]]))
        cut = 0
        for k in borders.tolist():
            if data[k] == ord("}"):
                if begin is not None:
                    yield b"".join([*held, data[cut : k + 1].tobytes()])
                    begin, held = None, []
                    if base > start:
                        return
            elif base == start and first < base + k < last:
                begin, cut = base + k, k
        if begin is None or base + len(data) >= end:
            return
        held.append(data[cut:].tobytes())  # the last record goes on behind the range
        base += len(data)
        data, odd = _read(file, base, size)
        at, after, inside, depth_now = _depths(data, odd, inside, depth_now)


def _ranged(spark: SparkSession, ranges: list[tuple], schema: str, scan, out: str) -> DataFrame:
    """``scan`` over ranges, which are dealt one to a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with _open(row["path"]) as file:
                    yield from scan(file, row)

    made = spark.createDataFrame(ranges, schema)
    return made.repartitionByRange(max(1, len(ranges)), "number").mapInArrow(run, out)


def json_lines(spark: SparkSession, paths: list[str], results_key: str = "results", range_bytes: int = 0) -> str:
    """Write the records of JSON files as lines to the shared folder; returns where."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    step = range_bytes or RANGE_BYTES
    ranges: list[tuple[int, str, int, int, int]] = []
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        size = at.getFileSystem(conf).getFileStatus(at).getLen()
        ranges += [(len(ranges) + i, path, start, step, size) for i, start in enumerate(range(0, size, step))]
    schema = "number long, path string, start long, size long, end long"

    def batch(names: list[str], *columns: list[Any]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    moves = _ranged(spark, ranges, schema, lambda f, r: [batch(["number", "quotes", "outer", "inner"], [r["number"]], *[[v] for v in range_moves(f, r["start"], r["size"])])], "number long, quotes long, outer long, inner long")
    told = {r["number"]: r for r in moves.collect()}  # four numbers for each range
    states, inside, depth = [], False, 0
    for number, path, start, size, end in ranges:
        if not start:
            inside, depth = False, 0
        states.append((number, path, start, size, end, inside, depth))
        depth += told[number]["inner" if inside else "outer"]
        inside ^= bool(told[number]["quotes"])
    schema += ", inside boolean, depth long"

    def borders(file, r) -> Iterator[pa.RecordBatch]:
        begins, ends = array_borders(file, r["start"], r["size"], r["inside"], r["depth"], results_key)
        yield batch(["number", "at", "begins"], [r["number"]] * (len(begins) + len(ends)), [*begins, *ends], [1] * len(begins) + [0] * len(ends))

    # where the records of a file are: level of depth, first and last byte
    where: dict[str, tuple[int, int, int]] = {}
    objects = []
    for path in dict.fromkeys(paths):
        size = next((s[4] for s in states if s[1] == path), 0)
        with _open(path) as file:
            head = file.read(BEFORE).lstrip(b"\xef\xbb\xbf").lstrip()[:1]
        where[path] = (1, -1, size) if head == b"[" else (0, -1, size)
        if head == b"{":
            objects.append(path)
    if objects:
        found: dict[str, list[tuple[int, int]]] = {p: [] for p in objects}
        named = [s for s in states if s[1] in found]
        of = {s[0]: s[1] for s in named}
        for r in _ranged(spark, named, schema, borders, "number long, at long, begins long").collect():
            found[of[r["number"]]].append((r["at"], r["begins"]))
        for path, marks in found.items():
            begins = sorted(at for at, begin in marks if begin)
            if begins:
                where[path] = (2, begins[0], min(at for at, begin in marks if not begin and at > begins[0]))
    final = [(*s, *where[s[1]]) for s in states]
    schema += ", level long, first long, last long"

    def cut(file, r) -> Iterator[pa.RecordBatch]:
        lines: list[str] = []
        for record in records_of(file, r["start"], r["size"], r["end"], r["inside"], r["depth"], r["level"], r["first"], r["last"]):
            lines.append(record.decode("utf-8", "replace").replace("\r", " ").replace("\n", " "))
            if len(lines) >= 512:
                yield pa.RecordBatch.from_arrays([pa.array(lines)], ["value"])
                lines = []
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])

    to = scratch(spark, "json-lines")
    _ranged(spark, final, schema, cut, "value string").write.text(to)
    return to


def large_files(spark: SparkSession, paths: list[str], above: int) -> list[str]:
    """The files behind paths (files, folders or patterns) if one of them is larger than ``above`` bytes."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    files, large = [], False
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(conf)
        for status in fs.globStatus(at) or []:
            for s in fs.listStatus(status.getPath()) if status.isDirectory() else [status]:
                if s.isFile() and not s.getPath().getName().startswith(("_", ".")):
                    files.append(s.getPath().toString())
                    large = large or s.getLen() > above
    return files if large else []
