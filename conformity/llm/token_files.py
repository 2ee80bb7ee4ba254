"""Token-ID files: independent zstandard frames, a trailing seek table and a checksum per frame.

A file is

* data frames: little-endian unsigned 32-bit ids of consecutive documents, each frame a complete zstandard
  frame of at most ``FRAME_IDS`` ids that ends at a document's end where it can;
* a skippable frame with the document table (zstandard of the int64 doc_ids, a null mask and id counts);
* a skippable frame with the seek table: for each data frame its stored size, its plain size and the low
  32 bits of the plain bytes' xxh64, as in the public seekable format of zstandard.

A reader opens the two trailing tables, then decompresses only the frames of the documents asked for.

Null texts count as empty (the end id alone); a null doc_id sorts first; repeated rows are written each, rows of
one doc_id (or of none) in the table's order, by as many tasks as they fill; an empty table gives no rows.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, scratch_path
from .tokens import default_vocabulary, encoder

FRAME_IDS = 1 << 16
TABLE_MAGIC, SEEK_MAGIC, SEEK_FOOTER = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
MANIFEST = "part int, path string, n_docs long, n_ids long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


class TokenFileWriter:
    def __init__(self, out, frame_ids: int = FRAME_IDS, level: int = 1):
        self.out, self.frame_ids = out, frame_ids
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.buffer: list[bytes] = []
        self.held = 0
        self.entries: list[tuple[int, int, int]] = []
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """Append one document's ids (little-endian unsigned 32-bit)."""
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        most = self.frame_ids * 4
        if self.held and self.held + len(ids) > most:
            self._flush()
        for at in range(0, len(ids), most):
            part = ids[at : at + most]
            self.buffer.append(part)
            self.held += len(part)
            if self.held >= most:
                self._flush()

    def _flush(self) -> None:
        if not self.held:
            return
        plain = b"".join(self.buffer)
        stored = self.zstd.compress(plain)
        self.entries.append((len(stored), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.out.write(stored)
        self.buffer, self.held = [], 0

    def close(self) -> None:
        self._flush()
        nulls = np.array([d is None for d in self.doc_ids], "u1").tobytes()
        ids = np.array([0 if d is None else d for d in self.doc_ids], "<i8").tobytes()
        table = self.zstd.compress(nulls + ids + np.array(self.counts, "<i8").tobytes())
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(table)) + table)
        seek = b"".join(struct.pack("<III", *e) for e in self.entries)
        seek += struct.pack("<IBI", len(self.entries), 0x80, SEEK_FOOTER)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(seek)) + seek)


class TokenFileReader:
    """Random access to the documents of one token file."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(size - 9)
        frames, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEK_FOOTER or not flags & 0x80:
            raise ValueError("not a seekable token file")
        seek_at = size - 9 - 12 * frames - 8
        source.seek(seek_at)
        head = struct.unpack("<II", source.read(8))
        if head != (SEEK_MAGIC, 12 * frames + 9):
            raise ValueError("damaged seek table")
        self.entries = np.frombuffer(source.read(12 * frames), "<u4").reshape(-1, 3).astype("i8")
        self.stored_at = np.concatenate([[0], np.cumsum(self.entries[:, 0])])
        self.plain_at = np.concatenate([[0], np.cumsum(self.entries[:, 1])])
        source.seek(int(self.stored_at[-1]))
        magic, length = struct.unpack("<II", source.read(8))
        if magic != TABLE_MAGIC:
            raise ValueError("damaged document table")
        table = zstandard.ZstdDecompressor().decompress(source.read(length))
        n = len(table) // 17
        self.nulls = np.frombuffer(table[:n], "u1").astype(bool)
        self.doc_ids = np.frombuffer(table[n : 9 * n], "<i8")
        self.counts = np.frombuffer(table[9 * n :], "<i8")
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self.frames_read = 0
        self._last: tuple[int, bytes] = (-1, b"")

    def frame(self, k: int) -> bytes:
        if self._last[0] != k:
            self.source.seek(int(self.stored_at[k]))
            plain = zstandard.ZstdDecompressor().decompress(self.source.read(int(self.entries[k, 0])))
            if len(plain) != self.entries[k, 1] or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.entries[k, 2]:
                raise ValueError(f"frame {k} does not match its checksum")
            self.frames_read += 1
            self._last = (k, plain)
        return self._last[1]

    def document(self, i: int) -> bytes:
        """Ids of the i-th document; only the frames that hold it are decompressed."""
        a, b = int(self.starts[i]) * 4, int(self.starts[i + 1]) * 4
        k = int(np.searchsorted(self.plain_at, a, "right")) - 1
        parts = []
        while a < b:
            frame, at = self.frame(k), int(self.plain_at[k])
            parts.append(frame[a - at : b - at])
            a, k = at + len(frame), k + 1
        return b"".join(parts)


def open_folder(uri: str):
    """(file system, path) of a shared folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_token_files(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = 0) -> DataFrame:
    """Encode ``text`` and write files in ascending doc_id order; returns the manifest, one row per file.

    Files are written under a task attempt's own name and renamed when complete, so a repeated attempt
    replaces a file with equal bytes.
    """
    spark = prepare(docs.sparkSession)
    vocabulary = vocabulary or default_vocabulary()
    end = struct.pack("<I", end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        held, path = open_folder(folder)
        name = f"{path}/part-{part:06d}.ids"
        encode = encoder(vocabulary).encode
        writer = None
        for batch in batches:
            if writer is None:
                held.create_dir(path, recursive=True)
                stream = held.open_output_stream(f"{name}.{attempt}")
                writer = TokenFileWriter(stream)
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(texts), strict=True):
                writer.add(doc_id, ids + end)
        if writer is not None and writer.counts:
            writer.close()
            stream.close()
            held.move(f"{name}.{attempt}", name)
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "path": [name], "n_docs": [len(writer.counts)], "n_ids": [sum(writer.counts)]}
            )

    # ranges are cut within a doc_id too: a frequent one, or null, is many tasks
    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("place"))
    ordered = numbered.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place")
    manifest = ordered.select("doc_id", "text").mapInArrow(write, MANIFEST)
    kept = f"{folder}/manifest"
    manifest.write.mode("overwrite").parquet(kept)
    return spark.read.schema(MANIFEST).parquet(kept)


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document of the files: doc_id, start (ids before it over all files), n_tokens, ids (binary)."""
    spark = manifest.sparkSession
    files = sorted(manifest.collect(), key=lambda r: r["part"])  # one row per file: metadata, not documents
    rows, before = [], 0
    for r in files:
        rows.append((r["path"], before))
        before += r["n_ids"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, _ = open_folder(folder)
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with held.open_input_file(path) as source:
                    reader = TokenFileReader(source, source.size())
                    for a in range(0, len(reader.counts), 256):
                        b = min(a + 256, len(reader.counts))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(reader.doc_ids[a:b], mask=reader.nulls[a:b]),
                                pa.array(reader.starts[a:b] + base),
                                pa.array(reader.counts[a:b]),
                                pa.array([reader.document(i) for i in range(a, b)], pa.binary()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids"],
                        )

    schema = "doc_id long, start long, n_tokens long, ids binary"
    if not rows:
        return spark.createDataFrame([], schema)
    listed = spark.createDataFrame(rows, "path string, base long").repartition(len(rows), "path")
    return listed.mapInArrow(read, schema)


def read_documents(path_or_bytes, wanted: list[int]) -> dict[int, np.ndarray]:
    """Ids of the documents with these doc_ids from one file, without decompressing the others."""
    source = io.BytesIO(path_or_bytes) if isinstance(path_or_bytes, bytes) else open(path_or_bytes, "rb")
    with source:
        size = source.seek(0, 2)
        reader = TokenFileReader(source, size)
        at = {int(d): i for i, d in enumerate(reader.doc_ids) if not reader.nulls[i]}
        return {d: np.frombuffer(reader.document(at[d]), "<u4") for d in wanted if d in at}


def op8_token_files(spark, sf_dir: str) -> DataFrame:
    """Write all documents' ids to token files, read the files back and digest what they hold."""
    folder = scratch_path(spark, "token-files")
    manifest = write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder)
    return read_token_files(manifest, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
