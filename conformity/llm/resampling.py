"""Importance resampling towards a target distribution over hashed word runs.

A document's features are its runs of 1 to ``n`` words, joined by one space, each hashed by CRC-32 to one of
``BUCKETS`` buckets. A CRC can be carried on, so one scan of the words keeps ``n`` running states: the state of
every run that began in the last ``n`` words, each extended by a space and the word that comes. Every word
gives the crc of each run that it ends, and no run's text is ever built.

Counts of all documents and of the target text give each bucket a gain (the log ratio of both shares, in
thousandths); a document weighs the sum of the gains of its features. With Gumbel noise made from the doc_id,
the highest scores are a sample without replacement in proportion to the weights.

The texts are scanned twice, for the counts and for the weights: buckets kept from the first scan would take
as much disk as the texts. Between the scans only ``BUCKETS`` sums go through the driver. Ranks come from
ranges of (score, doc_id), so no task sorts all rows.

Null and empty texts have no features and weigh 0. A null doc_id is hashed as an empty string and comes before
others of its score. Every row of a repeated doc_id is a document of its own with the same noise. Without a
target text the gains compare the corpus with even shares. An empty table gives no rows. Only doc_id and text
are read, so other columns may have any names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import in_order
from .common import claim, drop_saved, prepare, saved

LONGEST, BUCKETS, SEED = 3, 10_000, 42
#: Documents of fewer words are never drawn; of all others and these together so many per cent are.
MIN_WORDS, PERCENT = 20, 5
#: Words whose states are carried on at once; of a longer text only the states at the end of each part are kept.
STEP = 1 << 14
#: Bytes to what words are made of: A-Z as a-z, digits, a-z and all bytes of other characters; the rest parts words.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


class CrcRing:
    """The running CRC states of the runs that began in the last ``n`` words."""

    def __init__(self, n: int = LONGEST):
        self.n = n
        #: The state of the run of k + 1 words that ends at the last word, for each k below n - 1.
        self.states: list[int] = []

    def extend(self, words: list[bytes]) -> list[list[int]]:
        """The CRCs of the runs of 1, 2, ... n words that end at the next words, in the order of their ends."""
        spaced = [b" " + w for w in words]
        out = [list(map(zlib.crc32, words))]
        for k in range(1, self.n):
            # a run of k words that ends one word earlier, in this call or the last, goes on with a space and the word
            shorter = [*self.states[k - 1 : k], *out[-1]]
            out.append(list(map(zlib.crc32, spaced[len(words) - len(shorter) + 1 :], shorter[:-1])))
            if shorter:
                self.states[k - 1 : k] = shorter[-1:]
        return out


def buckets_of(words: list[bytes], n: int = LONGEST, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """The buckets of all runs of a text's words, part by part."""
    ring = CrcRing(n)
    for at in range(0, len(words), STEP):
        for crcs in ring.extend(words[at : at + STEP]):
            yield np.array(crcs, np.uint32) % buckets


def _texts(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, Iterator[list[bytes]]]]:
    claim("resampling")
    for batch in batches:
        yield batch, (words_of(t.as_py() or b"") for t in batch.column(column))


def bucket_counts(texts: DataFrame, n: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: how many features of all texts fall into each bucket that any falls into. Each task counts
    its own rows first."""
    prepare(texts.sparkSession)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for _, texts_words in _texts(batches, 0):
            for words in texts_words:
                for found in buckets_of(words, n, buckets):
                    held += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(held[used], pa.int64())], ["bucket", "n"])

    one = texts.select(F.col("text").cast("string").cast("binary").alias("text"))
    return one.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's log ratio of the target's share to the corpus's, in thousandths, rounded down."""
    s_all, t_all = float(sum(corpus.values()) + buckets), float(sum(target.values()) + buckets)
    ratio = lambda b: ((target.get(b, 0) + 1) * s_all) / ((corpus.get(b, 0) + 1) * t_all)
    return np.array([math.floor(1000 * math.log(ratio(b))) for b in range(buckets)], np.int64)


def noise(hashed: int) -> int:
    """Gumbel noise in thousandths, rounded down, from a number of 32 bits."""
    return math.floor(-1000 * math.log(-math.log((hashed + 0.5) / 4294967296)))


def weighed(docs: DataFrame, gain: np.ndarray, n: int = LONGEST, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""
    prepare(docs.sparkSession)

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts_words in _texts(batches, 2):
            rows = []
            for words in texts_words:
                features = weight = 0
                for found in buckets_of(words, n, len(gain)):
                    features += len(found)
                    weight += int(gain[found].sum())
                rows.append((len(words), features, weight))
            counts = np.array(rows, np.int64).reshape(-1, 3)
            score = counts[:, 2] + np.fromiter(map(noise, batch.column(1).to_pylist()), np.int64, len(rows))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (counts[:, 0], counts[:, 1], counts[:, 2], score))], ["doc_id", "n_words", "n_features", "weight", "score"])

    doc_id = F.col("doc_id").cast("long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    held = docs.select(doc_id.alias("doc_id"), F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").alias("hashed"), F.col("text").cast("string").cast("binary").alias("text"))
    return held.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row; rank is null where it is not drawn.

    Of N rows with at least ``min_words`` words, floor(percent * N / 100) are drawn.
    """
    spark = docs.sparkSession
    counts = lambda df: dict(bucket_counts(df).collect())  # noqa: E731  at most one row per bucket
    scored = saved(weighed(docs, gains(counts(docs), counts(target))), "resample-scores")
    enough = F.col("n_words") >= min_words
    n = scored.where(enough).count() * percent // 100
    # rows of one score and doc_id differ in their counts or not at all
    order = [F.col("__enough").desc(), F.col("score").desc(), *[F.col(c).asc_nulls_first() for c in ("doc_id", "n_words", "n_features")]]
    ranked = in_order(scored.withColumn("__enough", enough), [], order, "rank", lambda df: saved(df, "resample-ranges"))
    drop_saved(scored)
    return ranked.withColumn("rank", F.when(F.col("__enough") & (F.col("rank") <= n), F.col("rank"))).drop("__enough")


def op13_resample(spark, sf_dir: str) -> DataFrame:
    drawn = resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def _crc_table() -> list[int]:
    table = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    return table


#: The CRC of each distinct run, byte by byte from the table of its polynomial.
OP13_SQL = rf"""
WITH worded AS (
  SELECT row_number() OVER () AS r, doc_id, kind, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT doc_id, text, 'corpus' AS kind FROM documents UNION ALL SELECT item_id, text, 'target' FROM benchmark)),
placed AS (SELECT r, kind, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
runs AS (SELECT r, kind, array_to_string(w[i:i + k - 1], ' ') AS f, count(*) AS n FROM placed, range(1, {LONGEST} + 1) t(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
bytes AS (SELECT f, list_transform(range(1, 2 * strlen(f), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT)) AS b FROM (SELECT f, hex(f) AS h FROM (SELECT DISTINCT f FROM runs))),
hashed AS (
  SELECT f, xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || b, lambda c, x: xor(c >> 8, (CAST({_crc_table()} AS BIGINT[]))[(xor(c, x) & 255) + 1]))) % {BUCKETS} AS bucket FROM bytes),
counts AS (SELECT kind, bucket, sum(n) AS n FROM runs JOIN hashed USING (f) GROUP BY kind, bucket),
totals AS (SELECT coalesce(sum(n) FILTER (kind = 'corpus'), 0) AS s, coalesce(sum(n) FILTER (kind = 'target'), 0) AS t FROM counts),
gained AS (
  SELECT b AS bucket, CAST(floor(1000 * ln(CAST(coalesce(max(n) FILTER (kind = 'target'), 0) + 1 AS DOUBLE) * CAST(any_value(s) + {BUCKETS} AS DOUBLE)
         / (CAST(coalesce(max(n) FILTER (kind = 'corpus'), 0) + 1 AS DOUBLE) * CAST(any_value(t) + {BUCKETS} AS DOUBLE)))) AS BIGINT) AS gain
  FROM range({BUCKETS}) x(b) CROSS JOIN totals LEFT JOIN counts ON counts.bucket = b GROUP BY b),
weights AS (SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight FROM runs JOIN hashed USING (f) JOIN gained USING (bucket) GROUP BY r),
scored AS (
  SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM worded LEFT JOIN weights USING (r) WHERE kind = 'corpus'),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {MIN_WORDS} ORDER BY score DESC, doc_id NULLS FIRST, n_words, n_features) AS place, count(*) FILTER (n_words >= {MIN_WORDS}) OVER () AS enough FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= {MIN_WORDS} AND place <= enough * {PERCENT} // 100 THEN place END AS rank FROM ordered"""
