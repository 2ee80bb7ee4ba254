"""MinHash near-duplicates with odd sketches.

Words are runs of bytes other than ASCII white space, A-Z lowered. A document's set holds its distinct
two-word shingles (a single word stands for itself), as 64-bit hashes. Documents with one set are one class;
a class is linked with another if the sets' Jaccard similarity is at least 80 %.

1. One pass over the texts gives each document its set's size and 128-bit digest, ``SAMPLES`` MinHash values
   folded into band keys (``BANDS`` bands of four: at similarity 0.8 all bands miss a pair once in 20
   million), and an odd sketch: each sample toggles one of 512 bits, so that the number of bits in which
   two sketches differ estimates high similarities closely.
2. In each bucket of classes with a band in common, the class that collides most is the pivot and is paired
   with every other member: as many pairs as members, never all pairs.
3. Sizes that exclude the similarity and sketches that differ by over five standard deviations remove
   pairs; the rest are verified on the full sets of the whole texts.
4. Verified links give components. A bucket whose members all are in one component is done. For the
   members of the others (the pivots aside: their pairs are decided), shingles that few of them have are
   found: what is not rare, and what of the rare two members share, bounds their similarity from above,
   exactly. Members of different components that neither this bound nor the sketches exclude are paired in
   blocks and verified; then components are computed again.

No step groups a bucket, class or component in one task or on the driver, and no member is left out.

Null and empty texts, and texts without words, have no set: they are linked with nothing and kept. Repeated
rows are judged each; rows with one doc_id and different texts are separate documents of that id. A null
doc_id cannot be joined to anything but keeps its row: it is its own component (null) and is kept. An empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import claim, drop_saved, prepare, saved, small

PERCENT = 80
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
#: Similarity below which a sketch excludes a pair: over five standard deviations under 0.8.
SKETCH_FLOOR = 0.55
KEPT_WORDS = 150_000
BLOCK = 2000
RARE = 64

_random = np.random.default_rng(20240229)
MULTIPLY = (_random.integers(0, 1 << 31, SAMPLES, dtype=np.uint64) * 2 + 1).astype(np.uint32)
ADD = _random.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32)
SALT = _random.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)
_words: dict[bytes, int] = {}
SIGNATURES = "doc_id long, text_key long, n_shingles long, digest binary, bands array<long>, sketch array<long>"


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(_words) > KEPT_WORDS:
        _words.clear()
    try:
        h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    except KeyError:
        for w in set(words):
            if w not in _words:
                _words[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    if len(h) == 1:
        return h * np.uint64(0x9E3779B97F4A7C15)
    pairs = h[:-1] * np.uint64(0xBF58476D1CE4E5B9) + (h[1:] ^ (h[1:] >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    pairs ^= pairs >> np.uint64(32)
    return np.unique(pairs)


def minhash(hashes: np.ndarray) -> np.ndarray:
    """The least of each of ``SAMPLES`` permutations of the shingles."""
    x = (hashes >> np.uint64(32)).astype(np.uint32) ^ hashes.astype(np.uint32)
    out = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        part = x[at : at + 1024]
        np.minimum(out, (part[:, None] * MULTIPLY + ADD).min(0), out=out)
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """512 bits as eight 64-bit words; bit b is the parity of the samples that hash to it."""
    mixed = (samples.astype(np.uint64) + SALT) * np.uint64(0x9E3779B97F4A7C15)
    bits = np.bincount((mixed >> np.uint64(55)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(bits.astype(bool), bitorder="little").view("<i8")


def band_keys(samples: np.ndarray) -> np.ndarray:
    groups = samples.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for j in range(ROWS):
        key = (key ^ groups[:, j]) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def differing_bits(similarity: float) -> int:
    """Bits in which two sketches are expected to differ at a similarity."""
    return int(SKETCH_BITS / 2 * (1 - math.exp(-4 * SAMPLES * (1 - similarity) / SKETCH_BITS)))


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, digest, bands, sketch; no digest, bands or sketch for documents without a set."""
    prepare(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("near-dup", _words.clear)
        for batch in batches:
            sizes, digests, bands, sketches = [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingles(text)
                sizes.append(len(s))
                if not len(s):
                    digests.append(None), bands.append(None), sketches.append(None)
                    continue
                samples = minhash(s)
                digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                bands.append(band_keys(samples))
                sketches.append(odd_sketch(samples))
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, lists), pa.array(sketches, lists)],
                names=["doc_id", "text_key", "n_shingles", "digest", "bands", "sketch"],
            )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), text_key(F.col("text")).alias("text_key"))
    return narrow.mapInArrow(sign, SIGNATURES)


def _plausible(a: str, b: str) -> F.Column:
    """Sizes and sketches do not exclude the similarity."""
    least, most = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    differ = sum((F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))
    return (least * 100 >= most * PERCENT) & (differ <= differing_bits(SKETCH_FLOOR))


def similar_enough(a: np.ndarray, b: np.ndarray) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= PERCENT * (len(a) + len(b) - shared)


def _bounded(a: str, b: str) -> F.Column:
    """What is not rare, and the rare shingles that both have, allow the similarity.

    Without the lists of both, the fewer rare shingles of the two bound those that they share.
    """
    listed = F.col(f"{a}.rare").isNotNull() & F.col(f"{b}.rare").isNotNull()
    shared = F.when(listed, F.size(F.array_intersect(f"{a}.rare", f"{b}.rare"))).otherwise(F.least(f"{a}.n_rare", f"{b}.n_rare"))
    most = F.least(F.col(f"{a}.common"), F.col(f"{b}.common")) + shared
    return most * 100 >= (F.col(f"{a}.n") + F.col(f"{b}.n") - most) * PERCENT


def texts_of(keys: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """key and text of classes; a doc_id on several rows brings texts of other classes too."""
    wanted = saved(reps.select("key", "doc").join(keys, "key"), "near-wanted")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))
    return saved(narrow.join(small(wanted), "doc").select("key", "text"), "near-texts")


def rare_shingles(keys: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """key, own (its shingles that no other of ``keys`` has) and rare (those that up to ``RARE`` have)."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("near-dup", _words.clear)
        for batch in batches:
            owners, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for key, owner, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                s = shingles(text)
                if xxhash.xxh3_128_digest(s.tobytes()) == key:
                    owners.append(np.full(len(s), owner)), found.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(owners)), pa.array(np.concatenate(found))], names=["owner", "shingle"])

    # a row that repeats a class's text makes its shingles look less rare, which only excludes less
    rows = texts_of(keys, reps, docs).select("key", F.xxhash64("key").alias("owner"), "text").mapInArrow(spread, "owner long, shingle long")
    rows = saved(rows, "near-shingles")
    few = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") <= RARE)
    found = rows.join(few, "shingle").groupBy("owner").agg(
        F.count_if(F.col("held") == 1).alias("own"), F.collect_set(F.when(F.col("held") > 1, F.col("shingle"))).alias("rare")
    )
    found = saved(found, "near-rare")
    drop_saved(rows)
    return keys.join(found, F.xxhash64(keys["key"]) == found["owner"]).select("key", "own", "rare")


def bounded_side() -> list[F.Column]:
    """common, n_rare and rare (null if the list is long) of a class's n, own and rare shingles."""
    n_rare = F.coalesce(F.when(F.col("rare").isNotNull(), F.size("rare")), F.lit(0))
    none = F.array().cast("array<long>")
    # classes whose shingles are rare for the most part go without the list
    listed = F.when(n_rare * 2 <= F.col("n"), F.coalesce("rare", none))
    return [(F.col("n") - F.coalesce("own", F.lit(0)) - n_rare).alias("common"), n_rare.alias("n_rare"), listed.alias("rare")]


def verified(pairs: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b: digests) whose full sets are similar enough."""
    wanted = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    texts = texts_of(wanted, reps, docs)
    joined = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("near-dup", _words.clear)
        last: tuple[bytes | None, str | None, np.ndarray | None] = (None, None, None)
        for batch in batches:
            ok = []
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last[0] != b or last[1] != y:
                    last = (b, y, shingles(y))
                sa, sb = shingles(x), last[2]
                # a doc_id may be on rows with other texts: only the class's own text counts
                sound = xxhash.xxh3_128_digest(sa.tobytes()) == a and xxhash.xxh3_128_digest(sb.tobytes()) == b
                ok.append(sound and similar_enough(sa, sb))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    found = saved(joined.select("a", "b", "text_a", "text_b").mapInArrow(verify, "a binary, b binary"), "near-links")
    drop_saved(texts)
    return found


def components(links: DataFrame, reps: DataFrame) -> DataFrame:
    """key and comp (struct of doc and key: the least of the component) of every class with a link.

    Rounds of "take the least label among the neighbours, then that label's own label", each written to the
    shared folder, until no label changes: logarithmic in the longest path.
    """
    ends = lambda x, y: F.struct(F.col(x).alias("key"), F.col(y).alias("other"))
    both = links.select(F.explode(F.array(ends("a", "b"), ends("b", "a"), ends("a", "a"), ends("b", "b"))).alias("e")).select("e.*").distinct()
    both = saved(both, "near-edges")
    labels = reps.select("key", F.struct("doc", "key").alias("comp"))
    while True:
        # every class is its own neighbour too, which brings its label along
        met = both.join(labels.withColumnRenamed("key", "other"), "other")
        least = met.groupBy("key").agg(F.min("comp").alias("least"), F.min(F.when(F.col("key") == F.col("other"), F.col("comp"))).alias("was"))
        roots = least.select(F.col("key").alias("root"), F.col("least").alias("root_comp"))
        jumped = least.join(roots, F.col("least.key") == F.col("root")).select("key", "was", F.least("least", "root_comp").alias("comp"))
        after = saved(jumped, "near-labels")
        labels = after.select("key", "comp")
        if not after.where("was <> comp").limit(1).count():
            drop_saved(both)
            return labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id and kept of every document."""
    signed = saved(signatures(docs), "near-signatures")
    classes = signed.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    reps = (
        signed.join(classes, ["digest", "doc_id"])
        .dropDuplicates(["digest"])
        .select(F.col("digest").alias("key"), F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "sketch", "bands")
    )
    reps = saved(reps, "near-classes")
    exploded = reps.select("key", F.posexplode("bands").alias("band", "bucket"))
    buckets = exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = saved(exploded.join(buckets, "bucket"), "near-members")
    weights = members.groupBy("key").agg(F.sum("size").alias("weight"))
    pivots = members.join(weights, "key").groupBy("bucket").agg(F.max(F.struct("weight", "key"))["key"].alias("pivot"))
    # a pair of classes meets in many bands; it is one candidate
    first = members.join(pivots, "bucket").where("key <> pivot").select(F.col("key").alias("a"), F.col("pivot").alias("b"))
    first = saved(first.distinct(), "near-pairs")
    side = reps.select("key", F.struct("n", "sketch").alias("s"))
    near = first.join(side.select(F.col("key").alias("a"), F.col("s").alias("sa")), "a").join(side.select(F.col("key").alias("b"), F.col("s").alias("sb")), "b")
    links = verified(saved(near.where(_plausible("sa", "sb")).select("a", "b"), "near-candidates"), reps, docs)
    comps = components(links, reps)
    # buckets that hold more than one component: all but the pivot, whose pairs are decided
    own = F.struct(F.col("doc"), F.col("key"))
    labelled = members.join(pivots, "bucket").where("key <> pivot").join(reps.select("key", "doc", "n", "sketch", "bands"), "key").join(comps, "key", "left")
    labelled = labelled.select("bucket", "band", "key", F.coalesce("comp", own).alias("comp"), F.struct("n", "sketch", F.slice("bands", 1, F.col("band")).alias("before")).alias("s"))
    mixed = labelled.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("left")).where("lo <> hi")
    mixed = mixed.select("bucket", F.ceil(F.col("left") / BLOCK).cast("int").alias("blocks"))
    open_ = saved(labelled.join(mixed, "bucket"), "near-open")
    # a member whose own shingles leave too little needs no partner at all
    scarce = rare_shingles(open_.select("key").distinct(), reps, docs)
    open_ = open_.join(scarce, "key", "left").withColumn("own", F.coalesce("own", F.lit(0))).where(f"(s.n - own) * 100 >= s.n * {PERCENT}")
    open_ = open_.withColumn("n", F.col("s.n")).withColumn("s", F.struct("s.n", "s.sketch", "s.before", *bounded_side()))
    open_ = saved(open_.drop("n", "own", "rare"), "near-open")
    left = open_.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).drop("blocks")
    right = open_.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    l, r = left.alias("l"), right.alias("r")
    # a pair that meets in several buckets counts in the first: if a member is a pivot there, it is decided
    first_met = ~F.exists(F.zip_with("l.s.before", "r.s.before", lambda x, y: x == y), lambda same: same)
    met = l.join(
        r,
        (F.col("l.bucket") == F.col("r.bucket")) & (F.col("l.block") == F.col("r.block")) & (F.col("l.comp") < F.col("r.comp")) & _plausible("l.s", "r.s") & first_met & _bounded("l.s", "r.s"),
    ).select(F.col("l.key").alias("a"), F.col("r.key").alias("b"))
    tried = first.unionByName(first.select(F.col("b").alias("a"), F.col("a").alias("b")))
    more = saved(met.distinct().join(tried, ["a", "b"], "left_anti"), "near-candidates")
    if more.limit(1).count():
        links = saved(links.unionByName(verified(more, reps, docs)), "near-links")
        comps = components(links, reps)
    found = comps.select(F.col("key").alias("digest"), F.col("comp.doc").alias("of"))
    same = classes.withColumnRenamed("doc_id", "least").join(found, "digest", "left").select("digest", F.coalesce("of", "least").alias("component_id"))
    verdict = signed.select("doc_id", "text_key", "n_shingles", "digest").join(same, "digest", "left")
    component = F.when(F.col("doc_id").isNull() | F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return verdict.select("doc_id", "text_key", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def text_key(text: F.Column) -> F.Column:
    """What tells rows of one doc_id apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are the least doc_id of their component. A row of a repeated doc_id goes for its
    own text only."""
    gone = near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("__gone"), F.col("text_key").alias("__gone_text"))
    gone = saved(gone.distinct(), "near-gone")
    same = (docs["doc_id"].cast("long") == gone["__gone"]) & (text_key(docs["text"]) == gone["__gone_text"])
    return docs.join(small(gone), same, "left_anti")


def op2_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text_key")


OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM words),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
items AS (SELECT doc_id, unnest(s) AS x FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT s.a, s.b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b
  WHERE 100 * s.k >= 80 * (x.n + y.n - s.k)),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT s.doc_id, s.n AS n_shingles, min(r.b) AS component_id, s.doc_id = min(r.b) AS kept
FROM sizes s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.n
"""
