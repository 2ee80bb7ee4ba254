"""Sharding by balanced label propagation, in DataFrame operations only.

Documents that share a link key (here: equal texts) are neighbours of each other. A document's label is
its shard. Votes are never sent along single edges: documents of one key and one shard act alike, so the
state is a table of cells (key, shard, documents), at most ``shards`` cells per key however large its
group, and one round is a few joins on it:

1. each cell joins its key's votes and picks the shard with room that holds most neighbours, ties to the
   lower shard number; the gain is the neighbours there less those at home;
2. the moves wanted into one shard are ordered by gain and admitted while the shard's quota lasts; the move
   on the border is split;
3. moved cells join those already there.

A round never raises the number of cut edges, and rounds stop when none moves. While rounds run, a shard may
hold up to ``SLACK`` times its share of documents, so that full shards can still exchange; then what exceeds
a share goes to shards with room, whole keys first as far as they fit. Unlinked documents fill what each
shard has left. The law is ``rows``: shard sizes differ by one document at most.

A null text counts as no text: 8 bytes, unlinked; its checksum is that of the empty text. Empty texts are
equal texts. Repeated rows are placed each. Null doc_ids are placed like others. An empty table gives no
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_saved, numbered, prepare, saved

SHARDS = 24
SLACK = 2
#: Wanted moves are summed in bins before single moves are ordered: 32 by gain, each by hash so that a bin has
#: about so many cells.
GAIN_BINS, BIN_CELLS = 32, 8192


def _quotas(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _lookup(values: list[int], at) -> F.Column:
    """values[at] for a table of one entry per shard."""
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), at + 1)


def _moves(cells: DataFrame, free: list[int], count: int) -> DataFrame:
    """The moves (key, shard, to, moved) that one round admits on ``count`` cells (key, shard, n); ``free``:
    room per shard."""
    bins = -(-count // BIN_CELLS) or 1
    room = F.array(*[F.lit(v).cast("long") for v in free])
    by_key = Window.partitionBy("key")
    open_votes = F.when(F.element_at(room, F.col("shard") + 1) > 0, F.struct(F.col("n"), (-F.col("shard")).alias("s")))
    wanted = (
        cells.withColumn("best", F.max(open_votes).over(by_key))
        .withColumn("to", (-F.col("best.s")).cast("int"))
        .withColumn("gain", F.col("best.n") - F.col("n"))
        .where("best IS NOT NULL AND `to` <> shard AND (gain > 0 OR (gain = 0 AND `to` < shard))")
        .select("key", "shard", "n", "to", "gain")
    )
    bin_ = F.least(F.lit(GAIN_BINS - 1), F.floor(F.log2(F.col("gain") + 1))) * -bins + F.pmod(F.xxhash64("key"), F.lit(bins))
    wanted = wanted.withColumn("bin", bin_.cast("long"))
    sums = wanted.groupBy("to", "bin").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("to").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("to", "bin", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("to", "bin").orderBy(F.desc("gain"), "key", "shard").rowsBetween(Window.unboundedPreceding, -1)
    return (
        wanted.join(sums, ["to", "bin"])
        .withColumn("start", F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .withColumn("moved", F.greatest(F.lit(0), F.least(F.col("n"), F.element_at(room, F.col("to") + 1) - F.col("start"))))
        .where("moved > 0")
        .select("key", "shard", "to", "moved")
    )


def _moved(cells: DataFrame, moves: DataFrame) -> DataFrame:
    """Cells after moves."""
    out, in_ = (F.struct(F.col(c).cast("int").alias("shard"), n.alias("n")) for c, n in (("shard", -F.col("moved")), ("to", F.col("moved"))))
    deltas = moves.select("key", F.explode(F.array(out, in_)).alias("d"))
    return cells.unionByName(deltas.select("key", "d.shard", "d.n")).groupBy("key", "shard").agg(F.sum("n").alias("n")).where("n > 0")


def loads(cells: DataFrame, shards: int) -> tuple[list[int], int]:
    """Documents per shard, and the number of cells."""
    found = {r["shard"]: r for r in cells.groupBy("shard").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("cells")).collect()}
    return [found[s]["n"] if s in found else 0 for s in range(shards)], sum(r["cells"] for r in found.values())


def propagate(cells: DataFrame, quotas: list[int], rounds: int | None = None) -> tuple[DataFrame, list[int]]:
    """Cells after rounds under the quotas until none moves (or ``rounds`` of them), and the linked documents
    per shard. Every move brings a key's documents closer together (the sum of its cells' squares grows), so
    rounds end."""
    done = 0
    while True:
        load, count = loads(cells, len(quotas))
        if done == rounds:
            return cells, load
        moves = saved(_moves(cells, [max(0, q - x) for q, x in zip(quotas, load, strict=True)], count), "shard-moves")
        if not moves.limit(1).count():
            drop_saved(moves)
            return cells, load
        after = saved(_moved(cells, moves), "shard-cells")
        drop_saved(cells, moves)
        cells, done = after, done + 1


def balanced_shards(docs: DataFrame, shards: int = SHARDS, rounds: int | None = None) -> DataFrame:
    """Columns of ``docs`` (a saved table with doc_id and a nullable link ``key``), shard and slot."""
    groups = docs.where("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("__copies")).where("__copies > 1")
    # a hot key's rows meet one small row here: Spark splits such a partition
    tagged = saved(docs.join(groups, "key", "left").withColumn("__linked", F.col("__copies").isNotNull()).drop("__copies"), "shard-rows")
    order = [F.col(c) for c in ("doc_id", "size", "text_crc32")]
    total, linked = (tagged.agg(F.count(F.lit(1)).alias("n"), F.count_if("__linked").alias("k")).first())
    quotas = _quotas(total, shards)
    members = saved(numbered(tagged.where("__linked"), ["key"], order, "__rank"), "shard-members")
    # the start: each key's documents dealt round, so that all shards are even and no text is ahead
    start = F.pmod(F.xxhash64("key") + F.col("__rank"), F.lit(shards)).cast("int")
    cells = members.groupBy("key", start.alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    cells, _ = propagate(saved(cells, "shard-cells"), [SLACK * q for q in quotas], rounds)
    cells = saved(_fit(cells, quotas), "shard-cells")
    load, _ = loads(cells, shards)
    # ranks of a key go to its cells in order of size, then shard
    ahead = Window.partitionBy("key").orderBy(F.desc("n"), "shard").rowsBetween(Window.unboundedPreceding, -1)
    spans = cells.withColumn("lo", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    placed = spans.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("lo", "shard"))).alias("spans"))  # at most one span per shard
    at = F.aggregate("spans", F.lit(-1), lambda found, x: F.when(x["lo"] <= F.col("__rank"), x["shard"]).otherwise(found))
    columns = [*docs.columns, "shard"]
    grouped = members.join(placed, "key").withColumn("shard", at).select(*columns)
    rest = numbered(tagged.where("NOT __linked"), [], order, "__rank", rows=total - linked)
    shard, upto = F.lit(shards - 1), 0
    bounds = []
    for s, (q, x) in enumerate(zip(quotas, load, strict=True)):
        upto += q - x
        bounds.append((s, upto))
    for s, b in reversed(bounds[:-1]):
        shard = F.when(F.col("__rank") < b, F.lit(s)).otherwise(shard)
    singles = rest.withColumn("shard", shard.cast("int")).select(*columns)
    return numbered(grouped.unionByName(singles), ["shard"], order, "slot")


def _fit(cells: DataFrame, quotas: list[int]) -> DataFrame:
    """Cells within the quotas: rows over a shard's quota go to shards with room, in the order of key, so
    that only keys at the borders of ranges are cut."""
    found, count = loads(cells, len(quotas))
    load = dict(enumerate(found))
    over = [max(0, load.get(s, 0) - q) for s, q in enumerate(quotas)]
    if not any(over):
        return cells
    # each row of an over-full shard has its number there; those past the quota fill the free rooms in turn
    bins = cells.withColumn("bin", F.pmod(F.xxhash64("key"), F.lit(-(-count // BIN_CELLS) or 1)).cast("int"))
    earlier = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = bins.groupBy("shard", "bin").agg(F.sum("n").alias("m")).select("shard", "bin", F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "bin").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    at = bins.join(sums, ["shard", "bin"]).withColumn("start", F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    stay = F.greatest(F.lit(0), F.least(F.col("n"), _lookup(quotas, F.col("shard")) - F.col("start")))
    at = at.withColumn("stay", stay)
    base, upto = [], 0
    for x in over:
        base.append(upto)
        upto += x
    # numbers of the surplus rows: a cell's surplus is a range [first, first + n - stay)
    first = _lookup(base, F.col("shard")) + F.greatest(F.lit(0), F.col("start") - _lookup(quotas, F.col("shard")))
    surplus = at.where("n > stay").withColumn("first", first).withColumn("last", F.col("first") + F.col("n") - F.col("stay"))
    rooms, upto = [], 0
    for s, q in enumerate(quotas):
        free = max(0, q - load.get(s, 0))
        rooms.append((s, upto, upto + free))
        upto += free
    overlap = lambda lo, hi: F.greatest(F.lit(0), F.least(F.col("last"), F.lit(hi)) - F.greatest(F.col("first"), F.lit(lo))).cast("long")
    parts = F.array(*[F.struct(F.lit(s).alias("shard"), overlap(lo, hi).alias("n")) for s, lo, hi in rooms])
    moved = surplus.select("key", F.explode(parts).alias("p")).select("key", "p.shard", "p.n")
    return at.select("key", "shard", F.col("stay").alias("n")).unionByName(moved).where("n > 0").groupBy("key", "shard").agg(F.sum("n").alias("n"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document."""
    prepare(docs.sparkSession)
    text = F.col("text").cast("string")
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("key"),
    )
    placed = balanced_shards(saved(narrow, "shard-docs"), shards, rounds)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op1_shard(spark, sf_dir: str) -> DataFrame:
    return shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
