"""Numbers in the order of a key, without one task per key.

Rows are dealt to ranges of (key, order), so that a key with any share of the rows is as many ranges as it
needs. A row's place within its range comes from the sort; ranges are counted per key, and prefix sums over
these few counts shift the places of each range behind those of the earlier ones.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

AT, PART, SHIFT = "__rank_at", "__rank_part", "__rank_shift"
#: ``monotonically_increasing_id`` counts the rows of a partition in this many low bits.
ROW_BITS = 33


def in_order(df: DataFrame, by: list[str], order: list[Column], name: str, hold: Callable[[DataFrame], DataFrame], ranges: int | None = None) -> DataFrame:
    """Add ``name``: 1, 2, 3... within each ``by`` (of no columns: over all rows) in the given order.

    Null keys are keys. ``order`` has to tell rows apart wherever it matters which comes first. ``hold`` makes
    the dealt rows final (held by the context, or written): ranges are found by sampling, and all that follows
    has to read the same ones. ``ranges``: by default twice as many as Spark's shuffle partitions, over which
    the ranges of a key are then dealt by hash.
    """
    n = ranges or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(f"`{c}`").asc_nulls_first() for c in by]
    dealt = df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
    placed = hold(dealt.withColumn(AT, F.monotonically_increasing_id()))
    placed = placed.withColumn(PART, F.shiftright(AT, ROW_BITS))
    runs = placed.groupBy(*[F.col(f"`{c}`").alias(f"__rank_k{i}") for i, c in enumerate(by)], F.col(PART).alias("__rank_p")).agg(F.min(AT).alias("__rank_first"), F.count(F.lit(1)).alias("__rank_n"))
    # one row for each key and range: a key has no more of them than there are ranges
    earlier = Window.partitionBy(*[f"__rank_k{i}" for i in range(len(by))]).orderBy("__rank_p").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn(SHIFT, F.coalesce(F.sum("__rank_n").over(earlier), F.lit(0)) - F.col("__rank_first") + 1)
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"__rank_k{i}")) for i, c in enumerate(by)], F.col(PART) == F.col("__rank_p"))
    numbered = placed.join(runs, same)
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(AT) + F.col(SHIFT)).alias(name))


def dense_ranks(df: DataFrame, by: list[str], order: list[Column], over: list[str], hold: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """The distinct values of ``by`` and ``over`` with their number in the order of their key: rows of equal
    values share it."""
    return in_order(df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*by, *over])]).distinct(), by, order, name, hold)
