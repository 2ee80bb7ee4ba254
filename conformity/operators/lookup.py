"""Joins that look a row's key up and cannot change the number of rows.

Rows without a usable key, often most of a table, need no partner: they are dealt by their own values, not by
the key that they do not have. Keys that hold a large share of all rows can be found by counting and split: their
rows go to several tasks, and the one row that they look up goes to each of these.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tasks that rows without a key, and those of a frequent key, are dealt to.
SPREAD = 4096
SALT = "__salt"


def _hashable(t: T.DataType) -> bool:
    if isinstance(t, T.ArrayType):
        return _hashable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_hashable(f.dataType) for f in t.fields)
    return not isinstance(t, T.MapType | T.VariantType)


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns that can be hashed."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)], F.lit(0))


def frequent_keys(df: DataFrame, key: Column, share: float) -> list[Any]:
    """The non-null keys with more than ``share`` of all rows: fewer than 1 / share of them, by one counting job."""
    seen = Observation()
    counts = df.observe(seen, F.count(F.lit(1)).alias("rows")).groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")).where("key IS NOT NULL")
    top = counts.orderBy(F.desc("n")).limit(math.ceil(1 / share)).collect()
    return [r["key"] for r in top if r["n"] > share * seen.get["rows"]]


def outer_lookup(df: DataFrame, right: DataFrame, on: list[tuple[Column, str]], frequent: list[Any] = ()) -> DataFrame:
    """Left join with ``right``, whose rows are unique by the columns named in ``on`` (pairs of an expression over
    ``df`` and such a column); these columns go.

    ``frequent``: values of the first key to split.
    """
    left = {f"__on{i}": c for i, (c, _) in enumerate(on)}
    names = [r for _, r in on]
    spread = row_hash(df)
    wide = df.withColumns(left)
    keyless = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in left])
    # always 0, but not to the optimizer: a constant would leave the join's keys
    zero = lambda keys: F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(1)).cast("int")
    dealt = F.pmod(spread, F.lit(SPREAD)).cast("int")
    own, theirs = F.when(keyless, dealt), right.withColumn(SALT, zero(names))
    if frequent:
        copies = min(SPREAD, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        own = own.when(F.col("__on0").isin(*frequent), F.pmod(spread, F.lit(copies)).cast("int"))
        each = F.when(F.col(f"`{names[0]}`").isin(*frequent), F.sequence(F.lit(0), F.lit(copies - 1))).otherwise(F.array(zero(names)))
        theirs = right.withColumn(SALT, F.explode(each))
    wide = wide.withColumn(f"{SALT}_own", own.otherwise(zero(left)))
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"`{r}`") for c, r in zip(left, names, strict=True)])
    return wide.join(theirs, same & (F.col(f"{SALT}_own") == F.col(SALT)), "left").drop(*left, *names, f"{SALT}_own", SALT)


def unique_lookup(table: DataFrame, key: Column, fields: dict[str, Column]) -> DataFrame:
    """key, ambiguous and payload (struct of ``fields``), one row per non-null key.

    A key with differing payloads is ambiguous and has no payload; equal payloads count once.
    """
    packed = F.struct(*[c.alias(n) for n, c in fields.items()])
    grouped = table.select(key.alias("key"), packed.alias("held")).where("key IS NOT NULL").groupBy("key")
    # struct comparison treats nulls as values, so least and greatest differ exactly if two payloads do
    found = grouped.agg(F.min("held").alias("lo"), F.max("held").alias("hi"))
    differ = ~F.col("lo").eqNullSafe(F.col("hi"))
    return found.select("key", differ.alias("ambiguous"), F.when(~differ, F.col("lo")).alias("payload"))


class Rows:
    """A frame under resolution: strategies look values up, each distinct lookup is joined once.

    ``split_share``: keys with more than this share of all rows are counted and split; without it none are.
    """

    def __init__(self, df: DataFrame, dims: dict[str, DataFrame], split_share: float | None = None):
        self.df, self.dims, self.split_share = df, dims, split_share
        self._joined: dict[tuple, str] = {}

    def lookup(self, name: tuple, on: Column, table: DataFrame) -> tuple[Column, Column]:
        """(payload, ambiguous) of the row of a ``unique_lookup`` table whose key equals ``on``.

        ``name`` identifies the lookup: a second strategy with the same one shares the join.
        """
        if name not in self._joined:
            at = f"__lookup_{len(self._joined)}"
            right = table.select(F.col("key").alias(f"{at}_key"), F.struct("payload", "ambiguous").alias(at))
            frequent = frequent_keys(self.df, on, self.split_share) if self.split_share else ()
            self.df = outer_lookup(self.df, right, [(on, f"{at}_key")], frequent)
            self._joined[name] = at
        at = self._joined[name]
        return F.col(f"{at}.payload"), F.coalesce(F.col(f"{at}.ambiguous"), F.lit(False))
