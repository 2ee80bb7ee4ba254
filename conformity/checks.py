"""Assertions over data, fused into one job."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A frame, the condition that no row may meet, and what to say if one does.
Check = tuple[DataFrame, Column, str]


def require(checks: Iterable[Check]) -> None:
    """Run all checks as one aggregate each in a single job; raise the first that fails."""
    checks = list(checks)
    if not checks:
        return
    parts = [df.agg(F.count_if(bad).alias("n")).select(F.lit(i).alias("i"), "n") for i, (df, bad, _) in enumerate(checks)]
    failed = reduce(DataFrame.unionByName, parts).where("n > 0").collect()  # at most one row per check
    if failed:
        raise ValueError(checks[min(r["i"] for r in failed)][2])


@dataclass(frozen=True)
class Rule:
    """What must not occur among the rows of a frame or, with ``by``, among its groups by that column (rows
    where it is null are in none); ``values`` are the groups' aggregates that ``bad`` reads."""

    bad: Column
    message: str
    by: str | None = None
    values: dict[str, Column] = field(default_factory=dict)


@dataclass(frozen=True)
class Same:
    """Two frames that must hold the same rows, as often each, in some columns.

    The job of the rules compares their fingerprints, and counts the rows of ``right`` that are ``wrong`` in themselves.
    Only if these say so the rows themselves are compared, by ``exact``: pairs of frames with who would have changed
    the first into the second.
    """

    left: DataFrame
    right: DataFrame
    columns: list[str]
    exact: list[tuple[DataFrame, DataFrame, str]]
    wrong: Column | None = None


#: Shuffle files go with the job that wrote them, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def cleaned_up(spark: SparkSession) -> Iterator[None]:
    """Frames that are made here run once: their shuffle files go when their job ends."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def _sums(columns: list[str]) -> list[Column]:
    """The parts of a fingerprint; those of groups add up to the whole's. Sums of 21 or 22 bits do not overflow."""
    held = [F.col(f"`{c}`") for c in columns]
    hashes = F.xxhash64(*held, F.lit(0)), F.xxhash64(F.lit("second"), *held, F.lit(1))
    bits = [part for h in hashes for part in (F.shiftrightunsigned(h, 42), F.shiftrightunsigned(h, 21).bitwiseAND(F.lit(0x1FFFFF)), h.bitwiseAND(F.lit(0x1FFFFF)))]
    return [F.count(F.lit(1)), *[F.coalesce(F.sum(part), F.lit(0)) for part in bits]]


def fingerprint(columns: list[str]) -> Column:
    """An aggregate that is equal for equal multisets of rows in any order: how many there are, and sums of two
    hashes of each."""
    return F.concat_ws("/", *[part.cast("string") for part in _sums(columns)])


def _told(row: DataFrame, n: dict[int, str], said: dict[int, str]) -> DataFrame:
    """What a row of aggregates says, as rows: the number of each rule or side, its count and its fingerprint."""
    one, nothing = F.lit(1).cast("long"), F.lit(None).cast("string")
    each = [F.struct(F.lit(i).alias("i"), F.col(n[i]).alias("n") if i in n else one.alias("n"), F.col(said[i]).alias("said") if i in said else nothing.alias("said")) for i in {**n, **said}]
    return row.select(F.explode(F.array(*each)).alias("c")).select("c.*")


def _aggregated(df: DataFrame, by: str | None, keys: list[Column], groups: dict[int, Rule], rows: dict[int, Column], prints: dict[int, list[str]]) -> DataFrame:
    """How many groups break each rule and how many rows are bad, and fingerprints, by one aggregation of the groups and
    one of their results."""
    held = [(f"b{i}", F.count_if(bad)) for i, bad in rows.items()]
    held += [(f"f{-i}_{j}", part) for i, columns in prints.items() for j, part in enumerate(_sums(columns))]
    if by is None:
        df = df.agg(*[part.alias(name) for name, part in held])
    else:
        # rows without a value are in no group; a filter would be pushed below the exchange of rows that other parts read
        here = F.min(F.col(by).isNotNull()).alias("__here")
        values = {n: c for r in groups.values() for n, c in r.values.items()} | dict(held)
        df = df.groupBy(*[c.alias(f"__key{i}") for i, c in enumerate(keys)]).agg(here, *[c.alias(n) for n, c in values.items()])
        df = df.agg(*[F.count_if(F.col("__here") & r.bad).alias(f"n{i}") for i, r in groups.items()], *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name, _ in held])
    for i, columns in prints.items():
        df = df.withColumn(f"f{-i}", F.concat_ws("/", *[F.col(f"f{-i}_{j}").cast("string") for j in range(len(_sums(columns)))]))
    return _told(df, {i: f"n{i}" for i in groups} | {i: f"b{i}" for i in rows}, {i: f"f{-i}" for i in prints})


def require_rules(
    df: DataFrame, rules: Iterable[Rule], same: Iterable[Same] = (), first: int = 0, whole: tuple[str, list[str]] = ("", []), long: Collection[str] = ()
) -> None:
    """Check all rules in a single job with one aggregation per grouping; raise one of the ``first`` rules that
    is broken, or else what changed rows, or else another rule that is broken.

    ``same``: frames to compare in the same job, which aggregates each once and shuffles no rows of them. ``whole``:
    a column whose groups lie in one task each, and columns that give the same groups; what is asked of rows is aggregated
    with these. ``long``: columns to group by 64 bits of hash, which are less to shuffle and can only join groups; a rule
    that such groups break is checked again with the values.
    """
    rules, same = list(rules), list(same)
    groupings = {by: {i: r for i, r in enumerate(rules) if r.by == by} for by in dict.fromkeys(r.by for r in rules)}
    alone = {i: r.bad for i, r in groupings.pop(None, {}).items()}
    sides: dict[int, tuple[DataFrame, dict[int, Column], dict[int, list[str]]]] = {id(df): (df, alone, {})}  # a frame is aggregated once
    for i, s in enumerate(same):
        for at, frame in ((-1 - 3 * i, s.left), (-2 - 3 * i, s.right)):
            sides.setdefault(id(frame), (frame, {}, {}))[2][at] = s.columns
        if s.wrong is not None:
            sides[id(s.right)][1][-3 - 3 * i] = s.wrong
    with cleaned_up(df.sparkSession):
        parts = []
        _, rows, prints = sides.pop(id(df)) if whole[0] in groupings else (df, {}, {})
        for by, mine in groupings.items():
            keys = [*map(F.col, whole[1])] if by == whole[0] else [F.xxhash64(by) if by in long else F.col(by)]
            parts.append(_aggregated(df, by, keys, mine, *((rows, prints) if by == whole[0] else ({}, {}))))
        parts += [_aggregated(frame, None, [], {}, bad, columns) for frame, bad, columns in sides.values() if bad or columns]
        found = {r["i"]: r["said"] for r in reduce(DataFrame.unionByName, parts).where("n > 0").collect()} if parts else {}  # a row per rule and side
        for by in long:
            if again := {i: r for i, r in groupings.get(by, {}).items() if i in found}:
                held = {r["i"] for r in _aggregated(df, by, [F.col(by)], again, {}, {}).where("n > 0").collect()}
                found = {i: said for i, said in found.items() if i in held or i not in again}
    broken = min((i for i in found if i >= 0), default=len(rules))
    if broken < first:
        raise ValueError(rules[broken].message)
    for i, s in enumerate(same):
        if found[-1 - 3 * i] != found[-2 - 3 * i] or -3 - 3 * i in found:
            require([(same_rows(got.select(*given.columns), given), F.lit(True), message) for given, got, message in s.exact])
            raise ValueError(s.exact[-1][2])
    if broken < len(rules):
        raise ValueError(rules[broken].message)


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that two frames hold a different number of times (multiset difference both ways)."""
    return a.exceptAll(b).unionByName(b.exceptAll(a))
