"""Whitening of embeddings by a tiled covariance.

Vectors become rows of integers, and the fit list is each distinct row once. Its rows are cut into row-blocks
and these into column blocks of ``TILE`` dimensions, which are written once. A pair of column ranges is a tile
of the covariance: column blocks meet by row-block, each tile's pair of them is multiplied, and the products
are summed per tile, entry by entry and per task first. Only the covariance itself, with as many entries as
pairs of dimensions, is assembled and decomposed on the driver.

Centres are exact: sums of integers give each dimension's mean as a whole number and a fraction below one, and
rows are centred before anything is multiplied. The same tiles, over the whitened fit list, measure how far its
covariance is from the identity.

Rows whose vector is null or holds a null or a non-finite entry give nothing. The dimension is the commonest
length of the others (of equally common ones the longest); rows of other lengths give nothing. Components of no
variance (an eigenvalue within rounding of 0) cannot be scaled and are left out, so that fewer than ``COMPONENTS``
remain where the fit list spans fewer dimensions; equal vectors alone, and an empty table, give no rows. Repeated
rows and ids are each whitened; null ids stay null. A deviation beyond a long is null. Entries beyond
about 1e16 are held at that bound. Only vec_id and the vector are read, so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import claim, drop_saved, prepare, saved

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Dimensions to a tile's side, and bytes of a row-block.
TILE, BLOCK_BYTES = 32, 4 << 20
#: Entries are held within +- this, far below where a long ends.
MOST = 1 << 60
BLOCKS = "row_block string, tile int, width int, values binary"


def integer_rows(frame: DataFrame, vector: str) -> DataFrame:
    """vec_id and ``x``, the vector as integers, of all rows with a whole finite vector."""
    given = F.col(f"`{vector}`")
    whole = given.isNotNull() & F.forall(given, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    held = lambda c: F.greatest(F.lit(-float(MOST)), F.least(F.lit(float(MOST)), F.floor(c.cast("double") * SCALE).cast("double")))
    return frame.where(whole).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(given, lambda c: held(c).cast("long") + OFFSET).alias("x"))


def _matrices(batches: Iterable[pa.RecordBatch], column: str, kind: type) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Each batch with its vectors as a matrix."""
    claim("whitening")
    for batch in batches:
        if batch.num_rows:
            yield batch, batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(batch.num_rows, -1)


def dimension_sums(rows: DataFrame, column: str) -> tuple[int, list]:
    """How many vectors there are and the sum of each dimension; each task adds its own first.

    Sums of integers are exact: a task adds halves of each number apart, and Spark adds decimals.
    """
    whole = dict(rows.dtypes)[column] == "array<bigint>"

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, 0, 0
        for batch, matrix in _matrices(batches, column, np.int64 if whole else np.float64):
            n += batch.num_rows
            if whole:
                high, low = high + (matrix >> 32).sum(axis=0), low + (matrix & 0xFFFFFFFF).sum(axis=0)
            else:
                high, low = high + matrix.sum(axis=0), low + np.zeros(matrix.shape[1])
        if n:
            d = len(high)
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array(high), pa.array(low)], ["i", "n", "high", "low"])

    kind = "long" if whole else "double"
    total = (lambda c: F.sum(F.col(c).cast("decimal(38,0)"))) if whole else F.sum
    parts = rows.select(column).mapInArrow(add, f"i int, n long, high {kind}, low {kind}")
    found = parts.groupBy("i").agg(F.sum("n").alias("n"), total("high").alias("high"), total("low").alias("low")).orderBy("i").collect()
    sums = [(int(r["high"]) << 32) + int(r["low"]) if whole else r["high"] for r in found]
    return (found[0]["n"] if found else 0), sums


@dataclass(frozen=True)
class Centre:
    """The mean of each dimension: a whole number and a fraction."""

    n: int
    sums: list
    base: np.ndarray
    rest: np.ndarray

    @staticmethod
    def of(n: int, sums: list) -> Centre:
        if all(isinstance(s, int) for s in sums):
            base = [(2 * s + n) // (2 * n) for s in sums]
            rest = [(s - b * n) / n for s, b in zip(sums, base, strict=True)]
            return Centre(n, sums, np.array(base, np.int64), np.array(rest))
        return Centre(n, sums, np.zeros(len(sums)), np.array(sums) / max(n, 1))

    def centred(self, rows: np.ndarray) -> np.ndarray:
        return (rows - self.base).astype(np.float64) - self.rest


def column_blocks(rows: DataFrame, column: str, centre: Centre) -> DataFrame:
    """The centred rows as column blocks, each with the row-block and the tile range it is of."""
    whole = dict(rows.dtypes)[column] == "array<bigint>"
    d = len(centre.sums)
    most = max(64, BLOCK_BYTES // (8 * max(d, 1)))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            matrix = np.concatenate(held)
            starts = range(0, d, TILE)
            cells = [np.ascontiguousarray(matrix[:, a : a + TILE]) for a in starts]
            names = [f"{part}-{number}"] * len(cells)
            return pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(range(len(cells)), pa.int32()), pa.array([c.shape[1] for c in cells], pa.int32()), pa.array([c.tobytes() for c in cells], pa.binary())],
                ["row_block", "tile", "width", "values"],
            )

        for _, matrix in _matrices(batches, column, np.int64 if whole else np.float64):
            for at in range(0, len(matrix), most):
                held.append(centre.centred(matrix[at : at + most]))
                if sum(map(len, held)) >= most:
                    yield block()
                    held, number = [], number + 1
        if held:
            yield block()

    return rows.select(column).mapInArrow(cut, BLOCKS)


def tiled_covariance(rows: DataFrame, column: str, centre: Centre) -> np.ndarray:
    """The covariance with divisor n of all vectors, from products of column blocks summed per tile."""
    spark = rows.sparkSession
    d = len(centre.sums)
    blocks = saved(column_blocks(rows, column, centre), "whitening-blocks")

    @pandas_udf("array<double>")
    def product(a: pd.Series, wide: pd.Series, b: pd.Series, high: pd.Series) -> pd.Series:
        of = lambda data, width: np.frombuffer(data, np.float64).reshape(-1, width)
        return pd.Series([(of(x, w).T @ of(y, h)).ravel() for x, w, y, h in zip(a, wide, b, high, strict=True)], dtype=object)

    left = blocks.select("row_block", F.col("tile").alias("i"), F.col("width").alias("wide"), F.col("values").alias("a"))
    right = blocks.select("row_block", F.col("tile").alias("j"), F.col("width").alias("high"), F.col("values").alias("b"))
    pairs = left.join(right, "row_block").where("i <= j")
    per = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")  # a row holds two column blocks
    try:
        products = pairs.select("i", "j", F.posexplode(product("a", "wide", "b", "high")).alias("at", "part"))
        summed = products.groupBy("i", "j", "at").agg(F.sum("part").alias("v"))
        # one row for each tile, of TILE * TILE entries at most
        tiles = summed.groupBy("i", "j").agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("cells")).select("i", "j", "cells.v").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(per))
    out = np.zeros((d, d))
    for i, j, cells in tiles:
        a, b = i * TILE, j * TILE
        wide, high = min(TILE, d - a), min(TILE, d - b)
        tile = np.array(cells).reshape(wide, high)
        out[a : a + wide, b : b + high] = tile
        out[b : b + high, a : a + wide] = tile.T
    drop_saved(blocks)
    return out / max(centre.n, 1)


@dataclass(frozen=True)
class Whitening:
    """The centre, unit eigenvectors as columns by falling eigenvalue, and what each explains."""

    centre: Centre
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def of(self, rows: np.ndarray) -> np.ndarray:
        return self.centre.centred(rows) @ self.vectors / np.sqrt(self.values)

    def deviations(self, rows: np.ndarray) -> list[int | None]:
        """Sums over dimensions of (n * x - S)**2, exact."""
        n, base = self.centre.n, self.centre.base
        rest = [s - int(b) * n for s, b in zip(self.centre.sums, base, strict=True)]  # below n
        from_base = rows - base
        most = (int(np.abs(from_base).max(initial=0)) + 1) * n
        if most * most * max(rows.shape[1], 1) < 1 << 63:
            return ((n * from_base - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum((n * x - r) ** 2 for x, r in zip(row, rest, strict=True)) for row in from_base.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def fit_whitening(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the fit list (``x``); None if it is empty."""
    n, sums = dimension_sums(distinct, "x")
    if not n:
        return None
    centre = Centre.of(n, sums)
    covariance = tiled_covariance(distinct, "x", centre)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    real = values > max(values[0], 0) * len(values) * np.finfo(float).eps
    k = min(components, int(real.sum()))
    trace = float(np.trace(covariance))
    return Whitening(centre, np.ascontiguousarray(vectors[:, :k]), values[:k].copy(), values[:k] / (trace or 1.0))


def whitened_vectors(rows: DataFrame, by: Whitening) -> DataFrame:
    """vec_id, deviation and the whitened vector of integer rows."""

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, matrix in _matrices(batches, "x", np.int64):
            k = by.vectors.shape[1]
            flat, starts = pa.array(by.of(matrix).ravel()), pa.array(range(0, k * len(matrix) + 1, k) if k else [0] * (len(matrix) + 1), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(by.deviations(matrix), pa.int64()), pa.ListArray.from_arrays(starts, flat)], ["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "x").mapInArrow(project, "vec_id long, deviation long, whitened array<double>")


def identity_error(distinct: DataFrame, by: Whitening) -> float:
    """The largest entry of the whitened fit list's covariance less the identity, measured on its rows."""
    if not len(by.values):
        return 0.0
    rows = whitened_vectors(distinct.withColumn("vec_id", F.lit(0).cast("long")), by)
    centre = Centre.of(*dimension_sums(rows, "whitened"))
    return float(np.abs(tiled_covariance(rows, "whitened", centre) - np.eye(len(by.values))).max())


def whiten(frame: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error: a row for each row and component."""
    spark = prepare(frame.sparkSession)
    rows = integer_rows(frame, vector)
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = lengths[0]["d"] if lengths else 0
    rows = rows.where(F.size("x") == d)
    distinct = saved(rows.select("x").distinct(), "whitening-fit")
    by = fit_whitening(distinct, components) if d else None
    if by is None or not len(by.values):
        drop_saved(distinct)
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    error = identity_error(distinct, by)
    drop_saved(distinct)
    out = whitened_vectors(rows, by).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.element_at(F.array(*[F.lit(float(v)) for v in by.explained]), F.col("at") + 1)
    return out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(by.centre.n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
