"""Reading, joining and upserting tables."""

from __future__ import annotations

from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import table_schema
from .store import State, Store


#: The table of a store that holds nothing else.
ROWS = "rows"


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, plain Parquet or one made by ``upsert``, or None if there is none; any other
    failure is raised."""
    store = Store(spark, path)
    if store.versions():
        return store.read(ROWS)
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e.getCondition() if hasattr(e, "getCondition") else e):
            raise
    return None


def empty_table(spark: SparkSession, model: dict[str, Any], table: str) -> DataFrame:
    return spark.createDataFrame([], table_schema(model, table))


def read_or_empty(spark: SparkSession, path: str, model: dict[str, Any], table: str) -> DataFrame:
    """An optional dimension: typed and empty where the client has none."""
    found = read_or_none(spark, path)
    return empty_table(spark, model, table) if found is None else found


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def merged(target: DataFrame | None, source: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with the rows of ``source`` replacing those of equal keys and the others added: what an upsert
    gives, as a plan and without writing.

    Null keys equal nothing: such rows are added again by every run.
    """
    if target is None:
        return source
    return target.join(source.select(*keys).distinct(), keys, "left_anti").unionByName(source)


def upsert(spark: SparkSession, source: DataFrame, path: str, keys: list[str], buckets: int | None = None) -> State:
    """Merge into the keyed table at ``path``, whose buckets without incoming keys are left alone."""
    with Store(spark, path).begin() as run:
        run.upsert(ROWS, source, keys, buckets)
    return run.committed


def join_sources(frames: list[DataFrame], on: list[Any] | None, how: str = "inner") -> DataFrame:
    """Fold-join frames; ``on`` holds shared names or {"left", "right"} pairs, whose left names stay."""
    out = frames[0]
    for right in frames[1:]:
        keys = on or []
        if all(isinstance(k, str) for k in keys):
            out = out.join(right, list(keys), how)
            continue
        pairs = [(k, k) if isinstance(k, str) else (k["left"], k["right"]) for k in keys]
        renamed = right
        temporary = {}
        for i, (_, r) in enumerate(pairs):
            temporary[r] = f"__right_{i}"
            renamed = renamed.withColumnRenamed(r, temporary[r])
        condition = F.lit(True)
        for left, r in pairs:
            condition = condition & (out[left] == renamed[temporary[r]])
        out = out.join(renamed, condition, how).drop(*temporary.values())
    return out


def load_source(name: str, meta: dict[str, Any], read) -> DataFrame:
    """A gold table's source: its silver tables by ``read(name)``, joined as its metadata says."""
    source = meta["source"]
    frames = []
    for table in source["tables"]:
        df = read(table)
        if df is None:
            raise FileNotFoundError(f"{name}: source table {table} is missing")
        frames.append(df)
    how = source.get("how", "inner")
    return frames[0] if len(frames) == 1 else join_sources(frames, source.get("on"), "inner" if how == "single" else how)
