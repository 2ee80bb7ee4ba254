"""Extraction of flat rows from nested JSON files."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .json_ranges import json_lines, large_files


#: Files above so many bytes are cut into records by many tasks; smaller ones are read whole, one to a task.
SPLIT_ABOVE = 64 << 20


def read_records(spark: SparkSession, path: str | list[str], results_key: str = "results", split_above: int | None = None) -> DataFrame:
    """JSON files; if one wraps its records in ``results_key``, one row per record."""
    files = large_files(spark, [path] if isinstance(path, str) else path, SPLIT_ABOVE if split_above is None else split_above)
    if files:
        return spark.read.json(json_lines(spark, files, results_key))
    raw = spark.read.option("multiLine", True).json(path)
    if results_key not in raw.columns:
        return raw
    return raw.select(F.explode(results_key).alias("__record")).select("__record.*")


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Structs become columns named parent, separator, child, at any depth, after the other columns.

    The schema is walked once and one projection does it all; arrays stay. Two paths with one name fail.
    """
    plain: list[tuple[str, str]] = []
    nested: list[tuple[str, str]] = []

    def walk(struct: T.StructType, path: str, name: str, out: list[tuple[str, str]]) -> None:
        for f in struct.fields:
            p, n = f"{path}.`{f.name}`", f"{name}{separator}{f.name}"
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType, p, n, out)
            else:
                out.append((p, n))

    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            walk(f.dataType, f"`{f.name}`", f.name, nested)
        else:
            plain.append((f"`{f.name}`", f.name))
    names = [n for _, n in plain + nested]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"Flattening gives several columns one name: {twice}")
    return df.select(*[F.col(p).alias(n) for p, n in plain + nested])


def object_rows(df: DataFrame, entity: dict[str, Any]) -> DataFrame:
    """One flat row per record, without the columns listed in ``drop``."""
    flat = flatten(df)
    return flat.drop(*[c for c in entity.get("drop", []) if c in flat.columns])


def nested_rows(df: DataFrame, entity: dict[str, Any]) -> DataFrame:
    """One flat row per element of the array ``explode``, with ``parent_cols`` of its record.

    ``node_path`` unwraps each element. Records whose array is null or empty give no row.
    """
    parents = [F.col(raw).alias(alias) for raw, alias in entity.get("parent_cols", {}).items()]
    items = df.select(*parents, F.explode(F.col(entity["explode"])).alias("__item"))
    inner = f"__item.{entity['node_path']}" if entity.get("node_path") else "__item"
    kept = [c for c in items.columns if c != "__item"]
    opened = items.select(*kept, F.col(inner).alias("__node")).select(*kept, "__node.*")
    return object_rows(opened, entity)


SHAPES: dict[str, Callable[[DataFrame, dict[str, Any]], DataFrame]] = {"object": object_rows, "nested_array": nested_rows}


def shape_rows(df: DataFrame, entity: dict[str, Any]) -> DataFrame:
    shape = entity.get("shape")
    if shape not in SHAPES:
        raise ValueError(f"Unknown shape: {shape}; known: {sorted(SHAPES)}")
    return SHAPES[shape](df, entity)


def extract(spark: SparkSession, path: str | list[str], entity: dict[str, Any]) -> DataFrame:
    """Flat rows of one entity from its bronze file."""
    if entity.get("shape") not in SHAPES:
        shape_rows(None, entity)
    return shape_rows(read_records(spark, path, entity.get("results_key", "results")), entity)
