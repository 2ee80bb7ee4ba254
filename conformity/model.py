"""The common data model: tables of string, double and timestamp columns, given as a document."""

from __future__ import annotations

from typing import Any

from pyspark.sql import types as T

KINDS: dict[str, T.DataType] = {"string": T.StringType(), "double": T.DoubleType(), "timestamp": T.TimestampType()}


def table_schema(model: dict[str, Any], table: str) -> T.StructType:
    """Schema of a model table; kinds the model does not know are strings."""
    columns = model["tables"][table]["columns"]
    kind = lambda v: KINDS.get(v if isinstance(v, str) else v.get("type", "string"), T.StringType())
    pairs = columns.items() if isinstance(columns, dict) else ((c, "string") for c in columns)
    return T.StructType([T.StructField(c, kind(v)) for c, v in pairs])


def reject_maps(df_schema: T.StructType) -> None:
    """Deduplication groups whole rows, and maps cannot be grouped in a defined way."""

    def holds_map(t: T.DataType) -> bool:
        if isinstance(t, T.MapType):
            return True
        if isinstance(t, T.ArrayType):
            return holds_map(t.elementType)
        return isinstance(t, T.StructType) and any(holds_map(f.dataType) for f in t.fields)

    bad = [f.name for f in df_schema.fields if holds_map(f.dataType)]
    if bad:
        raise ValueError(f"Map columns cannot be deduplicated; convert them upstream: {bad}")
