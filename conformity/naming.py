"""How silver columns are named in gold tables: the one place that knows the prefix rules."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "_e_"
RESERVED = "__mm_"


@dataclass(frozen=True)
class Names:
    """Naming of one table: ``<entity>_e_<column>``, the grain key as ``<entity>_e_id``."""

    entity: str
    grain_pk: str | None = None
    carried: dict[str, str] = field(default_factory=dict)
    system: tuple[str, ...] = ("source_platform",)

    @classmethod
    def of(cls, name: str, meta: dict[str, Any]) -> Names:
        return cls(
            meta.get("entity", name),
            meta.get("grain_pk"),
            dict(meta.get("source", {}).get("carried_keys", {})),
            tuple(meta.get("system_columns", ["source_platform"])),
        )

    def gold(self, column: str) -> str:
        """The gold name of a bare column; system, prefixed and engine columns keep theirs."""
        if column in self.system or MARK in column or column.startswith(RESERVED):
            return column
        if column == self.grain_pk:
            return f"{self.entity}{MARK}id"
        return f"{self.entity}{MARK}{self.carried.get(column, column)}"

    def all(self, columns: Iterable[str]) -> list[str]:
        return [self.gold(c) for c in columns]

    def apply(self, df: DataFrame) -> DataFrame:
        """All columns renamed in one projection; two columns with one gold name are an error."""
        named = self.all(df.columns)
        twice = sorted({n for n in named if named.count(n) > 1})
        if twice:
            raise ValueError(f"Columns collide after prefixing: {twice}")
        return df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, named, strict=True)])


def identity_columns(name: str, meta: dict[str, Any]) -> set[str]:
    """Columns a metric may group over: the table's own keys and every resolved target."""
    names = Names.of(name, meta)
    return set(names.all(meta.get("own_keys", []))) | set(meta.get("resolve", {}))


def public_surface(name: str, meta: dict[str, Any]) -> set[str]:
    """Columns other tables may bring: native, resolved and metric columns."""
    base = set(Names.of(name, meta).all(meta.get("base_columns", [])))
    return base | set(meta.get("resolve", {})) | {m["name"] for m in meta.get("metrics", [])}
