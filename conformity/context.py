"""What one run shares between stages."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import UTC, date, datetime
from typing import Any

from pyspark.sql import DataFrame

from .sources.shared import scratch


@dataclass
class RunContext:
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    processed_at: str = field(default_factory=lambda: datetime.now(UTC).isoformat())
    as_of: date | None = None
    #: Tables after dedup and prefixing (what resolvers look up), and frozen public surfaces.
    dims: dict[str, DataFrame] = field(default_factory=dict)
    surfaces: dict[str, DataFrame] = field(default_factory=dict)
    audits: dict[str, DataFrame] = field(default_factory=dict)
    #: Per table: identity fields -> (source_identity, canonical_identity).
    aliases: dict[str, dict[tuple[str, ...], DataFrame]] = field(default_factory=dict)
    #: Split keys with more than this share of a table's rows in lookups; None looks for none.
    split_share: float | None = None
    #: Rows of each table that the run published.
    rows: dict[str, int] = field(default_factory=dict)
    held: list[DataFrame] = field(default_factory=list)

    def day(self) -> date:
        """The processing date, unless one is given."""
        return self.as_of or datetime.fromisoformat(self.processed_at).date()

    def hold(self, df: DataFrame) -> DataFrame:
        """Persist a frame that several jobs read, until ``release``."""
        self.held.append(df.persist())
        return df

    def settle(self, df: DataFrame, name: str) -> DataFrame:
        """Write a frame to the shared folder and read it back: what follows has the same rows in the same
        partitions whatever happens to executors. ``release`` leaves it; it is as long-lived as the results."""
        path = scratch(df.sparkSession, name)
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        while self.held:
            self.held.pop().unpersist()

    def stamp(self) -> dict[str, Any]:
        return {"run_id": self.run_id, "processed_at": self.processed_at}
