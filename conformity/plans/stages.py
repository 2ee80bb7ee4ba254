"""Barriers of a build: frames that several plans read are written once, and a build that died goes on from them.

What a build has written so far is in its store under ``stages/``, with the fingerprint of the build: its input
tables as they are, its configuration, its strategies and its day. A later build of the same fingerprint takes
over the run (its id and time too, so that all evidence names one run) and reads what is there; any other starts
anew. The commit that publishes a build drops its stages.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..registry import Registry
from ..sources.store import Conflict, Entry, Store, Transaction

RUN, PREFIX = "stages/run", "stages/"


def fingerprint(metas: dict[str, Any], inputs: dict[str, Any], registry: Registry, ctx: RunContext) -> str:
    """One digest of all that decides what a build gives."""
    said = {"tables": metas, "inputs": inputs, "strategies": registry.definitions(), "as_of": str(ctx.as_of)}
    return hashlib.sha256(json.dumps(said, sort_keys=True, default=str).encode()).hexdigest()


def with_grain(mapping: DataFrame, grain: tuple[str, ...]) -> DataFrame:
    """An alias map with the identity fields that its identities are made of."""
    return mapping.select("source_identity", "canonical_identity", F.lit(json.dumps(list(grain))).alias("identity_fields"))


def files_of(df: DataFrame) -> list[list[Any]]:
    """Path, size and time of each file that a frame reads."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    out = []
    for f in sorted(df.inputFiles()):
        at = jvm.org.apache.hadoop.fs.Path(f)
        status = at.getFileSystem(conf).getFileStatus(at)
        out.append([f, status.getLen(), status.getModificationTime()])
    return out


class Stages:
    """The barriers of one build."""

    def __init__(self, store: Store, ctx: RunContext, mark: str):
        self.store, self.ctx, self.mark = store, ctx, mark
        held = store.document(RUN)
        if held and held["fingerprint"] == mark:
            ctx.run_id, ctx.processed_at = held["run_id"], held["processed_at"]
            return
        with store.begin(ctx.run_id) as run:
            self.drop(run)
            run.put(RUN, {"fingerprint": mark, **ctx.stamp()})

    @staticmethod
    def drop(run: Transaction) -> None:
        """Let go of all stages, when the transaction commits."""
        for name in run.base.tables:
            if name.startswith(PREFIX):
                run.remove(name)

    def _mine(self) -> dict[str, Entry]:
        """The tables of the store, while the stages in it are this build's."""
        tables = self.store.state().tables
        if tables.get(RUN, {}).get("document", {}).get("fingerprint") != self.mark:
            raise Conflict("Another build of this client began, and dropped the stages of this one")
        return tables

    def settle(self, stage: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The frame as it was written, now or by the run that this one goes on from."""
        at = f"{PREFIX}{stage}/{name}"
        if at not in self._mine():
            with self.store.begin(self.ctx.run_id) as run:
                run.write(at, make())
        return self.store.frame(self._mine()[at])

    def settle_dedup(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A deduplicated table with its audit and aliases."""
        at, ctx = f"{PREFIX}dims/{name}", self.ctx
        if at not in self._mine():
            df = make()
            with self.store.begin(ctx.run_id) as run:
                run.write(at, df)
                if name in ctx.audits:
                    run.write(f"{at}/audit", ctx.audits[name])
                for i, (grain, mapping) in enumerate(ctx.aliases.get(name, {}).items()):
                    run.write(f"{at}/alias_{i}", with_grain(mapping, grain))
                run.put(f"{at}/grains", [list(g) for g in ctx.aliases.get(name, {})])
            ctx.release()
        tables, frame = self._mine(), self.store.frame
        if f"{at}/audit" in tables:
            ctx.audits[name] = frame(tables[f"{at}/audit"])
            ctx.aliases[name] = {tuple(g): frame(tables[f"{at}/alias_{i}"]) for i, g in enumerate(tables[f"{at}/grains"]["document"])}
        return frame(tables[at])

    def entry(self, stage: str) -> Entry | None:
        """A stage that is written."""
        return self.store.state().tables.get(f"{PREFIX}{stage}")


class Direct:
    """No barriers: every frame stays a plan."""

    def settle(self, stage: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        return make()

    def settle_dedup(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        return make()

    def entry(self, stage: str) -> Entry | None:
        return None


class Reads(dict):
    """Frames by name, and which of them were asked for."""

    def __init__(self, frames: dict[str, DataFrame]):
        super().__init__(frames)
        self.asked: set[str] = set()

    def __getitem__(self, name: str) -> DataFrame:
        self.asked.add(name)
        return super().__getitem__(name)

    def get(self, name: str, default: Any = None) -> Any:
        return self[name] if name in self else default


def looked_up(metas: dict[str, Any]) -> set[str]:
    """The tables that others bring columns from."""
    return reduce(set.union, [{e["from"] for e in m.get("enrich", [])} for m in metas.values()], set())
