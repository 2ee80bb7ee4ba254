"""Strategies by stage and name, with the definitions that catalogs publish."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

STAGES = ("dedup", "selection", "resolve", "metric", "enrich", "derive")


@dataclass(frozen=True)
class Strategy:
    stage: str
    name: str
    run: Callable[..., Any]
    version: int = 1
    description: str = ""
    outcomes: dict[str, str] = field(default_factory=dict)
    #: Row columns the strategy reads, by parameter, with their default column.
    inputs: dict[str, str] = field(default_factory=dict)
    #: Checks parameters against (params, columns, identity).
    check: Callable[..., None] | None = None
    #: Selectors a matcher works with, and the identity fields its members have if they cross ids.
    selectors: frozenset[str] = frozenset()
    grain: Callable[[dict, list[str]], list[str]] | None = None

    @property
    def ref(self) -> str:
        return f"{self.stage}.{self.name}@{self.version}"

    def definition(self) -> dict[str, Any]:
        inputs = {k: {"default_field": v} for k, v in self.inputs.items()}
        return {
            "id": self.ref,
            "name": self.name,
            "stage": self.stage,
            "version": self.version,
            "description": self.description,
            "outcomes": dict(self.outcomes),
            "inputs": inputs,
        }


class Registry:
    """Named strategies per stage; a name is given once."""

    def __init__(self) -> None:
        self._held: dict[tuple[str, str], Strategy] = {}

    def add(self, stage: str, name: str, **about: Any) -> Callable[[Callable], Callable]:
        if stage not in STAGES:
            raise ValueError(f"Unknown stage: {stage}")

        def register(run: Callable) -> Callable:
            if (stage, name) in self._held:
                raise ValueError(f"Strategy registered twice: {stage}.{name}")
            self._held[stage, name] = Strategy(stage, name, run, **about)
            return run

        return register

    def get(self, stage: str, name: Any) -> Strategy:
        if (stage, name) not in self._held:
            raise ValueError(f"Unregistered {stage} strategy: {name}")
        return self._held[stage, name]

    def has(self, stage: str, name: Any) -> bool:
        return (stage, name) in self._held

    def stage(self, stage: str) -> dict[str, Strategy]:
        return {n: s for (k, n), s in self._held.items() if k == stage}

    def definitions(self) -> dict[str, dict[str, Any]]:
        return {s.ref: s.definition() for s in self._held.values()}


REGISTRY = Registry()
