"""Configuration contracts of resolution chains, client policies and deduplication steps.

The grammar is stated as data, a form for each kind of document. A form checks a value, fills in what may be
left out and says where a mistake is; what relates several parts to each other is checked afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from copy import deepcopy
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter
from typing import Any

from ..registry import REGISTRY, Registry, Strategy

#: Takes a value and what to call it, and gives the checked value.
Form = Callable[[Any, str], Any]


def exactly(kind: type | tuple[type, ...], called: str, nonempty: bool = False) -> Form:
    def check(value: Any, at: str) -> Any:
        if not isinstance(value, kind) or (nonempty and not value):
            raise ValueError(f"{at} must be {called}")
        return deepcopy(value)

    return check


def only_value(wanted: Any, why: str) -> Form:
    def check(value: Any, at: str) -> Any:
        if value != wanted:
            raise ValueError(f"{at}: {why}")
        return value

    return check


TEXT, OBJECT, FLAG = exactly(str, "a nonempty string", True), exactly(dict, "an object"), exactly(bool, "true or false")


@dataclass(frozen=True)
class Record:
    """An object with these keys alone; ``needs`` must be there, ``filled`` stands for others that are not."""

    parts: dict[str, Form]
    needs: tuple[str, ...] = ()
    filled: dict[str, Any] = field(default_factory=dict)

    def __call__(self, value: Any, at: str) -> dict[str, Any]:
        given = _only(value, set(self.parts), at, set(self.needs))
        whole = {**deepcopy(self.filled), **given}
        return {k: self.parts[k](v, f"{at}, {k}") for k, v in whole.items()}


@dataclass(frozen=True)
class Items:
    """A nonempty list whose entries have different names."""

    form: Form
    name: Callable[[Any], str] = str

    def __call__(self, value: Any, at: str) -> list[Any]:
        if not isinstance(value, list) or not value:
            raise ValueError(f"{at} must be a nonempty list")
        out = {}
        for i, entry in enumerate(value):
            checked = self.form(entry, f"{at}[{i}]")
            if self.name(checked) in out:
                raise ValueError(f"{at} has {self.name(checked)} twice")
            out[self.name(checked)] = checked
        return list(out.values())


@dataclass(frozen=True)
class Named:
    """An object of any names whose values have one form."""

    form: Form

    def __call__(self, value: Any, at: str) -> dict[str, Any]:
        return {TEXT(k, f"A name in {at}"): self.form(v, f"{at}, {k}") for k, v in OBJECT(value, at).items()}


def _only(given: Any, allowed: set[str], what: str, needed: set[str] = frozenset()) -> dict[str, Any]:
    """``given`` if it is an object with these keys alone."""
    if not isinstance(given, dict) or not needed <= set(given) or set(given) - allowed:
        raise ValueError(f"{what} takes {sorted(allowed)}" + (f" and needs {sorted(needed)}" if needed else ""))
    return given


def _step(value: Any, at: str) -> dict[str, Any]:
    """A resolver step; a name alone is a step, and a step without an id has its strategy's name."""
    form = Record({"strategy": TEXT, "id": TEXT, "params": OBJECT}, ("strategy",), {"params": {}})
    step = form({"strategy": value} if isinstance(value, str) else value, at)
    return {"id": step.get("id", step["strategy"]), "strategy": step["strategy"], "params": step["params"]}


STEPS = Items(_step, lambda s: s["id"])
CHAIN = Record({"strategies": STEPS}, ("strategies",))
RESOLVER = Record({"strategies": STEPS, "by_platform": Named(CHAIN)}, ("strategies",), {"by_platform": {}})
#: A policy's resolve and dedup sections replace a table's as they are written.
SECTIONS = Record({"resolve": Named(lambda v, at: RESOLVER(v, at) and deepcopy(v)), "dedup": exactly((dict, type(None)), "an object")}, ("resolve",))
POLICY = Record({"schema_version": only_value(1, "a client policy needs schema_version 1"), "tables": Named(SECTIONS)}, ("schema_version", "tables"))
SELECTION = Record({"strategy": TEXT, "params": OBJECT}, (), {"params": {}})
DEDUP_STEP = Record(
    {"id": TEXT, "strategy": exactly((str, type(None)), "a strategy's name"), "params": OBJECT, "selection": SELECTION, "on_ambiguity": only_value("fail", "ambiguity can only fail")},
    ("id", "selection"), {"params": {}, "strategy": None},
)
DEDUP = Record(
    {"identity": Items(TEXT), "strategies": Items(DEDUP_STEP, lambda s: s["id"]), "allow_identity_merge": FLAG}, ("identity", "strategies"), {"allow_identity_merge": False}
)


def chains(spec: Any) -> dict[str | None, list[dict[str, Any]]]:
    """Steps per platform; None is the chain of all platforms without their own (and of null)."""
    held = RESOLVER(spec, "A resolver")
    return {None: held["strategies"], **{p: variant["strategies"] for p, variant in held["by_platform"].items()}}


def chain_steps(spec: Any) -> list[dict[str, Any]]:
    """The default chain's steps with id, strategy and params filled in."""
    return chains(spec)[None]


def inputs_of(step: dict[str, Any], strategy: Strategy) -> dict[str, str]:
    """The column behind each of a step's parameters, given or by default."""
    extra = sorted(set(step["params"]) - set(strategy.inputs))
    if extra:
        raise ValueError(f"{strategy.name} has no parameters {extra}")
    return {k: TEXT(step["params"].get(k, column), f"{strategy.name}, {k} (a column)") for k, column in strategy.inputs.items()}


def resolution_order(specs: dict[str, Any], registry: Registry = REGISTRY, available: Iterable[str] = ()) -> list[str]:
    """Targets in an order in which each comes after those its strategies read; as declared otherwise."""
    there, graph = set(available) | set(specs), {}
    for target, spec in specs.items():
        steps = [s for steps in chains(spec).values() for s in steps]
        reads = {c for s in steps for c in inputs_of(s, registry.get("resolve", s["strategy"])).values()}
        if reads - there:
            raise ValueError(f"{target}: its strategies read columns that are not there: {sorted(reads - there)}")
        graph[target] = reads & set(specs)
    sorter: TopologicalSorter[str] = TopologicalSorter(graph)
    try:
        sorter.prepare()
    except CycleError as e:
        raise ValueError(f"Resolvers read each other in a cycle: {e.args[1]}") from e
    place, order = list(specs), []
    while sorter.is_active():
        ready = sorted(sorter.get_ready(), key=place.index)
        order += ready
        sorter.done(*ready)
    return order


def with_policy(tables: dict[str, Any], policy: Any) -> dict[str, Any]:
    """Table metadata with a client's resolve (and dedup) sections in place of its own.

    The policy must name every table; a section replaces, it never adds to the one before.
    """
    sections = POLICY(policy, "A client policy")["tables"]
    if sections.keys() != tables.keys():
        raise ValueError("A client policy must cover every gold table (resolve: {} where nothing is resolved)")
    return {name: {**deepcopy(meta), **sections[name]} for name, meta in tables.items()}


def fields(given: Any, columns: list[str], what: str) -> list[str]:
    """A nonempty list of existing columns."""
    if not isinstance(given, list) or not given or any(not isinstance(c, str) or c not in columns for c in given):
        raise ValueError(f"{what} must be a nonempty list of existing columns")
    return given


def _pairs(steps: list[dict[str, Any]], registry: Registry) -> Iterator[tuple[dict[str, Any], Strategy, Strategy]]:
    for step in steps:
        yield step, registry.get("dedup", step["strategy"]), registry.get("selection", step["selection"].get("strategy"))


def check_dedup(spec: Any, columns: list[str], registry: Registry = REGISTRY) -> None:
    """The grammar of a registered deduplication and, through its strategies, their parameters."""
    held = DEDUP(spec, "dedup")
    identity = fields(held["identity"], columns, "The dedup identity")
    crossing = []
    for step, matcher, selector in _pairs(held["strategies"], registry):
        foreign = [s.name for s in (matcher, selector) if s.check is None]
        if foreign:
            raise ValueError(f"Unregistered as a matcher or selector: {foreign}")
        if selector.name not in matcher.selectors:
            raise ValueError(f"{step['id']}: {matcher.name} and {selector.name} are incompatible")
        matcher.check(step["params"], columns, identity)
        selector.check(step["selection"]["params"], columns, identity)
        if matcher.grain:
            crossing.append(tuple(matcher.grain(step["params"], identity)))
    if crossing and not held["allow_identity_merge"]:
        raise ValueError("Steps that match across ids need allow_identity_merge")
    if len(set(crossing)) > 1:
        raise ValueError("Steps that match across ids must have one identity grain")
