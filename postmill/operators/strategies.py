"""Strategies that depend on each other: an order for them, and which of them find something."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import Column
from pyspark.sql import functions as F


def order(needs: Mapping[str, Sequence[str]]) -> list[str]:
    """Strategies so that each comes after those that it needs, else as given. A circle or an unknown name is an error."""
    if unknown := {n for ns in needs.values() for n in ns} - set(needs):
        raise ValueError(f"unknown strategies: {sorted(unknown)}")
    sorter, place, out = TopologicalSorter(needs), {s: k for k, s in enumerate(needs)}, []
    try:
        sorter.prepare()
    except CycleError as e:
        raise ValueError(f"strategies need each other: {e.args[1]}") from e
    ready: list[str] = []
    while sorter.is_active():
        ready = sorted([*ready, *sorter.get_ready()], key=place.__getitem__)
        out.append(ready.pop(0))
        sorter.done(out[-1])
    return out


def run_in_order(found: Mapping[str, Column], needs: Mapping[str, Sequence[str]]) -> Column:
    """Array of the strategies that find something while all that they need have found something too."""
    state = F.array().cast("array<string>")
    for name in order(needs):
        state = _then(state, name, found[name], needs[name])
    return state


def _then(state: Column, name: str, hit: Column, needed: Sequence[str]) -> Column:
    """The state is bound once by a lambda, as it is named several times."""

    def step(done: Column) -> Column:
        may = F.coalesce(hit, F.lit(False))
        for n in needed:
            may = may & F.array_contains(done, n)
        return F.when(may, F.array_append(done, F.lit(name))).otherwise(done)

    return F.get(F.transform(F.array(state), step), F.lit(0))
