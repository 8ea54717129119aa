"""Vocabulary: the names that sources use for the keys that the engine works with."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Vocabulary:
    """columns and values map a key to a name, lists map a key to names in order. A key without a name stands for itself.

    Names may have {placeholders}, which name() fills.
    """

    columns: dict[str, str] = field(default_factory=dict)
    lists: dict[str, tuple[str, ...]] = field(default_factory=dict)
    values: dict[str, str] = field(default_factory=dict)

    def name(self, key: str, **fill: object) -> str:
        found = self.columns.get(key, key)
        return found.format(**fill) if fill else found

    def names(self, key: str) -> tuple[str, ...]:
        return self.lists.get(key, ())

    def value(self, key: str) -> str:
        return self.values.get(key, key)


KINDS = ("column", "list", "value")


def from_table(table: DataFrame) -> Vocabulary:
    """From a small table of Kind, Key and Name; a list's items are in the order of their rows' Position column if there
    is one. Every fault is told at once: unknown kinds, empty keys or names, and keys given twice."""
    rows = table.orderBy("Position").collect() if "Position" in table.columns else table.collect()
    columns, lists, values, faults = {}, {}, {}, []
    for i, r in enumerate(rows, 1):
        kind, key, name = (str(r[k]).strip() if r[k] is not None else "" for k in ("Kind", "Key", "Name"))
        if kind.lower() not in KINDS:
            faults.append(f"row {i}: kind {kind!r} is none of {', '.join(KINDS)}")
        elif not key or not name:
            faults.append(f"row {i}: key and name must not be empty")
        elif kind.lower() == "list":
            lists.setdefault(key, []).append(name)
        elif key in (target := columns if kind.lower() == "column" else values):
            faults.append(f"row {i}: {key!r} is given twice")
        else:
            target[key] = name
        faults += [f"row {i}: placeholder in {name!r} isn't closed"] * bool(re.search(r"\{[^}]*$", name))
    if faults:
        raise ValueError("vocabulary: " + "; ".join(faults))
    return Vocabulary(columns, {k: tuple(v) for k, v in lists.items()}, values)
