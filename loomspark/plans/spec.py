"""A task as data: one question, its cohort, target, roles, predictors and knobs, from YAML that is validated as a whole."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, fields, replace
from datetime import date
from pathlib import Path

import yaml

from ..operators import decorrelate, encode
from ..operators.cohort import OPERATORS, Filter
from . import recipe

KINDS = ("numeric", "binary", "periods")


@dataclass(frozen=True)
class Target:
    column: str = ""
    kind: str = "numeric"
    positive: tuple[str, ...] = ()
    negative: tuple[str, ...] = ()
    periods: tuple[tuple[str, date, date], ...] = ()


@dataclass(frozen=True)
class Task:
    name: str = "task"
    question: str = ""
    seed: int = 0
    site: str = ""
    filters: tuple[Filter, ...] = ()
    date_column: str = ""
    date_from: date | None = None
    date_to: date | None = None
    aliases: dict[str, str] = field(default_factory=dict)
    target: Target = Target()
    id_column: str = ""
    group_column: str = ""
    patient_column: str = ""
    exclude: dict[str, str] = field(default_factory=dict)
    include: tuple[str, ...] | None = None
    categories: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = field(default_factory=dict)
    options: recipe.Options = recipe.Options()
    stability: float | None = None
    report: bool = True

    def as_dict(self) -> dict:
        return asdict(self)


_TOP = {"task", "site", "cohort", "target", "roles", "predictors", "encoding", "clustering", "missingness", "report"}


def _knobs(kind, given: dict, where: str, faults: list[str]):
    """A dataclass of numbers with given ones replaced; names, types and ranges are checked."""
    known = {f.name: f.default for f in fields(kind)}
    out = {}
    for k, v in (given or {}).items():
        if k not in known:
            faults.append(f"{where}.{k} is unknown")
        elif isinstance(known[k], bool) != isinstance(v, bool) or isinstance(known[k], (int, float)) and not isinstance(v, (int, float)):
            faults.append(f"{where}.{k}: {v!r} isn't {type(known[k]).__name__}")
        elif isinstance(known[k], float) and 0 < known[k] < 1 and not 0 <= v <= 1:
            faults.append(f"{where}.{k} must lie between 0 and 1")
        else:
            out[k] = v
    return replace(kind(), **out)


def _day(value, where: str, faults: list[str]) -> date | None:
    if value is None or isinstance(value, date):
        return value
    try:
        return date.fromisoformat(str(value))
    except ValueError:
        faults.append(f"{where}: {value!r} isn't a date")
        return None


def parse(raw: dict) -> Task:
    faults: list[str] = [f"unknown section {k}" for k in raw if k not in _TOP]
    section = lambda k: raw.get(k) or {}
    filters = []
    for n, f in enumerate(section("cohort").get("filters") or [], 1):
        ops = [k for k in f if k in OPERATORS]
        extra = set(f) - set(OPERATORS) - {"column", "missing", "normalise", "label"}
        if len(ops) != 1 or not f.get("column"):
            faults.append(f"cohort.filters[{n}]: one column and one operator are needed")
            continue
        if extra:
            faults.append(f"cohort.filters[{n}]: unknown {', '.join(sorted(extra))}")
        if f.get("missing", "exclude") not in ("include", "exclude"):
            faults.append(f"cohort.filters[{n}].missing must be include or exclude")
        if ops[0] in ("in", "not_in") and not isinstance(f[ops[0]], list):
            faults.append(f"cohort.filters[{n}].{ops[0]} must be a list")
            continue
        value = tuple(f[ops[0]]) if isinstance(f[ops[0]], list) else f[ops[0]]
        filters.append(Filter(f["column"], ops[0], value, f.get("missing", "exclude"), bool(f.get("normalise")), f.get("label", "")))
    t = section("target")
    kind = t.get("kind", "numeric")
    if not t.get("column"):
        faults.append("target.column is required")
    if kind not in KINDS:
        faults.append(f"target.kind must be one of {', '.join(KINDS)}")
    if kind == "binary" and not t.get("positive"):
        faults.append("target.positive is required for a binary target")
    periods = []
    for n, p in enumerate(t.get("periods") or [], 1):
        start, end = (_day(p.get(k), f"target.periods[{n}].{k}", faults) for k in ("from", "to"))
        if start and end and start > end:
            faults.append(f"target.periods[{n}] ends before it starts")
        if start and end:
            periods.append((str(p.get("label", n)), start, end))
    for a, b in zip(sorted(periods, key=lambda p: p[1]), sorted(periods, key=lambda p: p[1])[1:]):
        if b[1] <= a[2]:
            faults.append(f"target.periods {a[0]} and {b[0]} overlap")
    if kind == "periods" and len({p[0] for p in periods}) < 2:
        faults.append("target.periods needs two labels")
    roles = section("roles")
    used = [v for v in (*(roles.get(k) for k in ("id", "group", "patient")), t.get("column")) if v]
    if len(set(used)) < len(used):
        faults.append("a column has two roles")
    c = section("cohort")
    start, end = _day(c.get("date_from"), "cohort.date_from", faults), _day(c.get("date_to"), "cohort.date_to", faults)
    if (start or end) and not c.get("date_column"):
        faults.append("cohort.date_column is required for a date window")
    if start and end and start > end:
        faults.append("cohort.date_from is after cohort.date_to")
    p, cl, m = section("predictors"), dict(section("clustering")), section("missingness")
    action, stable = cl.pop("action", "describe"), cl.pop("min_stability", None)
    if action not in decorrelate.ACTIONS:
        faults.append(f"clustering.action must be one of {', '.join(decorrelate.ACTIONS)}")
    if section("encoding").get("target_encoding_fallback", "hashing") not in ("hashing", "stop"):
        faults.append("encoding.target_encoding_fallback must be hashing or stop")
    exclude = {}
    for n, x in enumerate(p.get("exclude") or [], 1):
        if isinstance(x, dict) and x.get("column") and x.get("reason"):
            exclude[x["column"]] = x["reason"]
        else:
            faults.append(f"predictors.exclude[{n}]: a column and a reason are needed")
    categories: dict = {}
    for k, name in ((0, "include_by_catalog"), (1, "exclude_by_catalog")):
        for column, values in (p.get(name) or {}).items():
            pair = list(categories.get(column, ((), ())))
            pair[k] = tuple(values if isinstance(values, list) else [values])
            categories[column] = tuple(pair)
    options = recipe.Options(_knobs(encode.Knobs, section("encoding"), "encoding", faults), _knobs(decorrelate.Knobs, cl, "clustering", faults), action, int(m.get("least_values", 20)), bool(m.get("indicators", False)), bool(m.get("impute", False)), tuple(p.get("prefer") or ()))
    if faults:
        raise ValueError("task: " + "; ".join(faults))
    head = section("task")
    return Task(head.get("name", "task"), head.get("question", ""), int(head.get("seed", 0)), raw.get("site") or "", tuple(filters), c.get("date_column", ""), start, end, dict(c.get("aliases") or {}), Target(t["column"], kind, tuple(t.get("positive") or ()), tuple(t.get("negative") or ()), tuple(periods)), roles.get("id", ""), roles.get("group", ""), roles.get("patient", ""), exclude, tuple(p["include"]) if p.get("include") else None, categories, options, stable, bool(section("report").get("write", True)) if isinstance(raw.get("report"), dict) else True)


def load(path: str | Path) -> Task:
    return parse(yaml.safe_load(Path(path).read_text()) or {})


def template(name: str, target: str, question: str = "", site: str = "", exclude: dict[str, str] | None = None) -> str:
    """A task file to start from."""
    body = {"task": {"name": name, "question": question, "seed": 0}, "site": site, "cohort": {"filters": []}, "target": {"column": target, "kind": "numeric"}, "roles": {"id": ""}, "predictors": {"exclude": [{"column": c, "reason": r} for c, r in (exclude or {}).items()]}, "clustering": {"action": "describe"}}
    return yaml.safe_dump(body, sort_keys=False, allow_unicode=True)
