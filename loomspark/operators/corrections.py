"""Known corrections as rules: replaced values and texts, set cells, changed units, in a declared order."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E

INTEGRITY, SCALE = "integrity", "scale"
#: Before coercion and after it.
STAGE = {"set": INTEGRITY, "replace_text": INTEGRITY, "replace_values": INTEGRITY, "divide_by": SCALE}


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    action: str
    value: str | float | None = None
    pairs: tuple[tuple[str, str], ...] = ()
    site: str = ""
    when_column: str = ""
    when_equals: str = ""
    reason: str = ""
    enabled: bool = True


@dataclass
class Outcome:
    rule: str
    column: str
    rows: int = 0
    skipped: str = ""


def from_rows(rows: Iterable[dict]) -> list[Rule]:
    """Rules from table rows; a rule's pairs (Old, New) are on consecutive rows of one name. All faults are told at once."""
    found: dict[str, dict] = {}
    faults: list[str] = []
    text = lambda x: "" if x is None else str(x).strip()
    for n, r in enumerate(rows, 1):
        name, action = text(r.get("Name")), text(r.get("Action"))
        if not name or not text(r.get("Column")):
            faults.append(f"row {n}: name and column must not be empty")
            continue
        if action not in STAGE:
            faults.append(f"row {n}: action {action!r} is none of {', '.join(STAGE)}")
            continue
        rule = found.setdefault(name, {"row": n, "column": text(r["Column"]), "action": action, "site": text(r.get("Site")), "when_column": text(r.get("When column")), "when_equals": text(r.get("When equals")), "reason": text(r.get("Reason")), "enabled": text(r.get("Enabled")).lower() not in ("no", "n", "false", "0"), "pairs": []})
        if (rule["column"], rule["action"]) != (text(r["Column"]), action):
            faults.append(f"row {n}: rule {name!r} changes its column or action")
        rule["pairs"].append((text(r.get("Old")), text(r.get("New"))))
    rules = []
    for name, r in found.items():
        new = r["pairs"][0][1]
        if r["action"] == "divide_by":
            factor = float(new) if new.replace(".", "", 1).replace("e", "", 1).replace("+", "", 1).isdigit() else 0.0
            if not factor:
                faults.append(f"row {r['row']}: {name!r} divides by {new!r}")
        if r["action"] == "replace_values" and len({o for o, _ in r["pairs"]}) < len(r["pairs"]):
            faults.append(f"row {r['row']}: {name!r} replaces a value twice")
        if bool(r["when_column"]) != bool(r["when_equals"]):
            faults.append(f"row {r['row']}: {name!r} has half a condition")
        if not faults:
            single = r["action"] in ("set", "divide_by")
            rules.append(Rule(name, r["column"], r["action"], (float(new) if r["action"] == "divide_by" else new or None) if single else None, () if single else tuple(r["pairs"]), r["site"], r["when_column"], r["when_equals"], r["reason"], r["enabled"]))
    if faults:
        raise ValueError("corrections: " + "; ".join(faults))
    return rules


def to_rows(rules: Sequence[Rule]) -> list[dict]:
    """What from_rows reads."""
    out = []
    for r in rules:
        for old, new in r.pairs or (("", "" if r.value is None else str(r.value)),):
            out.append({"Name": r.name, "Site": r.site, "Column": r.column, "Action": r.action, "Old": old, "New": new, "When column": r.when_column, "When equals": r.when_equals, "Reason": r.reason, "Enabled": "yes" if r.enabled else "no"})
    return out


def _condition(rule: Rule) -> Column:
    if not rule.when_column:
        return F.lit(True)
    return F.coalesce(F.trim(E.c(rule.when_column).cast("string")) == rule.when_equals.strip(), F.lit(False))


def _changed(rule: Rule, x: Column) -> Column:
    """x after the rule, without its condition."""
    if rule.action == "set":
        return F.lit(rule.value).cast("string")
    if rule.action == "replace_text":
        for old, new in rule.pairs:
            x = F.replace(x, F.lit(old), F.lit(new))
        return x
    if rule.action == "replace_values":
        out = x
        for old, new in reversed(rule.pairs):
            out = F.when(x == old, new if new else F.lit(None)).otherwise(out)
        return out
    return E.safe_div(x, F.lit(float(rule.value)))


def apply(df: DataFrame, rules: Sequence[Rule], stage: str, site: str = "", disabled: Sequence[str] = (), count: bool = True) -> tuple[DataFrame, list[Outcome]]:
    """df with the rules of one stage, in order: one projection, and one aggregate for all counts of rows changed."""
    columns = {c: E.c(c) for c in df.columns}
    outcomes, counters = [], []
    for r in (r for r in rules if STAGE[r.action] == stage and r.site in ("", site)):
        why = "disabled" if not r.enabled or r.name in disabled else f"no column {r.column}" if r.column not in columns else f"no column {r.when_column}" if r.when_column and r.when_column not in df.columns else ""
        outcomes.append(out := Outcome(r.name, r.column, skipped=why))
        if why:
            continue
        before = columns[r.column] if stage == SCALE else columns[r.column].cast("string")
        after = F.when(_condition(r), _changed(r, before)).otherwise(before)
        columns[r.column] = after
        counters.append((out, F.count_if(~before.eqNullSafe(after))))
    if counters and count:
        found = df.agg(*(c.alias(f"n{k}") for k, (_, c) in enumerate(counters))).first()
        for k, (out, _) in enumerate(counters):
            out.rows = found[k]
    return df.select(*(x.alias(n) for n, x in columns.items())), outcomes
