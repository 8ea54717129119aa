"""Report payloads: trees of plain blocks, from results that are small already."""

from __future__ import annotations

from collections.abc import Sequence

from ..operators import correlation, derive, missingness


def heading(text: str) -> dict:
    return {"kind": "heading", "text": text}


def md(text: str) -> dict:
    return {"kind": "md", "text": text}


def table(headers: Sequence[str], rows: Sequence[Sequence], note: str = "") -> dict:
    return {"kind": "table", "headers": list(headers), "rows": [list(r) for r in rows], "text": note}


def facts(pairs: dict) -> dict:
    return table(("", ""), list(pairs.items()))


def code(text: str) -> dict:
    return {"kind": "code", "text": text}


def collapsed(label: str, children: Sequence[dict]) -> dict:
    return {"kind": "collapsed", "text": label, "children": cleaned(children)}


def chooser(label: str, options: dict[str, Sequence[dict]]) -> dict:
    return {"kind": "chooser", "text": label, "children": [collapsed(k, v) for k, v in options.items()]}


def download(label: str, filename: str, text: str) -> dict:
    return {"kind": "download", "text": label, "filename": filename, "content": text}


def figure(name: str, data: dict) -> dict:
    """Data of a figure; drawing it is the reader's."""
    return {"kind": "figure", "text": name, "data": data}


def cleaned(blocks: Sequence[dict | None]) -> list[dict]:
    return [b for b in blocks if b]


def dicts(rows: Sequence[dict]) -> dict | None:
    return table(list(rows[0]), [list(r.values()) for r in rows]) if rows else None


def build_payload(overview: dict, cleaning: Sequence, features: derive.Applied, checks, profiles: Sequence[dict], groups: Sequence[missingness.Group], ranks: Sequence[correlation.RankGroup], origins: dict[str, str] | None = None, excluded: Sequence[str] = ()) -> dict:
    blocks = [heading("Batch table"), facts(overview)]
    for r in cleaning:
        rows = [(kind, c, n) for kind, found in (("trimmed", r.cells_stripped), ("limits", r.censored), ("unreadable", r.unreadable), ("outside 0-100 %", r.out_of_percent), ("filled", r.filled)) for c, n in found.items()]
        blocks += [heading(f"Cleaning {r.site}"), table(("what", "column", "cells"), rows), collapsed("Corrections", [table(("rule", "column", "rows", "skipped"), [(o.rule, o.column, o.rows, o.skipped) for o in r.corrections])])]
    blocks += [heading("Derived columns"), facts({s: features.count(s) for s in ("created", "present", "blocked", "errored", "not in catalog")}), collapsed("Each of them", [dicts(features.entries)])]
    blocks += [heading("Catalog"), facts({"in the catalog, not in the data": len(checks.not_in_data), "in the data, not in the catalog": len(checks.not_in_catalog), "never recorded": len(checks.empty), "ids that repeat": len(checks.duplicate_ids)})]
    blocks += [heading("Missing values"), dicts(profiles), dicts([{"group": g.name, "members": "; ".join(g.members), "tightness": round(g.tightness, 3)} for g in groups])]
    blocks += [heading("Rank correlation"), dicts([{"group": g.name, "representative": g.representative, "usable": correlation.usable_representative(g, excluded), "members": "; ".join(m["parameter"] for m in g.members), "weakest": round(g.weakest, 3), "shared": g.shared} for g in ranks])]
    if origins:
        blocks += [heading("Where columns come from"), table(("column", "origin"), sorted(origins.items()))]
    return {"title": "Batch table", "blocks": cleaned(blocks)}


def catalog_payload(new: dict[str, list[str]], warnings: Sequence[str]) -> dict:
    return {"title": "Catalog", "blocks": cleaned([heading("New parameters"), *(collapsed(s, [table(("parameter",), [(n,) for n in names])]) for s, names in new.items() if names), heading("Warnings"), table(("warning",), [(w,) for w in warnings]) if warnings else md("none")])}


def task_payload(task, d) -> dict:
    """Question, cohort, target, parameters, encoders, clusters, dataset, notes."""
    return {"title": task.name, "blocks": cleaned([
        heading(task.question or task.name), facts({"rows": d.target.rows - d.target.missing - d.target.unreadable, "columns": len(d.recipe.output)}),
        heading("Cohort"), table(("step", "before", "removed", "left"), [(s.label, s.before, s.removed, s.left) for s in d.funnel]),
        heading("Target"), facts({"column": task.target.column, "missing": d.target.missing, "unreadable": d.target.unreadable, **d.target.classes}),
        heading("Parameters"), dicts(d.columns), collapsed("Left out", [dicts(d.left_out)]), collapsed("Dropped while fitting", [dicts(d.recipe.dropped)]),
        heading("Encoders"), figure("encoders", encoder_split(d.recipe)), heading("Clusters"), dicts(d.clusters),
        heading("Notes"), table(("note",), [(n,) for n in d.notes]) if d.notes else md("none")])}


def encoder_split(recipe) -> dict:
    out: dict[str, int] = {"number": len(recipe.numeric)}
    for e in recipe.encoders:
        out[e["encoder"]] = out.get(e["encoder"], 0) + 1
    return out


def histogram(df, column: str, bins: int = 20) -> dict:
    """Counts of a numeric column in equal bins: two aggregates."""
    from pyspark.sql import functions as F

    from ..functions import exprs as E

    low, high = df.agg(F.min(E.c(column)), F.max(E.c(column))).first()
    if low is None or low == high:
        return {"edges": [low, high], "counts": [df.where(E.c(column).isNotNull()).count()]}
    width = (high - low) / bins
    at = F.least(F.floor((E.c(column) - low) / width), F.lit(bins - 1))
    counts = {r[0]: r[1] for r in df.where(E.c(column).isNotNull()).groupBy(at.alias("b")).count().collect()}
    return {"edges": [low + k * width for k in range(bins + 1)], "counts": [counts.get(k, 0) for k in range(bins)]}


def missing_bars(profiles: Sequence[dict], most: int = 40) -> dict:
    rows = sorted(profiles, key=lambda r: (-r["missing"] / max(1, r["n"]), r["column"]))[:most]
    return {"columns": [r["column"] for r in rows], "rates": [r["missing"] / max(1, r["n"]) for r in rows]}


def missing_strings(df, columns: Sequence[str], order: str, most: int = 10_000) -> dict[str, str]:
    """Each column's missing cells in order, as 0 and 1. A drawing has at most `most` places: of a longer table each place
    stands for equally many neighbouring rows, and is 1 if more than half of them are missing."""
    from pyspark.sql import functions as F

    from ..functions import exprs as E

    from ..operators.windows import ordered

    rows = df.count()
    width = max(1, -(-rows // most))
    place = F.floor((F.col("_seq") - 1) / width)
    shares = ordered(df.select(E.c(order), *(E.c(c).isNull().cast("int").alias(f"_b{k}") for k, c in enumerate(columns))), order).groupBy(place.alias("_at")).agg(*(F.avg(f"_b{k}").alias(f"_b{k}") for k in range(len(columns)))).orderBy("_at").collect()
    return {c: "".join("1" if r[f"_b{k}"] > 0.5 else "0" for r in shares) for k, c in enumerate(columns)}
