"""A task's training table: cohort, target, predictors, recipe, grouping units, raw and encoded columns, and what was decided."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..operators import cohort, decorrelate, derive, encode
from ..sources.readers import Catalog
from . import recipe as R
from .spec import Task


@dataclass
class Dataset:
    raw: DataFrame
    encoded: DataFrame
    recipe: R.Recipe
    funnel: list[cohort.Step]
    excluded: DataFrame
    target: cohort.TargetReport
    predictors: list[str]
    left_out: list[dict]
    columns: list[dict]
    clusters: list[dict]
    notes: list[str] = field(default_factory=list)


def target_column(df: DataFrame, task: Task) -> Column:
    t = task.target
    if t.kind == "numeric":
        return cohort.numeric_target(df, t.column)
    if t.kind == "binary":
        return cohort.binary_target(t.column, t.positive, t.negative, task.aliases)
    return cohort.period_target(df, t.column, t.periods, t.positive[0] if t.positive else t.periods[-1][0])


def sample_notes(df: DataFrame, predictors: int, binary: bool) -> list[str]:
    """Warnings about how many rows there are for how many columns."""
    n, units, positive = df.agg(F.count(F.lit(1)), F.count_distinct("_unit"), F.count_if(F.col(cohort.TARGET) == 1)).first()
    out = []
    if n < 50:
        out.append(f"{n} rows: estimates will be rough")
    if predictors > n:
        out.append(f"{predictors} columns for {n} rows")
    if units < 5:
        out.append(f"{units} grouping units: too few to validate by group")
    if binary and min(positive, n - positive) < 10 * max(1, predictors) / 10:
        out.append(f"{min(positive, n - positive)} rows of the rarer class for {predictors} columns")
    return out


def unit_of(name: str) -> str:
    """What stands in brackets at the end of a column's name."""
    return name[name.rindex("(") + 1 : -1] if name.endswith(")") and "(" in name else ""


def column_table(predictors: Sequence[str], r: R.Recipe, catalog: Catalog | None, df: DataFrame) -> list[dict]:
    """A row for each predictor: type, encoder, outputs, what happened to it, and how full it is."""
    if not predictors:
        return []
    found = df.agg(F.count(F.lit(1)).alias("n"), *(F.count(E.c(c)).alias(f"c{k}") for k, c in enumerate(predictors))).first()
    of = {e["column"]: e for e in r.encoders}
    gone = {d["column"]: d for d in r.dropped}
    types = catalog.types() if catalog else {}
    return [{"parameter": c, "value_type": types.get(c, r.inputs[c]), "unit": unit_of(c), "present_pct": round(100 * found[f"c{k}"] / found["n"], 1) if found["n"] else 0.0, "encoder": of[c]["encoder"] if c in of else "number" if c in r.numeric else "", "outputs": "; ".join(of[c]["output"]) if c in of else c if c in r.output else "", "dropped": gone[c]["reason"] if c in gone else ""} for k, c in enumerate(predictors)]


def explanation_groups(r: R.Recipe, least_stability: float = 0.5) -> dict[str, list[str]]:
    """Output columns that are explained together: an encoder's outputs, a stable cluster's members."""
    out = {e["column"]: e["output"] for e in r.encoders if len(e["output"]) > 1}
    for c in r.clusters.get("clusters", []):
        members = [m for m in c["members"] if m in r.output]
        if c["stability"] >= least_stability and len(members) > 1:
            out[c["name"]] = members
    return out


def build(df: DataFrame, task: Task, catalog: Catalog | None = None, screened: dict[str, str] | None = None, features: Sequence[derive.Feature] = ()) -> Dataset:
    window = (task.date_column, task.date_from, task.date_to) if task.date_column else None
    chosen, excluded, funnel = cohort.select(df, task.filters, window, task.aliases)
    rows, report = cohort.with_target(chosen, target_column(chosen, task), task.target.column, task.target.kind != "numeric")
    if task.id_column:
        cohort.unique_ids(rows, task.id_column)
    parents = derive.lineage(features) if features else {}
    leaking = derive.descendants(task.target.column, parents, rows.columns)
    roles = [c for c in (task.id_column, task.group_column, task.patient_column, task.date_column) if c]
    names = [c for c in df.columns if c not in (cohort.TARGET, "Site Merged")]
    predictors, left_out = cohort.predictors(names, catalog.rows if catalog else [], roles=roles, target=task.target.column, excluded=list(task.exclude), categories=task.categories, screened=screened, leaking=sorted(leaking), site_relative=[f.name or f.key for f in features if f.site_relative], include=task.include)
    rows = cohort.grouping_units(rows, task.group_column or None, task.patient_column or None).persist()
    orders = {c: o for c, o in (catalog.orders() if catalog else {}).items() if c in predictors}
    fitted = R.fit(rows, predictors, task.options, orders)
    keep = [c for c in (task.id_column, task.group_column, task.patient_column) if c]
    folded = encode.folds(rows, task.options.encode.folds, task.seed, groups="_unit" if task.group_column or task.patient_column else None, id_column=task.id_column or None)
    encoded = R.crossfit_transform(fitted, folded, [*keep, "_unit", "_fold", cohort.TARGET], "_fold", task.options.encode.smoothing)
    raw = rows.select(*(E.c(c) for c in (*keep, "_unit", *predictors)), E.c(cohort.TARGET))
    notes = fitted.notes + sample_notes(rows, len(fitted.output), task.target.kind != "numeric")
    membership = decorrelate.membership(decorrelate.Fitted(**fitted.clusters), [c for c in fitted.numeric], fitted.output) if fitted.clusters else []
    return Dataset(raw, encoded, fitted, funnel, excluded, report, predictors, left_out, column_table(predictors, fitted, catalog, rows), membership, notes)


def consistent(d: Dataset) -> list[str]:
    """What doesn't agree between the parts of a dataset."""
    raw, encoded = d.raw.count(), d.encoded.count()
    out = []
    if raw != encoded:
        out.append(f"{raw} raw rows, {encoded} encoded rows")
    if d.funnel and d.funnel[-1].left != d.target.rows:
        out.append(f"the funnel leaves {d.funnel[-1].left} rows, the target saw {d.target.rows}")
    if raw != d.target.rows - d.target.missing - d.target.unreadable:
        out.append(f"{raw} rows have a target, {d.target.rows - d.target.missing - d.target.unreadable} should")
    missing = [c for c in d.recipe.output if c not in d.encoded.columns]
    return out + ([f"columns that weren't made: {', '.join(missing)}"] if missing else [])
