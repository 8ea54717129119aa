"""Which rows a task is about: declared filters with a funnel, the target, exclusions and grouping units."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..sources.shared import written
from .components import components

OPERATORS = ("equals", "not_equals", "in", "not_in", "min", "max", "is_null", "not_null")


@dataclass(frozen=True)
class Filter:
    """missing: what happens to a row whose cell is empty, include or exclude. normalise: compare as status texts."""

    column: str
    op: str
    value: object = None
    missing: str = "exclude"
    normalise: bool = False
    label: str = ""


def matches(f: Filter, kind: str = "string", aliases: dict[str, str] | None = None) -> Column:
    """Two-valued: an empty cell has the filter's policy."""
    x = E.c(f.column)
    if f.op in ("is_null", "not_null"):
        return x.isNull() if f.op == "is_null" else x.isNotNull()
    plain = (lambda v: E.status(F.lit(str(v)), aliases)) if f.normalise else (lambda v: F.lit(str(v)))
    text = E.status(x, aliases) if f.normalise else x.cast("string")
    if f.op in ("equals", "not_equals"):
        found = text == plain(f.value) if kind == "string" or isinstance(f.value, str) else x == F.lit(f.value)
        found = ~found if f.op == "not_equals" else found
    elif f.op in ("in", "not_in"):
        found = text.isin([plain(v) for v in f.value]) if kind == "string" or any(isinstance(v, str) for v in f.value) else x.isin(list(f.value))
        found = ~found if f.op == "not_in" else found
    elif f.op in ("min", "max"):
        if isinstance(f.value, (int, float)):
            y, bound = E.as_double(x, kind), F.lit(float(f.value))
        else:
            y, bound = (x if kind.startswith(("timestamp", "date")) else E.moment(x)), F.lit(str(f.value)).cast("timestamp")
        found = y >= bound if f.op == "min" else y <= bound
    else:
        raise ValueError(f"filter on {f.column}: operator {f.op!r} is none of {', '.join(OPERATORS)}")
    return F.coalesce(F.when(x.isNotNull(), found), F.lit(f.missing == "include"))


def date_window(column: str, start: date | None, end: date | None, kind: str = "timestamp") -> Column:
    """From start to end; a time later on the end day is outside: the bound is its midnight."""
    t = E.c(column) if kind.startswith(("timestamp", "date")) else E.moment(column)
    found = F.lit(True)
    if start:
        found = found & (t >= F.lit(str(start)).cast("timestamp"))
    if end:
        found = found & (t <= F.lit(str(end)).cast("timestamp"))
    return F.coalesce(found, F.lit(False))


@dataclass
class Step:
    label: str
    before: int
    removed: int

    @property
    def left(self) -> int:
        return self.before - self.removed


REASON = "_excluded_by"


def with_reason(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """df with the first step, by number from 0, that a row fails; null for rows of the cohort."""
    reason = F.lit(None).cast("int")
    for k in reversed(range(len(steps))):
        reason = F.when(~steps[k][1], k).otherwise(reason)
    return df.withColumn(REASON, reason)


def funnel(marked: DataFrame, steps: Sequence[tuple[str, Column]]) -> list[Step]:
    """Each step's rows before and removed, from one aggregate over the reasons."""
    counts = {r[0]: r[1] for r in marked.groupBy(REASON).count().collect()}
    left, out = sum(counts.values()), []
    for k, (label, _) in enumerate(steps):
        out.append(Step(label, left, counts.get(k, 0)))
        left -= counts.get(k, 0)
    return out


def select(df: DataFrame, filters: Sequence[Filter], window: tuple[str, date | None, date | None] | None = None, aliases: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame, list[Step]]:
    """(cohort, excluded rows with their reason, funnel)."""
    kinds = dict(df.dtypes)
    absent = [f.column for f in filters if f.column not in kinds] + ([window[0]] if window and window[0] not in kinds else [])
    if absent:
        raise ValueError(f"cohort filters on columns that aren't there: {', '.join(absent)}")
    steps = [(f.label or f"{f.column} {f.op} {f.value}", matches(f, kinds[f.column], aliases)) for f in filters]
    if window:
        steps.append((f"{window[0]} from {window[1]} to {window[2]}", date_window(*window, kinds[window[0]])))
    marked = with_reason(df, steps)
    labels = F.array(*(F.lit(s) for s, _ in steps)) if steps else F.array(F.lit(""))
    excluded = marked.where(F.col(REASON).isNotNull()).withColumn(REASON, labels[F.col(REASON)])
    return marked.where(F.col(REASON).isNull()).drop(REASON), excluded, funnel(marked, steps)


def unique_ids(df: DataFrame, id_column: str) -> None:
    twice = [str(r[0]) for r in df.where(E.c(id_column).isNotNull()).groupBy(E.c(id_column)).count().where("count > 1").orderBy(F.desc("count"), E.c(id_column)).limit(5).collect()]
    if twice:
        raise ValueError(f"{id_column} isn't unique: {', '.join(twice)}")


def only_site(df: DataFrame, site_column: str, site: str) -> None:
    found = [r[0] for r in df.select(E.c(site_column)).distinct().limit(3).collect()]
    if found != [site]:
        raise ValueError(f"the batch table must hold {site} alone, it has {', '.join(map(str, found))}")


# --- targets -------------------------------------------------------------------------------------------------------

TARGET = "_target"


def numeric_target(df: DataFrame, column: str) -> Column:
    return E.as_double(E.c(column), dict(df.dtypes)[column])


def binary_target(column: str, positive: Sequence[str], negative: Sequence[str] = (), aliases: dict[str, str] | None = None) -> Column:
    """1 and 0; without negatives, whatever else is there is 0."""
    text = E.status(column, aliases)
    said = lambda vs: text.isin([E.status(F.lit(v), aliases) for v in vs])
    return F.when(said(positive), 1.0).when(said(negative) if negative else text.isNotNull(), 0.0)


def period_target(df: DataFrame, column: str, periods: Sequence[tuple[str, date, date]], positive: str) -> Column:
    """1 in a period of the positive label, 0 in another's, null outside; the last day counts whole."""
    t = E.c(column) if dict(df.dtypes)[column].startswith(("timestamp", "date")) else E.moment(column)
    out = F.lit(None).cast("double")
    for label, start, end in periods:
        out = F.when((t >= F.lit(str(start)).cast("timestamp")) & (t < F.lit(str(end + timedelta(days=1))).cast("timestamp")), float(label == positive)).otherwise(out)
    return out


@dataclass
class TargetReport:
    rows: int = 0
    missing: int = 0
    unreadable: int = 0
    classes: dict[str, int] = field(default_factory=dict)


def with_target(df: DataFrame, target: Column, source: str, binary: bool = False) -> tuple[DataFrame, TargetReport]:
    """Rows that have a target, as _target; a binary one must have both classes."""
    marked = df.withColumn(TARGET, target)
    counted = marked.agg(F.count(F.lit(1)), F.count_if(E.c(source).isNull()), F.count_if(E.c(source).isNotNull() & F.col(TARGET).isNull()), F.count_if(F.col(TARGET) == 1), F.count_if(F.col(TARGET) == 0)).first()
    report = TargetReport(*counted[:3], {"1": counted[3], "0": counted[4]} if binary else {})
    if binary and 0 in (counted[3], counted[4]):
        raise ValueError(f"target {source}: needs two classes, has {counted[3]} positive and {counted[4]} negative rows")
    return marked.where(F.col(TARGET).isNotNull()), report


# --- grouping units ------------------------------------------------------------------------------------------------


def grouping_units(df: DataFrame, group: str | None, patient: str | None) -> DataFrame:
    """df with _unit: rows of one group or one patient, however linked, share it. Null groups are one group, "(missing)";
    a null patient links nothing. The label is the names of the unit's groups, joined by "+".

    Distinct (group, patient) pairs are links, whose components are found in a number of rounds that grows with the
    logarithm of the longest chain.
    """
    g = F.coalesce(E.key_text(group), F.lit("(missing)")) if group else F.lit("(all)")
    if not patient:
        return df.withColumn("_unit", g)
    pairs = written(df.select(g.alias("g"), E.key_text(patient).alias("p")).distinct(), "units")
    roots = components(pairs.where("p is not null").select(F.concat(F.lit("g"), "g").alias("u"), F.concat(F.lit("p"), "p").alias("v")))
    of = roots.where(F.startswith("node", F.lit("g"))).select(F.substring("node", 2, 1 << 30).alias("g"), "root")
    labels = pairs.select("g").distinct().join(of, "g", "left").select("g", F.coalesce("root", F.concat(F.lit("g"), "g")).alias("root"))
    names = labels.groupBy("root").agg(F.array_join(F.array_sort(F.collect_set("g")), "+").alias("_unit"))
    named = labels.join(names, "root").select("g", "_unit")
    return df.withColumn("_g", g).join(named.withColumnRenamed("g", "_g"), "_g", "left").drop("_g")


# --- predictors ----------------------------------------------------------------------------------------------------


def predictors(columns: Sequence[str], catalog: Sequence[dict], *, roles: Sequence[str] = (), target: str = "", excluded: Sequence[str] = (), categories: dict[str, tuple[Sequence[str], Sequence[str]]] | None = None, screened: dict[str, str] | None = None, leaking: Sequence[str] = (), site_relative: Sequence[str] = (), include: Sequence[str] | None = None) -> tuple[list[str], list[dict]]:
    """(predictors, why each other column isn't one). The first reason that holds is the one that is given.

    categories: catalog column -> (values to include, values to exclude); a catalog column that isn't there is refused.
    """
    by = {r["Parameter"]: r for r in catalog}
    for name in categories or {}:
        if catalog and name not in catalog[0]:
            raise ValueError(f"the catalog has no column {name}")
    chosen, left_out = [], []
    for c in columns:
        reason = stage = ""
        if c in roles:
            reason, stage = "has a role", "role"
        elif c == target:
            reason, stage = "is the target", "target"
        elif c in excluded:
            reason, stage = "excluded by the task", "task"
        else:
            for name, (yes, no) in (categories or {}).items():
                value = by.get(c, {}).get(name)
                if value in no or yes and value not in yes:
                    reason, stage = f"{name} is {value}", "category"
                    break
            if not reason and screened and c in screened:
                reason, stage = screened[c], "screening"
            elif not reason and c in leaking:
                reason, stage = "is computed from the target", "lineage"
            elif not reason and c in site_relative:
                reason, stage = "is relative to its site", "site"
            elif not reason and include is not None and c not in include:
                reason, stage = "isn't on the task's list", "include"
        if reason:
            left_out.append({"column": c, "stage": stage, "reason": reason})
        else:
            chosen.append(c)
    return chosen, left_out
