"""Cleaning: one site's raw text into typed columns, with an account of what was changed.

The whole of it is one projection; what it did is counted in one aggregate over the raw frame, however many columns
there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E
from . import corrections

VALUE_TYPES = ("numeric", "categorical", "datetime", "duration", "ratio", "boolean")


@dataclass(frozen=True)
class Options:
    censored: str = "limit"
    censored_flags: bool = False
    duration_unit: str = "minutes"
    yes_no_defaults: dict[str, str] = field(default_factory=dict)
    unit_suffixes: dict[str, str] = field(default_factory=dict)
    disabled_rules: tuple[str, ...] = ()


@dataclass
class Report:
    site: str
    cells_stripped: dict[str, int] = field(default_factory=dict)
    unreadable: dict[str, int] = field(default_factory=dict)
    censored: dict[str, int] = field(default_factory=dict)
    out_of_percent: dict[str, int] = field(default_factory=dict)
    filled: dict[str, int] = field(default_factory=dict)
    examples: dict[str, list[str]] = field(default_factory=dict)
    corrections: list[corrections.Outcome] = field(default_factory=list)


def coerced(x: Column, kind: str, options: Options, column: str = "") -> Column:
    """Stripped text as the catalog's value type."""
    if kind == "numeric":
        if suffix := options.unit_suffixes.get(column):
            x = F.regexp_replace(x, r"(?i)\s*" + _literal(suffix) + r"\s*$", "")
        return E.censored_number(x, options.censored)
    if kind == "datetime":
        return E.moment(x)
    if kind == "duration":
        return E.duration_minutes(x, options.duration_unit)
    if kind == "ratio":
        return F.nullif(E.ratio_right(x), F.lit(""))
    return x


def _literal(text: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in text)


def yes_no_literal(df: DataFrame, column: str, default: str) -> str:
    """The default in the column's own spelling: a value that it has, else Y/N where those are used, else as given."""
    spellings = {r[0] for r in df.select(E.c(column)).where(F.lower(E.c(column)).isin("yes", "no", "y", "n")).distinct().limit(16).collect()}
    same = sorted(s for s in spellings if s.lower() == default.lower())
    if same:
        return same[0]
    other = {"yes": "no", "no": "yes", "y": "n", "n": "y"}
    for s in sorted(spellings):
        if s.lower() in ("y", "n"):
            return default[:1].upper() if s.isupper() else default[:1].lower()
        if s.lower() == other.get(default.lower()):
            return default.upper() if s.isupper() else default.lower() if s.islower() else default.capitalize()
    return default


def clean(df: DataFrame, value_types: dict[str, str], site: str = "", options: Options = Options(), rules: Sequence[corrections.Rule] = ()) -> tuple[DataFrame, Report]:
    """Stripped, corrected, coerced, rescaled and filled, in this order.

    value_types maps catalog columns to their types; other columns only lose empty texts. Percentages (a name with "(%")
    outside 0 to 100 are counted and stay.
    """
    report = Report(site)
    raw = df
    text_columns = {n for n, t in df.dtypes if t == "string"}
    stripped = df.select(*((E.strip(E.c(n)) if n in value_types else F.nullif(E.c(n), F.lit(""))).alias(n) if n in text_columns else E.c(n) for n in df.columns))
    fixed, first = corrections.apply(stripped, rules, corrections.INTEGRITY, site, options.disabled_rules)
    text_columns = {n for n, t in fixed.dtypes if t == "string"}
    typed, flags = [], []
    for n in fixed.columns:
        kind = value_types.get(n, "")
        typed.append((coerced(E.c(n), kind, options, n) if n in text_columns and kind else E.c(n)).alias(n))
        if options.censored_flags and kind == "numeric" and n in text_columns:
            flags.append(E.is_censored(E.c(n)).cast("int").alias(f"{n} censored"))
    done, last = corrections.apply(fixed.select(*typed, *flags), rules, corrections.SCALE, site, options.disabled_rules)
    report.corrections = first + last

    # Everything that is counted, in one pass over the corrected text and one over the raw text.
    counts: list[tuple[dict, str, Column]] = []
    for n in fixed.columns:
        kind = value_types.get(n, "")
        x = E.c(n)
        if n not in text_columns or not kind:
            continue
        if kind == "numeric":
            counts.append((report.censored, n, F.count_if(E.is_censored(x))))
        if kind in ("numeric", "datetime", "duration"):
            y = coerced(x, kind, options, n)
            counts.append((report.unreadable, n, F.count_if(x.isNotNull() & y.isNull() & ~(E.is_censored(x) if kind == "numeric" else F.lit(False)))))
    if counts:
        found = fixed.agg(*(c.alias(f"n{k}") for k, (_, _, c) in enumerate(counts))).first()
        for k, (into, n, _) in enumerate(counts):
            if found[k]:
                into[n] = found[k]
    changed = [n for n in df.columns if n in value_types and dict(df.dtypes)[n] == "string"]
    if changed:
        found = raw.agg(*(F.count_if(~E.strip(E.c(n)).eqNullSafe(E.c(n))).alias(f"n{k}") for k, n in enumerate(changed))).first()
        report.cells_stripped = {n: found[k] for k, n in enumerate(changed) if found[k]}
    if report.unreadable:
        bad = list(report.unreadable)
        found = fixed.agg(*(F.slice(F.sort_array(F.collect_set(F.when(coerced(E.c(n), value_types[n], options, n).isNull() & (F.length(E.c(n)) < 80), E.c(n)))), 1, 10).alias(f"n{k}") for k, n in enumerate(bad))).first() if len(bad) else None
        report.examples = {n: list(found[k]) for k, n in enumerate(bad)}
    percents = [n for n, t in done.dtypes if "(%" in n and n in value_types and t == "double"]
    fills = {n: yes_no_literal(done, n, d) for n, d in options.yes_no_defaults.items() if n in done.columns}
    if percents or fills:
        found = done.agg(*(F.count_if((E.c(n) < 0) | (E.c(n) > 100)).alias(f"p{k}") for k, n in enumerate(percents)), *(F.count_if(E.c(n).isNull()).alias(f"f{k}") for k, n in enumerate(fills))).first()
        report.out_of_percent = {n: found[f"p{k}"] for k, n in enumerate(percents) if found[f"p{k}"]}
        report.filled = {n: found[f"f{k}"] for k, n in enumerate(fills)}
    return done.withColumns({n: F.coalesce(E.c(n), F.lit(x)) for n, x in fills.items()}) if fills else done, report


def category_differences(sites: dict[str, DataFrame], columns: Sequence[str]) -> DataFrame | None:
    """(column, value, only_at, not_at): values of a categorical column that one site has and another lacks, all of them.

    Values that differ are counted by one aggregate: what each site has once is united, and a value's sites are gathered
    in an array that is no longer than there are sites. None if no column is in two sites.
    """
    holders = {n: [s for s, df in sites.items() if n in df.columns] for n in columns}
    shared = [n for n in columns if len(holders[n]) > 1]
    if not shared:
        return None
    parts = []
    for s, df in sites.items():
        own = [n for n in shared if n in df.columns]
        if own:
            cells = F.explode(F.array(*(F.struct(F.lit(n).alias("column"), E.c(n).cast("string").alias("value")) for n in own)))
            parts.append(df.select(cells.alias("x")).select("x.*", F.lit(s).alias("site")).where("value is not null"))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    all_of = F.element_at(F.create_map(*(x for n in shared for x in (F.lit(n), F.array(*map(F.lit, holders[n]))))), F.col("column"))
    found = rows.groupBy("column", "value").agg(F.collect_set("site").alias("has")).withColumn("lacks", F.array_except(all_of, "has")).where(F.size("lacks") > 0)
    return found.select("column", "value", F.explode("has").alias("only_at"), "lacks").select("column", "value", "only_at", F.explode("lacks").alias("not_at"))
