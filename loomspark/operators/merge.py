"""Sites into one batch table, and what there is to check about it."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E

SITE = "Site Merged"


def union_sites(sites: dict[str, DataFrame]) -> DataFrame:
    """All rows by column name, columns that a site lacks null, with the site's name. A column that has different types is
    text in all."""
    types: dict[str, set[str]] = {}
    for df in sites.values():
        for n, t in df.dtypes:
            types.setdefault(n, set()).add(t)
    mixed = {n for n, ts in types.items() if len(ts) > 1}
    out = None
    for name, df in sites.items():
        part = df.select(*((E.c(n).cast("string").alias(n)) if n in mixed else E.c(n) for n in df.columns)).withColumn(SITE, F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def never_recorded(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """df without those of the columns that are null in every row: one aggregate."""
    asked = [c for c in columns if c in df.columns]
    if not asked:
        return df, []
    found = df.agg(*(F.count(E.c(c)).alias(f"n{k}") for k, c in enumerate(asked))).first()
    empty = [c for k, c in enumerate(asked) if not found[k]]
    return df.drop(*empty), empty


def renamed(columns: Sequence[str], mapping: dict[str, str]) -> list[str]:
    """New names: the first column by position keeps a mapped name, later ones get _1, _2 and so on, skipping those taken.

    Columns that aren't mapped keep theirs, and a mapped name yields to them.
    """
    taken = {c for c in columns if c not in mapping}
    out = []
    for c in columns:
        name = mapping.get(c, c)
        if c in mapping:
            k, base = 0, name
            while name in taken:
                k += 1
                name = f"{base}_{k}"
            taken.add(name)
        out.append(name)
    return out


def mapping_of(table: DataFrame, source: str, target: str, exclude: Sequence[str] = ()) -> dict[str, str]:
    """Names by name, blank ones dropped; a source with two targets is refused. The table has a row for each column."""
    rows = table.select(E.key_text(source).alias("s"), E.key_text(target).alias("t")).where("s is not null and t is not null").where(~F.col("s").isin(*exclude) if exclude else F.lit(True)).distinct()
    twice = [r["s"] for r in rows.groupBy("s").count().where("count > 1").orderBy("s").limit(10).collect()]
    if twice:
        raise ValueError(f"name mapping: different targets for {', '.join(twice)}")
    return {r["s"]: r["t"] for r in rows.collect()}


def normalised(name: str) -> str:
    return re.sub(r"\s+", " ", name).strip().lower()


_WRAPPED = re.compile(r"^[^\[\]]+\[(.+)\]$")


def unwrapped(name: str) -> str:
    """x for Query[x]."""
    found = _WRAPPED.match(name.strip())
    return found[1] if found else name


def new_parameters(catalog: Sequence[str], sources: dict[str, Sequence[str]], mapping: dict[str, str] | None = None) -> dict[str, list[str]]:
    """By source, its columns that the catalog lacks, by case- and space-blind name, mapped or as it is."""
    known, mapping = {normalised(c) for c in catalog}, mapping or {}
    return {s: sorted({unwrapped(c) for c in columns if normalised(unwrapped(c)) not in known and normalised(mapping.get(unwrapped(c), unwrapped(c))) not in known}) for s, columns in sources.items()}


@dataclass
class Checks:
    rows: int = 0
    rows_by_site: dict[str, int] = field(default_factory=dict)
    not_in_data: list[str] = field(default_factory=list)
    not_in_catalog: list[str] = field(default_factory=list)
    empty: list[str] = field(default_factory=list)
    duplicate_ids: list[str] = field(default_factory=list)


def checks(df: DataFrame, catalog: Sequence[str], id_column: str | None = None) -> Checks:
    """Counts of rows by site, names on one side only, and ids that occur twice."""
    by = {r[0]: r[1] for r in df.groupBy(SITE).count().collect()} if SITE in df.columns else {}
    twice = []
    if id_column and id_column in df.columns:
        twice = [str(r[0]) for r in df.where(E.c(id_column).isNotNull()).groupBy(E.c(id_column)).count().where("count > 1").orderBy(F.desc("count")).limit(20).collect()]
    return Checks(sum(by.values()) or df.count(), by, sorted(set(catalog) - set(df.columns)), sorted(set(df.columns) - set(catalog) - {SITE}), [], twice)
