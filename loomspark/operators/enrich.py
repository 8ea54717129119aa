"""Joins that bring in columns from look-up tables: left, many to one, and refused where the look-up contradicts itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..sources.shared import written


class AmbiguousLookup(ValueError):
    """A key has two different records."""


def find_key(df: DataFrame, candidates: Sequence[str], what: str) -> str:
    """The first candidate that is a column."""
    found = next((c for c in candidates if c in df.columns), None)
    if found is None:
        raise ValueError(f"{what}: none of {', '.join(candidates)} is a column")
    return found


_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _key(df: DataFrame, column: str, whole: bool) -> Column:
    return E.c(column).cast("bigint") if whole else E.key_text(column)


def unique_lookup(lookup: DataFrame, key: str, what: str, check: bool = True, whole: bool = False) -> DataFrame:
    """Rows with a key, as trimmed text (whole: as a whole number), identical ones once. Two different records of a key
    are refused: one aggregate, over the look-up as it is written for the join."""
    rows = lookup.withColumn(key, _key(lookup, key, whole)).where(E.c(key).isNotNull()).dropDuplicates()
    if check:
        rows = written(rows, "lookup")
        twice = [r[0] for r in rows.groupBy(E.c(key).alias("key")).count().where("count > 1").orderBy("key").limit(5).collect()]
        if twice:
            raise AmbiguousLookup(f"{what}: different records for {', '.join(map(str, twice))}")
    return rows


def lookup_join(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str | None = None, what: str = "lookup", check: bool = True, columns: Sequence[str] | None = None, prefix: str = "") -> DataFrame:
    """df with the look-up's columns: same rows, nulls where the key isn't found; a null key finds nothing.

    Columns that df has already stay df's. Whether the look-up is broadcast is left to its measured size. Keys that are
    whole numbers on both sides are compared as such, others as trimmed text. Rows with a null key are spread over all
    tasks of a shuffle instead of meeting in one.
    """
    other = lookup_key or key
    whole = dict(df.dtypes)[key] in _WHOLE and dict(lookup.dtypes)[other] in _WHOLE
    if columns is not None:
        lookup = lookup.select(*(E.c(c) for c in dict.fromkeys((other, *columns)) if c in lookup.columns))
    rows = unique_lookup(lookup, other, what, check, whole)
    chosen = [c for c in (columns if columns is not None else rows.columns) if c != other and c in rows.columns and prefix + c not in df.columns]
    # Not a literal, which the optimiser would take out of the join's keys.
    right = rows.select(E.c(other).alias("_lookup_key"), F.when(E.c(other).isNotNull(), 0).alias("_lookup_spread"), *(E.c(c).alias(prefix + c) for c in chosen))
    k = _key(df, key, whole)
    left = df.select("*", k.alias("_own_key"), F.when(k.isNull(), F.pmod(F.xxhash64(*map(E.c, df.columns)), F.lit(4096)).cast("int")).otherwise(0).alias("_own_spread"))
    return left.join(right, (F.col("_own_key") == F.col("_lookup_key")) & (F.col("_own_spread") == F.col("_lookup_spread")), "left").drop("_own_key", "_own_spread", "_lookup_key", "_lookup_spread")


def coverage(df: DataFrame, witness: str) -> float:
    """Per cent of rows in which a joined column is there, to one decimal."""
    n, there = df.agg(F.count(F.lit(1)), F.count(E.c(witness))).first()
    return round(100 * there / n, 1) if n else 0.0


def unused(lookup: DataFrame, used: DataFrame, key: str, used_key: str | None = None) -> DataFrame:
    """Look-up rows whose key no row uses, in the order of the key."""
    keys = used.select(E.key_text(used_key or key).alias("_used")).where("_used is not null").distinct()
    return lookup.join(keys, E.key_text(key) == F.col("_used"), "left_anti").orderBy(E.c(key))


def last_wins(mappings: Sequence[DataFrame], key: str, value: str, order: str | None = None) -> DataFrame:
    """(key, value) of several mappings of one shape: upper-cased keys, later mappings and rows win."""
    rows = None
    for k, m in enumerate(mappings):
        at = E.c(order) if order else F.monotonically_increasing_id()
        part = m.select(F.upper(E.key_text(key)).alias("key"), E.key_text(value).alias("value"), F.struct(F.lit(k).alias("file"), at.alias("row")).alias("at")).where("key is not null and value is not null")
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("key").agg(F.max_by("value", "at").alias("value"))


def expand(df: DataFrame, column: str, mapping: DataFrame, code: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """df with the codes of column replaced by their names, and the codes without one. Codes that aren't mapped stay;
    null ones aren't listed."""
    coded = df.withColumn("_code", F.upper(F.trim((code if code is not None else E.c(column)).cast("string"))))
    joined = coded.join(mapping.withColumnRenamed("key", "_code"), "_code", "left")
    out = joined.withColumn(column, F.coalesce("value", "_code")).select(*map(E.c, df.columns))
    return out, coded.where("_code is not null").select("_code").distinct().join(mapping, F.col("_code") == F.col("key"), "left_anti")


def site_of_patient(x: Column, prefix: str) -> Column:
    """The second part of an id that starts with the prefix (P-NOR-12), else the whole."""
    text = x.cast("string")
    return F.when(F.startswith(text, F.lit(prefix)), F.split_part(text, F.lit("-"), F.lit(2))).otherwise(text)


def harmonised(df: DataFrame, column: str, pairs: dict[str, str], where: Column | None = None) -> DataFrame:
    """Exact values replaced, in some rows only if `where` is given."""
    new = F.coalesce(E.mapped(E.c(column), pairs), E.c(column))
    return df.withColumn(column, F.when(where, new).otherwise(E.c(column)) if where is not None else new)


def groups_of(members: DataFrame, parameter: str = "parameter", group: str = "group") -> DataFrame:
    """Each parameter with the names of its groups, joined by "; "."""
    return members.groupBy(parameter).agg(F.array_join(F.array_sort(F.collect_set(group)), "; ").alias("groups"))


# --- certificates --------------------------------------------------------------------------------------------------


def certificates(raw: DataFrame, key: str, available: tuple[str, str] | None = None, limits: Sequence[str] = (), policy: str = "limit", ph_nominal: float | None = None, osmolality_nominal: float | None = None, donors: dict[str, Sequence[str]] | None = None, names: dict[str, str] | None = None) -> DataFrame:
    """Certificate rows as numbers, with what follows from them.

    names gives the columns of titer, titer_raw, volume, p24, dna (comma-joined), ph and osmolality. limits are columns
    that may hold values below the limit of quantification; each gets a flag, and a value by the policy. Made are:
    delivered dose (raw titer, else the adjusted one, times volume) and whether it fell back, titer adjustment, specific
    infectivity, the last DNA's share of all, deviations from nominals that are given, and of each metric's donors the
    greatest, least, difference, relative difference and mean.
    """
    names, donors = names or {}, donors or {}
    df = raw.where(E.c(available[0]) == available[1]) if available else raw
    filled = df.agg(*(F.count(E.c(c)).alias(f"n{k}") for k, c in enumerate(df.columns))).first()
    df = df.select(*(E.c(c) for k, c in enumerate(df.columns) if filled[k]))
    there = lambda k: names.get(k) in df.columns
    dna = [c for c in names.get("dna", "").split(",") if c in df.columns]
    numeric = {c for k, c in names.items() if k != "dna" and c in df.columns} | set(dna) | {c for cs in donors.values() for c in cs if c in df.columns} | {c for c in limits if c in df.columns}
    at_limit = {"limit": lambda x: E.limit_of(x), "half": lambda x: E.limit_of(x) / 2, "missing": lambda x: F.lit(None).cast("double")}[policy]
    columns = {}
    for c in df.columns:
        x = E.c(c)
        if c in limits:
            columns[c] = F.when(E.below_limit(x) == 1, at_limit(x)).otherwise(E.european_number(x))
            columns[f"{c} below LOQ"] = E.below_limit(x)
        else:
            columns[c] = E.european_number(x) if c in numeric and dict(df.dtypes)[c] == "string" else E.key_text(x) if c == key else x
    out = df.select(*(x.alias(n) for n, x in columns.items()))
    made: dict[str, Column] = {}
    n = {k: E.c(c) for k, c in names.items() if k != "dna" and c in out.columns}
    if there("titer") and there("volume"):
        raw_titer = n.get("titer_raw", F.lit(None).cast("double"))
        made["Delivered dose"] = F.coalesce(raw_titer, n["titer"]) * n["volume"]
        made["Delivered dose from adjusted titer"] = (raw_titer.isNull() & n["titer"].isNotNull()).cast("int")
    if there("titer") and there("titer_raw"):
        made["Titer adjustment"] = E.safe_div(n["titer"], n["titer_raw"])
    if there("titer") and there("p24"):
        made["Specific infectivity"] = E.safe_div(n["titer"], n["p24"])
    if len(dna) >= 2:
        made["Last DNA fraction"] = E.safe_div(E.c(dna[-1]), E.row_sum(dna))
    for k, nominal in (("ph", ph_nominal), ("osmolality", osmolality_nominal)):
        if there(k) and nominal is not None:
            made[f"{names[k]} Abs Deviation"] = F.abs(n[k] - nominal)
    for metric, cs in donors.items():
        if cs := [c for c in cs if c in out.columns]:
            high, low = E.row_greatest(cs), E.row_least(cs)
            made |= {f"{metric} MAX": high, f"{metric} MIN": low, f"{metric} DIFF": high - low, f"{metric} DIFF Rel": E.safe_div(high - low, high), f"{metric} AVG": E.row_mean(cs)}
    return out.withColumns(made) if made else out
