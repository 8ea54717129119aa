"""Categorical columns as numbers: routing, five encoders, and target means that don't see their own row's fold.

Fitting is a few aggregates; what was fitted is plain data, and applying it is a projection of built-in functions.
"""

from __future__ import annotations

import ast
import math
import re
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..sources.shared import written
from .windows import ordered, running_total

#: Texts that mark a binary column's positive class.
YES = ("yes", "y", "true")
MISSING = "(missing)"
#: Groups that are dealt out to folds one by one.
LARGE_GROUPS = 1000


@dataclass(frozen=True)
class Knobs:
    identifier_share: float = 0.5
    few: int = 15
    some: int = 50
    rows_per_category: float = 5.0
    least_rows: int = 100
    top: int = 10
    smoothing: float = 10.0
    folds: int = 5
    least_buckets: int = 8
    most_buckets: int = 32
    missing_is_category: bool = False
    one_hot: bool = True
    target_encoding: bool = True
    feature_hashing: bool = True
    target_encoding_fallback: str = "hashing"
    hashing_signed: bool = True
    #: Means of one column that a recipe holds; a column with more categories isn't encoded by target.
    most_means: int = 10_000


def sanitised(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


def unique_name(base: str, taken: set[str]) -> str:
    name, k = base, 1
    while name in taken:
        k += 1
        name = f"{base}__{k}"
    taken.add(name)
    return name


def labels(x: Column, knobs: Knobs = Knobs()) -> Column:
    """The category as trimmed text; an empty cell is null, or a category of its own if so set."""
    text = E.key_text(x)
    return F.coalesce(text, F.lit(MISSING)) if knobs.missing_is_category else text


def route(df: DataFrame, columns: Sequence[str], knobs: Knobs = Knobs()) -> dict[str, tuple[str, str]]:
    """(encoder or skip, why) of each column, from one aggregate of distinct counts."""
    if not columns:
        return {}
    found = df.agg(F.count(F.lit(1)).alias("rows"), *(x for k, c in enumerate(columns) for x in (F.count_distinct(labels(E.c(c), knobs)).alias(f"k{k}"), F.count(labels(E.c(c), knobs)).alias(f"n{k}")))).first()
    out = {}
    for i, c in enumerate(columns):
        k, n = found[f"k{i}"], found[f"n{i}"]
        if k <= 1:
            out[c] = ("skip", "one value at most")
        elif k == 2:
            out[c] = ("binary", "two values")
        elif k / n > knobs.identifier_share:
            out[c] = ("skip", "an identifier: nearly every row has its own value")
        else:
            order = ("one_hot", "target", "hash") if k <= knobs.few else ("target", "hash", "one_hot") if k <= knobs.some else ("hash", "target", "one_hot")
            allowed = {"one_hot": knobs.one_hot, "target": knobs.target_encoding and n / k >= knobs.rows_per_category and k <= knobs.most_means, "hash": knobs.feature_hashing and n >= knobs.least_rows}
            choice = next((e for e in order if allowed[e]), "skip")
            out[c] = (choice, f"{k} values in {n} rows" + ("" if choice != "skip" else ", and no encoder for them"))
    return out


# --- fitting -------------------------------------------------------------------------------------------------------


def category_counts(df: DataFrame, column: str, knobs: Knobs = Knobs()) -> DataFrame:
    return df.select(labels(E.c(column), knobs).alias("category")).where("category is not null").groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def fit_binary(df: DataFrame, column: str, taken: set[str], knobs: Knobs = Knobs()) -> dict:
    values = sorted(r[0] for r in category_counts(df, column, knobs).limit(3).collect())
    if len(values) != 2:
        raise ValueError(f"{column}: {len(values)} values, two are needed")
    positive = next((v for v in values if v.lower() in YES), values[1])
    return {"encoder": "binary", "column": column, "positive": positive, "negative": next(v for v in values if v != positive), "output": [unique_name(f"{sanitised(column)}_is_{sanitised(positive)}", taken)]}


def fit_one_hot(df: DataFrame, column: str, taken: set[str], knobs: Knobs = Knobs()) -> dict:
    """The most frequent categories, ties by name, and one column for the rest."""
    top = [r["category"] for r in category_counts(df, column, knobs).orderBy(F.desc("n"), "category").limit(knobs.top).collect()]
    rest = "Other" if "Other" not in top else "Other (rare)"
    return {"encoder": "one_hot", "column": column, "categories": top, "rest": rest, "output": [unique_name(f"{sanitised(column)}_{sanitised(v)}", taken) for v in (*top, rest)]}


def smoothed(total: Column, n: Column, prior: Column | float, weight: float) -> Column:
    return (total + weight * prior) / (n + weight)


def fit_target(df: DataFrame, column: str, target: str, taken: set[str], knobs: Knobs = Knobs()) -> dict:
    prior = df.agg(F.avg(E.c(target))).first()[0]
    rows = df.select(labels(E.c(column), knobs).alias("category"), E.c(target).alias("y")).where("category is not null and y is not null").groupBy("category").agg(smoothed(F.sum("y"), F.count("y"), F.lit(prior), knobs.smoothing).alias("mean"))
    found = rows.limit(knobs.most_means + 1).collect()
    if len(found) > knobs.most_means:
        raise ValueError(f"{column}: over {knobs.most_means} categories; hash them instead")
    return {"encoder": "target", "column": column, "prior": prior, "means": {r["category"]: r["mean"] for r in found}, "output": [unique_name(f"{sanitised(column)}_target_mean", taken)]}


def fit_hashed(df: DataFrame, column: str, taken: set[str], knobs: Knobs = Knobs()) -> dict:
    k = df.agg(F.count_distinct(labels(E.c(column), knobs))).first()[0]
    width = min(max(2 ** math.ceil(math.log2(max(k, 1))), knobs.least_buckets), knobs.most_buckets)
    return {"encoder": "hash", "column": column, "buckets": width, "signed": knobs.hashing_signed, "output": [unique_name(f"{sanitised(column)}_hash_{b}", taken) for b in range(width)]}


def parsed_order(value: str) -> list[str] | None:
    """The items of a bracketed list in the catalog: a literal list, else split at commas."""
    text = (value or "").strip()
    if not (text.startswith("[") and text.endswith("]")):
        return None
    try:
        items = ast.literal_eval(text)
        items = [str(x).strip() for x in items]
    except (ValueError, SyntaxError):
        items = [x.strip().strip("'\"") for x in text[1:-1].split(",")]
    return [x for x in items if x] or None


def fit_ordinal(column: str, order: Sequence[str], taken: set[str]) -> dict:
    return {"encoder": "ordinal", "column": column, "order": list(order), "output": [unique_name(f"{sanitised(column)}_rank", taken)]}


# --- applying ------------------------------------------------------------------------------------------------------


def applied(state: dict, knobs: Knobs = Knobs()) -> dict[str, Column]:
    """The output columns of one fitted encoder; a missing category is missing in all of them."""
    x, out, kind = labels(E.c(state["column"]), knobs), state["output"], state["encoder"]
    if kind == "binary":
        return {out[0]: F.when(x == state["positive"], 1).when(x == state["negative"], 0)}
    if kind == "one_hot":
        known = state["categories"]
        cells = {n: F.when(x.isNotNull(), (x == v).cast("int")) for n, v in zip(out, known)}
        return cells | {out[-1]: F.when(x.isNotNull(), (~x.isin(known)).cast("int")) if known else F.when(x.isNotNull(), 1)}
    if kind == "target":
        means = state["means"]
        found = F.element_at(F.create_map(*(F.lit(v) for kv in means.items() for v in kv)), x) if means else F.lit(None).cast("double")
        return {out[0]: F.when(x.isNotNull(), F.coalesce(found, F.lit(state["prior"])))}
    if kind == "hash":
        bucket, sign = E.bucket_and_sign(state["column"], x, state["buckets"])
        cell = sign if state.get("signed", True) else F.lit(1)
        # No branches: what all outputs share is then computed once. A missing category has no digest.
        return {n: (bucket == b).cast("int") * cell for b, n in enumerate(out)}
    if kind == "ordinal":
        return {out[0]: F.nullif(F.array_position(F.array(*map(F.lit, state["order"])), x), F.lit(0)).cast("int")}
    raise ValueError(f"unknown encoder {kind!r}")


# --- folds ---------------------------------------------------------------------------------------------------------


def folds(df: DataFrame, k: int, seed: int = 0, groups: str | None = None, order: str | None = None, id_column: str | None = None, name: str = "_fold") -> DataFrame:
    """df with a fold of 0 to k - 1.

    groups: whole groups go to one fold. The LARGE_GROUPS largest go, the largest first, to the fold with the fewest rows;
    no other group has more than a LARGE_GROUPS-th of all rows, and those fill what room the folds have left, in the
    order of a hash. order: blocks of equal size by rank, earliest first. Else by a hash of the id and the seed, so that
    a row's fold doesn't depend on the other rows.
    """
    if order:
        n = df.count()
        return ordered(df, order, id_column).withColumn(name, F.least(F.floor((F.col("_seq") - 1) * k / max(1, n)), F.lit(k - 1)).cast("int")).drop("_seq")
    if groups:
        key = F.coalesce(E.c(groups).cast("string"), F.lit(MISSING))
        sizes = written(df.groupBy(key.alias("_g")).agg(F.count(F.lit(1)).alias("_n")), "fold-groups")
        rows = sizes.agg(F.sum("_n")).first()[0] or 0
        load, of = [0] * k, {}
        for r in sizes.orderBy(F.desc("_n"), "_g").limit(LARGE_GROUPS).collect():
            at = load.index(min(load))
            of[r["_g"]] = at
            load[at] += r["_n"]
        table = df.sparkSession.createDataFrame(list(of.items()), f"_g string, {name} int")
        rest = sizes.join(F.broadcast(table.select("_g")), "_g", "left_anti")
        # Each fold takes what brings it to an equal share, on a line of all rows that are left.
        room = [max(0.0, rows / k - x) for x in load]
        left = max(1, rows - sum(load))
        edges = [left * x / (sum(room) or 1) for x in accumulate(room)]
        placed = running_total(rest.withColumn("_order", F.struct(F.xxhash64("_g", F.lit(seed)).alias("h"), F.col("_g").alias("g"))), "_order", "_n", "_before")
        fold = F.lit(k - 1)
        for f in reversed(range(k - 1)):
            fold = F.when(F.col("_before") < edges[f], f).otherwise(fold)
        dealt = table.union(placed.select("_g", fold.cast("int").alias(name)))
        return df.withColumn("_g", key).join(dealt, "_g", "left").drop("_g")
    key = E.c(id_column) if id_column else F.monotonically_increasing_id()
    return df.withColumn(name, F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(k)).cast("int"))


def crossfitted(df: DataFrame, column: str, target: str, fold: str, output: str, weight: float = 10.0, chronological: bool = False, knobs: Knobs = Knobs()) -> DataFrame:
    """df with target means from the other folds (chronological: from earlier ones only; the first fold has none).

    Totals by category and fold are aggregated once; what a fold may see is the whole less its own, so no fold is fitted
    anew. Both the mean and the prior leave the fold out.
    """
    rows = df.withColumn("_category", labels(E.c(column), knobs))
    parts = rows.where(E.c(target).isNotNull()).groupBy("_category", E.c(fold).alias("_f")).agg(F.sum(E.c(target)).alias("_s"), F.count(E.c(target)).alias("_n"))
    by_fold = parts.groupBy("_f").agg(F.sum("_s").alias("_fs"), F.sum("_n").alias("_fn"))
    # One row for each fold.
    seen_by = W.orderBy("_f").rowsBetween(W.unboundedPreceding, -1) if chronological else W.partitionBy(F.lit(0))
    own = (F.lit(0), F.lit(0)) if chronological else (F.col("_fs"), F.col("_fn"))
    priors = by_fold.select("_f", F.try_divide(F.sum("_fs").over(seen_by) - own[0], F.sum("_fn").over(seen_by) - own[1]).alias("_prior"))
    known = parts.where("_category is not null")
    if chronological:
        each = known.select(F.col("_category"), F.col("_f").alias("_g"), "_s", "_n")
        seen = known.select("_category", "_f").join(each, "_category").groupBy("_category", "_f").agg(F.sum(F.when(F.col("_g") < F.col("_f"), F.col("_s")).otherwise(0)).alias("_os"), F.sum(F.when(F.col("_g") < F.col("_f"), F.col("_n")).otherwise(0)).alias("_on"))
    else:
        whole = known.groupBy("_category").agg(F.sum("_s").alias("_ts"), F.sum("_n").alias("_tn"))
        seen = known.join(whole, "_category").select("_category", "_f", (F.col("_ts") - F.col("_s")).alias("_os"), (F.col("_tn") - F.col("_n")).alias("_on"))
    means = rows.withColumn("_f", E.c(fold)).join(F.broadcast(priors), "_f", "left").join(seen, ["_category", "_f"], "left")
    n = F.coalesce("_on", F.lit(0))
    value = F.when(F.col("_category").isNotNull(), F.when(n > 0, smoothed(F.col("_os"), n, F.col("_prior"), weight)).otherwise(F.col("_prior")))
    return means.select(*map(E.c, df.columns), value.alias(output))


# --- numbers -------------------------------------------------------------------------------------------------------


def near_constant(df: DataFrame, columns: Sequence[str], tolerance: float = 1e-4) -> list[str]:
    """Columns with fewer than two values at nine decimals, or with a spread within tolerance of their size."""
    if not columns:
        return []
    found = df.agg(*(x for k, c in enumerate(columns) for x in (F.count(E.c(c)).alias(f"d{k}"), (F.max(F.round(E.c(c), 9)) == F.min(F.round(E.c(c), 9))).alias(f"e{k}"), F.stddev(E.c(c)).alias(f"s{k}"), F.avg(F.abs(E.c(c))).alias(f"a{k}")))).first()
    return [c for k, c in enumerate(columns) if not found[f"d{k}"] or found[f"e{k}"] or found[f"s{k}"] is None or found[f"s{k}"] <= tolerance * found[f"a{k}"]]


def numeric(x: Column, kind: str, positive: bool = False) -> Column:
    """As double without infinities; positive: nothing at or below zero."""
    y = E.as_double(x, kind)
    return F.when(y > 0, y) if positive else y
