"""How parameters go missing: alone over time, and together."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..functions import stats
from .similarity import jaccard_of_missing
from .windows import ordered

#: Bounds of the runs test, two-sided at one per cent; a single long gap has this share of all that is missing.
CRITICAL, ONE_GAP = 2.576, 0.8


def profiles(df: DataFrame, columns: Sequence[str], order: str, tie: str | None = None) -> DataFrame:
    """One row per column: n, missing, runs of missing, leading, trailing, longest, z of the runs test, pattern, share of
    missing that follow missing (all, and in the last ten), first and last measured order.

    Runs are found by numbering rows once and taking differences within a column; a run is the rows whose place less
    their rank among missing ones is the same.
    """
    rows = ordered(df.select(E.c(order).alias("_at"), *(F.lit(0).alias("_t") if tie is None else E.c(tie).alias("_t") for _ in (0,)), *(E.c(c).isNull().alias(c) for c in columns)), "_at", None if tie is None else "_t")
    long = rows.select("_seq", "_at", F.explode(F.array(*(F.struct(F.lit(c).alias("column"), E.c(c).alias("gone")) for c in columns))).alias("x")).select("_seq", "_at", "x.*")
    whole = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("gone").alias("missing"), F.min(F.when(~F.col("gone"), F.col("_seq"))).alias("first"), F.max(F.when(~F.col("gone"), F.col("_seq"))).alias("last"),
        F.min_by("_at", F.when(~F.col("gone"), F.col("_seq"))).alias("first_measured"), F.max_by("_at", F.when(~F.col("gone"), F.col("_seq"))).alias("last_measured"),
    )
    # A missing row begins a run if the row before it isn't missing: rows meet their predecessor by number.
    gone = long.where("gone").select("column", "_seq")
    before = gone.select(F.col("column").alias("c2"), (F.col("_seq") + 1).alias("s2"))
    linked = gone.join(before, (F.col("column") == F.col("c2")) & (F.col("_seq") == F.col("s2")), "left").select("column", "_seq", F.col("c2").isNull().alias("starts"))
    runs = linked.withColumn("run", F.sum(F.col("starts").cast("int")).over(W.partitionBy("column").orderBy("_seq"))).groupBy("column", "run").agg(F.count(F.lit(1)).alias("length"))
    by_run = runs.groupBy("column").agg(F.count(F.lit(1)).alias("runs"), F.max("length").alias("longest"))
    follow = whole.select("column", F.col("n").alias("rows")).join(linked, "column").groupBy("column").agg(F.count_if(~F.col("starts")).alias("after_missing"), F.count_if(F.col("_seq") < F.col("rows")).alias("may_follow"), F.count_if(F.col("_seq") > F.col("rows") - 10).alias("missing_last_10"))
    t = whole.join(by_run, "column", "left").join(follow, "column", "left")
    t = t.withColumns({"runs": F.coalesce("runs", F.lit(0)), "longest": F.coalesce("longest", F.lit(0)), "leading": F.coalesce(F.col("first") - 1, F.col("n")), "trailing": F.coalesce(F.col("n") - F.col("last"), F.col("n"))})
    m, k, n = F.col("missing").cast("double"), (F.col("n") - F.col("missing")).cast("double"), F.col("n").cast("double")
    expected, variance = F.try_divide(m * (k + 1), n), F.try_divide(m * (m - 1) * k * (k + 1), n * n * (n - 1))
    t = t.withColumn("z", F.try_divide(F.col("runs") - expected, F.when(variance > 0, F.sqrt(variance))))
    return t.withColumns({"pattern": pattern(), "repeat_share": F.try_divide(F.col("after_missing").cast("double"), F.col("may_follow").cast("double"))}).select(
        "column", "n", "missing", "runs", "leading", "trailing", "longest", "z", "pattern", "repeat_share", F.coalesce("missing_last_10", F.lit(0)).alias("missing_last_10"), "first_measured", "last_measured")


def pattern():
    """The name of a profile row's pattern; the order of the tests is part of its meaning."""
    m, most = F.col("missing"), F.col("missing") * ONE_GAP
    return (
        F.when(m == 0, "Complete")
        .when(m == F.col("n"), "Never recorded")
        .when(F.col("z") > CRITICAL, "Regular skipping")
        .when(F.col("z") >= -CRITICAL, "Random gaps")
        .when(F.col("leading") >= most, "Late start")
        .when(F.col("trailing") >= most, "Stopped")
        .when(F.col("leading") + F.col("trailing") >= most, "Late start and stopped")
        .when(F.col("longest") >= most, "One long gap")
        .otherwise("Clumped")
    )


@dataclass
class Group:
    name: str
    members: list[str]
    rates: list[float]
    tightness: float
    rows_missing: int = 0


@dataclass(frozen=True)
class Bounds:
    least_rate: float = 0.05
    most_rate: float = 0.95
    similarity: float = 0.9
    categories: tuple[int, int] = (2, 20)
    present: float = 0.5
    rows_per_category: int = 5
    pool_below: float = 0.01
    self_correlation: float = 0.3


def groups(df: DataFrame, columns: Sequence[str], bounds: Bounds = Bounds()) -> list[Group]:
    """Columns that are missing in the same rows: average linkage on Jaccard similarity."""
    if not columns:
        return []
    similarity, rate, _ = jaccard_of_missing(df, columns)
    kept = [k for k in range(len(columns)) if bounds.least_rate <= rate[k] <= bounds.most_rate]
    found = stats.clusters(similarity[np.ix_(kept, kept)], bounds.similarity, "average")
    out = []
    for k, g in enumerate(found, 1):
        at = [kept[i] for i in g]
        inner = [similarity[i, j] for i in at for j in at if i < j]
        out.append(Group(f"M{k}", [columns[i] for i in at], [float(rate[i]) for i in at], float(min(inner))))
    return out


def explained(df: DataFrame, group: Sequence[str], candidates: Sequence[str], bounds: Bounds = Bounds()) -> list[dict]:
    """Categorical columns by how well they tell whether the group is missing: normalised mutual information, the worst
    category, its rate, the share of all missing rows that it covers, and whether the column is itself missing along
    with the group (self_correlated).

    A candidate has a value in enough of the rows, few enough categories, and enough rows for each of them. Categories
    below pool_below of a column's rows are pooled as "other", of which at most 1 / pool_below others remain; what is
    pooled counts like the rest.
    """
    gone = E.c(group[0]).isNull()
    for c in group[1:]:
        gone = gone | E.c(c).isNull()
    if not candidates:
        return []
    per = lambda k, c: (F.count(E.c(c)).alias(f"n{k}"), F.count_if(E.c(c).isNull() & gone).alias(f"both{k}"))
    first = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(gone).alias("gone"), *(x for k, c in enumerate(candidates) for x in per(k, c))).first()
    out = []
    for k, c in enumerate(candidates):
        rows = first[f"n{k}"]
        if not rows or rows < bounds.present * first["rows"]:
            continue
        counts = df.where(E.c(c).isNotNull()).groupBy(E.c(c).cast("string").alias("category")).agg(F.count(F.lit(1)).alias("n"), F.count_if(gone).alias("missing"))
        name = F.when(F.col("n") < bounds.pool_below * rows, "other").otherwise(F.col("category"))
        pooled = counts.groupBy(name.alias("category")).agg(F.sum("n").alias("n"), F.sum("missing").alias("missing"), F.count(F.lit(1)).alias("values")).collect()
        values = sum(r["values"] for r in pooled)
        if not bounds.categories[0] <= values <= bounds.categories[1] or rows < bounds.rows_per_category * values:
            continue
        table = {r["category"]: (r["n"], r["missing"]) for r in pooled}
        t = np.array([[n - m, m] for n, m in table.values()], dtype=float)
        worst = max(table, key=lambda x: (table[x][1] / table[x][0], table[x][1], x))
        total = t[:, 1].sum()
        phi = stats.phi(first["rows"], first["rows"] - rows, first["gone"], first[f"both{k}"])
        out.append({"column": c, "score": stats.normalised_mutual_information(t), "category": worst, "rate": table[worst][1] / table[worst][0], "covers": table[worst][1] / total if total else 0.0, "self_correlated": abs(phi) > bounds.self_correlation})
    return sorted(out, key=lambda r: (-r["score"], r["column"]))
