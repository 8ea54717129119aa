"""Numeric parameters that rank the rows alike."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..functions import stats
from ..sources.shared import written
from .similarity import spearman


@dataclass
class RankGroup:
    name: str
    representative: str
    members: list[dict]
    weakest: float
    shared: int


def rank_groups(df: DataFrame, columns: Sequence[str], threshold: float = 0.9, least: int = 20, prefix: str = "C") -> tuple[list[RankGroup], dict[str, dict]]:
    """Groups by complete linkage on |Spearman|, over pairs with at least `least` shared rows; and for each column the one
    closest to it, with rho, shared rows and Benjamini-Hochberg q. An unknown pair counts as not alike at all."""
    s = spearman(df, columns, least)
    usable = [k for k in range(len(columns)) if s.n[k, k] >= least]
    strength = np.where(np.isnan(s.r) | (s.n < least), 0.0, np.abs(s.r))
    pairs = [(i, j) for a, i in enumerate(usable) for j in usable[a + 1 :] if s.n[i, j] >= least and not np.isnan(s.r[i, j])]
    q = dict(zip(pairs, stats.benjamini_hochberg([stats.correlation_p(float(s.r[i, j]), float(s.n[i, j])) for i, j in pairs])))
    groups = []
    for k, g in enumerate(stats.clusters(strength[np.ix_(usable, usable)], threshold), 1):
        at = [usable[i] for i in g]
        ranked = stats.core(strength, s.n, at)
        inner = [(i, j) for a, i in enumerate(at) for j in at[a + 1 :]]
        groups.append(RankGroup(f"{prefix}{k}", columns[ranked[0][0]], [{"parameter": columns[i], "score": x, "values": int(s.n[i, i]), "sign": 1 if i == ranked[0][0] or s.r[i, ranked[0][0]] >= 0 else -1} for i, x in ranked], min(float(strength[p]) for p in inner), int(min(s.n[p] for p in inner))))
    closest = {}
    for i in usable:
        others = [j for j in usable if j != i]
        if others:
            j = max(others, key=lambda j: (strength[i, j], -j))
            if strength[i, j] > 0:
                closest[columns[i]] = {"closest": columns[j], "rho": float(s.r[i, j]), "shared": int(s.n[i, j]), "q": float(q.get((min(i, j), max(i, j)), np.nan))}
    return groups, closest


def usable_representative(group: RankGroup, excluded: Sequence[str]) -> str:
    """The best-scoring member that isn't excluded elsewhere; "= suggested" if that is the representative, empty without
    one."""
    usable = [m for m in group.members if m["parameter"] not in set(excluded)]
    if not usable:
        return ""
    best = max(usable, key=lambda m: m["score"])["parameter"]
    return "= suggested" if best == group.representative else best


def adjusted(df: DataFrame, p: str, name: str) -> DataFrame:
    """df with Benjamini-Hochberg values of its rows' p, as stats.benjamini_hochberg gives them; null and NaN give null.

    Equal p have equal values, so that only distinct p are ranked. They are dealt out by ranges; of each range only its
    count and its least value are brought together.
    """
    value = E.c(p).cast("double")
    counts = df.where(value.isNotNull() & ~F.isnan(value)).groupBy(value.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    # Written, so that both passes see the same ranges.
    ranged = written(counts.repartitionByRange("_p").withColumn("_part", F.spark_partition_id()), "adjusted")
    parts = W.orderBy("_part")
    starts = ranged.groupBy("_part").agg(F.sum("_n").alias("_rows")).select("_part", F.coalesce(F.sum("_rows").over(parts.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_start"), F.sum("_rows").over(W.partitionBy(F.lit(0))).alias("_m"))
    rank = F.col("_start") + F.sum("_n").over(W.partitionBy("_part").orderBy("_p").rowsBetween(W.unboundedPreceding, 0))
    raw = ranged.join(F.broadcast(starts), "_part").select("_part", "_p", (F.col("_p") * F.col("_m") / rank).alias("_raw"))
    later = raw.groupBy("_part").agg(F.min("_raw").alias("_least")).select("_part", F.min("_least").over(parts.rowsBetween(1, W.unboundedFollowing)).alias("_later"))
    least = F.min("_raw").over(W.partitionBy("_part").orderBy("_p").rowsBetween(0, W.unboundedFollowing))
    found = raw.join(F.broadcast(later), "_part").select("_p", F.least(F.lit(1.0), least, "_later").alias("_q"))
    return df.join(found, value == F.col("_p"), "left").select(*map(E.c, df.columns), F.col("_q").alias(name))
