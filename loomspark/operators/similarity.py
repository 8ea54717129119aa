"""All-pairs statistics of numeric columns, in one pass over the rows.

Each partition's rows become matrix products of the values and of what is present; partitions' sums are added up by an
aggregation tree. So the work grows with the rows once, not once for each pair, and what reaches the driver has the size
of the columns squared.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as E
from ..session import reach_workers
from ..sources.shared import written
from .skew import hot_join
from .windows import running_total


@dataclass
class Pairwise:
    names: list[str]
    n: np.ndarray
    r: np.ndarray

    def of(self, a: str, b: str) -> float:
        return float(self.r[self.names.index(a), self.names.index(b)])


_SUMS = T.StructType([T.StructField("sums", T.ArrayType(T.DoubleType()))])


def _folded(parts: DataFrame) -> np.ndarray:
    """Sum of the partitions' arrays, all of one length: added up before they are shuffled, by place."""
    rows = parts.select(F.posexplode("sums").alias("k", "x")).groupBy("k").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(len(rows))
    for r in rows:
        out[r["k"]] = r["x"]
    return out


def gram(df: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, ...]:
    """(n, sum of i where both, sum of i squared where both, sum of products), each columns x columns.

    Values are first shifted by each column's mean, which leaves correlations as they are and keeps sums small.
    """
    p = len(columns)
    means = df.agg(*(F.avg(E.c(c)).alias(f"m{k}") for k, c in enumerate(columns))).first()
    centred = df.select(*((E.c(c).cast("double") - (means[k] or 0.0)).alias(f"x{k}") for k, c in enumerate(columns)))

    def sums(batches):
        total = np.zeros((4, p, p))
        for pdf in batches:
            x = pdf.to_numpy(dtype=float)
            there = (~np.isnan(x)).astype(float)
            z = np.where(there > 0, x, 0.0)
            total += (there.T @ there, z.T @ there, (z * z).T @ there, z.T @ z)
        yield pd.DataFrame({"sums": [total.reshape(-1).tolist()]})

    total = _folded(centred.mapInPandas(sums, _SUMS))
    return tuple((total if total.size else np.zeros(4 * p * p)).reshape(4, p, p))


def pearson(df: DataFrame, columns: Sequence[str], least: int = 3) -> Pairwise:
    """Over each pair's complete rows; NaN with fewer than `least` of them or where one is constant."""
    n, s, ss, sp = gram(df, columns)
    with np.errstate(invalid="ignore", divide="ignore"):
        cov = sp - s * s.T / n
        var = ss - s * s / n
        var = np.where(var <= 1e-12 * np.maximum(ss, 1e-300), 0.0, var)
        r = cov / np.sqrt(var * var.T)
    r = np.where((n >= max(3, least)) & (var > 0) & (var.T > 0), np.clip(r, -1, 1), np.nan)
    return Pairwise(list(columns), n, r)


def ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Average ranks of each column among its own values; null stays null.

    All columns are ranked together, as rows (column, value): a distinct value's rank follows from the counts of smaller
    ones. Counts are aggregated by value; the running total is over distinct values, in ranges, so that no column is
    gathered in one task; a frequent value meets its rank by a broadcast. The frame is shuffled once to get its rows back.
    """
    p = len(columns)
    numbered = df.select(F.monotonically_increasing_id().alias("_row"), F.array(*(E.c(c).cast("double") for c in columns)).alias("_x"))
    long = numbered.select("_row", F.posexplode("_x").alias("k", "v"))
    known = long.where("v is not null")
    counts = known.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    before = F.broadcast(counts.groupBy("k").agg(F.sum("n").alias("m")).select("k", F.coalesce(F.sum("m").over(W.orderBy("k").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base")))  # a row for each column
    placed = written(running_total(counts.select(F.struct("k", "v").alias("kv"), "n"), "kv", "n", "before").select("kv.*", "n", "before").join(before, "k").select("k", "v", "n", (F.col("before") - F.col("base") + (F.col("n") + 1) / 2).alias("r")), "ranks")
    ranked = hot_join(known, placed, ["k", "v"], "n")
    wide = ranked.unionByName(long.where("v is null").withColumns({"n": F.lit(0).cast("long"), "r": F.lit(None).cast("double")})).groupBy("_row").agg(*(F.max(F.when(F.col("k") == k, F.col("r"))).alias(f"r{k}") for k in range(p)))
    return wide.select(*(F.col(f"r{k}").alias(c) for k, c in enumerate(columns)))


def spearman(df: DataFrame, columns: Sequence[str], least: int = 3, cells_in_task: int = 2_000_000) -> Pairwise:
    """Ranks within each pair's complete rows. Columns with one missing pattern are ranked together, once for each pair of
    patterns; a frame of at most cells_in_task cells (16 bytes each) is ranked in one task, with the same result.
    """
    names, p = list(columns), len(columns)
    if not p:
        return Pairwise([], np.zeros((0, 0)), np.zeros((0, 0)))
    rows = df.count()
    if rows * p <= cells_in_task:
        numbers = df.select(*(E.c(c).cast("double").alias(f"x{k}") for k, c in enumerate(names)))

        def matrix(batches):
            parts = [pdf.to_numpy(dtype=float) for pdf in batches]
            found = spearman_matrix(np.concatenate(parts) if parts else np.zeros((0, p)), names, least)
            yield pd.DataFrame({"sums": [np.concatenate([found.n.reshape(-1), found.r.reshape(-1)]).tolist()]})

        reach_workers(df.sparkSession)
        n, r = np.array(numbers.coalesce(1).mapInPandas(matrix, _SUMS).first()["sums"], dtype=float).reshape(2, p, p)
        return Pairwise(names, n, r)
    masks = df.agg(*(F.sum(F.xxhash64(F.struct(*map(E.c, columns))).cast("decimal(38,0)") * E.c(c).isNotNull().cast("int")).alias(f"m{k}") for k, c in enumerate(columns))).first()
    patterns: dict[object, list[str]] = {}
    for k, c in enumerate(columns):
        patterns.setdefault(masks[k], []).append(c)
    n, r = np.zeros((p, p)), np.full((p, p), np.nan)
    groups = list(patterns.values())
    for i, a in enumerate(groups):
        for b in groups[i:]:
            both = df.where(E.c(a[0]).isNotNull() & E.c(b[0]).isNotNull())
            cols = a if a is b else a + b
            part = pearson(ranks(both, cols), cols, least)
            at = [names.index(c) for c in cols]
            rows_, cols_ = ([names.index(c) for c in a], [names.index(c) for c in b])
            for u in rows_:
                for w in cols_:
                    n[u, w] = n[w, u] = part.n[at.index(u), at.index(w)]
                    r[u, w] = r[w, u] = part.r[at.index(u), at.index(w)]
    return Pairwise(names, n, r)


def spearman_matrix(x: np.ndarray, names: list[str], least: int = 3) -> Pairwise:
    """spearman() of a small matrix."""
    p = x.shape[1]
    there = ~np.isnan(x)
    n, r = (there.T.astype(float) @ there), np.full((p, p), np.nan)
    for i in range(p):
        for j in range(i, p):
            both = there[:, i] & there[:, j]
            if both.sum() >= max(3, least):
                a, b = (pd.Series(x[both, k]).rank().to_numpy() for k in (i, j))
                if a.std() > 0 and b.std() > 0:
                    r[i, j] = r[j, i] = float(np.corrcoef(a, b)[0, 1])
    return Pairwise(names, n, r)


def jaccard_of_missing(df: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """(similarity, rate of missing, rows): rows where both are missing over rows where either is."""
    p = len(columns)
    flags = df.select(*(E.c(c).isNull().cast("double").alias(f"x{k}") for k, c in enumerate(columns)))

    def sums(batches):
        total, rows = np.zeros((p, p)), 0
        for pdf in batches:
            m = pdf.to_numpy(dtype=float)
            total += m.T @ m
            rows += len(m)
        yield pd.DataFrame({"sums": [[*total.reshape(-1).tolist(), float(rows)]]})

    total = _folded(flags.mapInPandas(sums, _SUMS))
    both, rows = total[:-1].reshape(p, p), int(total[-1])
    alone = np.diag(both)
    either = alone[:, None] + alone[None, :] - both
    return np.divide(both, either, out=np.zeros_like(both), where=either > 0), alone / max(1, rows), rows
