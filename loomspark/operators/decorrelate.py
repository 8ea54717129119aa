"""Groups of predictors that move together within a task, and what is done about them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..functions import stats
from ..session import reach_workers
from . import similarity as S

ACTIONS = ("off", "describe", "keep_one", "residualise", "summarise")


@dataclass(frozen=True)
class Knobs:
    threshold: float = 0.7
    method: str = "spearman"
    least_shared: int = 10
    resamples: int = 50
    share: float = 0.8
    stable: float = 0.5
    duplicate_r2: float = 0.99


@dataclass
class Cluster:
    name: str
    members: list[str]
    representative: str = ""
    stability: float = 0.0
    weakest: float = 0.0


def correlations(df: DataFrame, columns: Sequence[str], knobs: Knobs = Knobs()) -> S.Pairwise:
    return (S.spearman if knobs.method == "spearman" else S.pearson)(df, columns, knobs.least_shared)


def clusters(p: S.Pairwise, knobs: Knobs = Knobs(), prefix: str = "G") -> list[Cluster]:
    strength = np.abs(p.r)
    out = []
    for k, g in enumerate(stats.clusters(strength, knobs.threshold), 1):
        out.append(Cluster(f"{prefix}{k}", [p.names[i] for i in g], weakest=min(float(strength[i, j]) for i in g for j in g if i < j)))
    return out


def stability(df: DataFrame, found: Sequence[Cluster], columns: Sequence[str], knobs: Knobs = Knobs(), seed: int = 0) -> list[Cluster]:
    """Share of resamples in which a cluster lies within one that is found there.

    A row is in resample b by a hash of the row and b, so all resamples' sums come from one pass over the rows.
    """
    p, b = len(columns), knobs.resamples
    if not found:
        return []
    reach_workers(df.sparkSession)
    source = S.ranks(df, columns) if knobs.method == "spearman" else df
    means = source.agg(*(F.avg(E.c(c)).alias(f"m{k}") for k, c in enumerate(columns))).first()
    rows = source.select(F.xxhash64(*(E.c(c) for c in columns), F.monotonically_increasing_id()).alias("key"), *((E.c(c).cast("double") - (means[k] or 0.0)).alias(f"x{k}") for k, c in enumerate(columns)))

    def sums(batches):
        import pandas as pd

        total = np.zeros((b, 4, p, p))
        for pdf in batches:
            x = pdf.iloc[:, 1:].to_numpy(dtype=float)
            key = pdf.iloc[:, 0].to_numpy().astype("i8").view("u8")
            there = (~np.isnan(x)).astype(float)
            z = np.where(there > 0, x, 0.0)
            for k in range(b):
                h = (key ^ np.uint64((seed * 1_000_003 + k + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xD6E8FEB86659FD93)
                h ^= h >> np.uint64(32)
                at = (h % np.uint64(1000)).astype(int) < 1000 * knobs.share
                o, v = there[at], z[at]
                total[k] += (o.T @ o, v.T @ o, (v * v).T @ o, v.T @ v)
        yield pd.DataFrame({"sums": [total.reshape(-1).tolist()]})

    total = S._folded(rows.mapInPandas(sums, S._SUMS))
    total = (total if total.size else np.zeros(b * 4 * p * p)).reshape(b, 4, p, p)
    hits = np.zeros(len(found))
    for n, s, ss, sp in total:
        with np.errstate(invalid="ignore", divide="ignore"):
            cov, var = sp - s * s.T / n, ss - s * s / n
            r = np.where((n >= knobs.least_shared) & (var > 0) & (var.T > 0), cov / np.sqrt(var * var.T), np.nan)
        groups = [set(g) for g in stats.clusters(np.abs(r), knobs.threshold)]
        for k, c in enumerate(found):
            hits[k] += any({columns.index(m) for m in c.members} <= g for g in groups)
    for k, c in enumerate(found):
        c.stability = float(hits[k] / b)
    return list(found)


def representative(p: S.Pairwise, members: Sequence[str], prefer: Sequence[str] = (), least_shared: int = 10) -> str:
    """Of the well covered members (as many values as the median, or least_shared) the one that tells most of the others."""
    at = [p.names.index(m) for m in members]
    values = np.array([p.n[i, i] for i in at])
    bar = max(least_shared, float(np.median(values)))

    def rank(k: int):
        r2 = [p.r[at[k], j] ** 2 for j in at if j != at[k] and not np.isnan(p.r[at[k], j])]
        return (values[k] >= bar, round(float(np.mean(r2)) if r2 else 0.0, 12), values[k], members[k] in prefer)

    return members[max(range(len(at)), key=lambda k: (*rank(k), [-ord(ch) for ch in members[k]]))]


def duplicates(p: S.Pairwise, prefer: Sequence[str] = (), r2: float = 0.99, least_shared: int = 10) -> dict[str, str]:
    """Dropped column -> the one that stays for it. Most complete first, ties by preference and name; what is dropped
    always names one that stays."""
    order = sorted(range(len(p.names)), key=lambda i: (-p.n[i, i], p.names[i] not in prefer, p.names[i]))
    kept, out = [], {}
    for i in order:
        twin = next((j for j in kept if p.n[i, j] >= least_shared and not np.isnan(p.r[i, j]) and p.r[i, j] ** 2 >= r2), None)
        if twin is None:
            kept.append(i)
        else:
            out[p.names[i]] = p.names[twin]
    return out


def complete_gram(df: DataFrame, columns: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, means, covariance) over rows in which all columns are there."""
    whole = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in columns)) if columns else df
    n, s, _, sp = S.gram(whole.select(*(E.c(c).cast("double").alias(c) for c in columns)), columns)
    means = whole.agg(*(F.avg(E.c(c)) for c in columns)).first()
    rows = int(n[0, 0]) if len(columns) else 0
    cov = (sp - np.outer(np.diag(s), np.diag(s)) / max(1, rows)) / max(1, rows - 1)
    return rows, np.array([m if m is not None else np.nan for m in means], dtype=float), cov


def regression(df: DataFrame, y: str, xs: Sequence[str]) -> dict | None:
    """Least squares of y on xs over complete rows, from sums alone; None with too few rows."""
    rows, means, cov = complete_gram(df, [y, *xs])
    if rows < len(xs) + 2:
        return None
    beta = np.linalg.lstsq(cov[1:, 1:], cov[1:, 0], rcond=None)[0]
    explained = float(beta @ cov[1:, 0])
    r2 = explained / float(cov[0, 0]) if cov[0, 0] > 0 else float("nan")
    return {"column": y, "on": list(xs), "coefficients": beta.tolist(), "intercept": float(means[0] - beta @ means[1:]), "rows": rows, "r2": r2, "adjusted_r2": stats.adjusted_r2(r2, rows, len(xs))}


def residuals(df: DataFrame, members: Sequence[str], first: str, p: S.Pairwise, least_shared: int = 10) -> list[dict]:
    """The representative stays; each other member, most complete first, is regressed on all before it. A member without
    enough shared rows stays as recorded."""
    rest = sorted((m for m in members if m != first), key=lambda m: (-p.n[p.names.index(m), p.names.index(m)], m))
    before, out = [first], []
    for m in rest:
        fit = regression(df, m, before)
        if fit and fit["rows"] >= max(least_shared, len(before) + 2):
            out.append(fit)
        before.append(m)
    return out


def residual(fit: dict) -> Column:
    """A linear expression; null where an input is missing."""
    predicted = F.lit(fit["intercept"])
    for b, x in zip(fit["coefficients"], fit["on"]):
        predicted = predicted + E.c(x) * b
    return E.c(fit["column"]) - predicted


def summary(df: DataFrame, members: Sequence[str], first: str, p: S.Pairwise) -> dict:
    """What a group's score needs: each member's mean, spread (1 where there is none) and sign against the first."""
    found = df.agg(*(x for m in members for x in (F.avg(E.c(m)), F.stddev_pop(E.c(m))))).first()
    i = p.names.index(first)
    return {"members": [{"column": m, "mean": found[2 * k], "spread": found[2 * k + 1] or 1.0, "sign": -1 if p.r[i, p.names.index(m)] < 0 else 1} for k, m in enumerate(members)]}


def score(fit: dict) -> Column:
    """Mean of the members' signed z-scores, over those that are there."""
    return E.row_mean([(E.c(m["column"]) - m["mean"]) / m["spread"] * m["sign"] for m in fit["members"] if m["mean"] is not None])


def most_correlated(p: S.Pairwise) -> float:
    r = np.abs(p.r[np.triu_indices(len(p.names), 1)])
    return float(np.nanmax(r)) if len(r) and not np.isnan(r).all() else float("nan")


def most_inflated(df: DataFrame, columns: Sequence[str]) -> float:
    """Largest variance inflation factor over complete rows: infinite if collinear, NaN without enough rows."""
    rows, _, cov = complete_gram(df, columns)
    spread = np.sqrt(np.diag(cov))
    if rows <= len(columns) + 1 or not (spread > 0).all():
        return float("nan")
    r = cov / np.outer(spread, spread)
    if np.linalg.matrix_rank(r, tol=1e-10) < len(columns):
        return float("inf")
    return float(np.diag(np.linalg.inv(r)).max())


@dataclass
class Fitted:
    """What transform needs, as plain data."""

    action: str
    clusters: list[dict] = field(default_factory=list)
    drop: list[str] = field(default_factory=list)
    residuals: list[dict] = field(default_factory=list)
    scores: dict[str, dict] = field(default_factory=dict)


def fit(df: DataFrame, columns: Sequence[str], action: str = "describe", knobs: Knobs = Knobs(), prefer: Sequence[str] = (), site: str | None = None, least_stability: float | None = None) -> Fitted:
    """Clusters of columns and, for those that are stable, what the action makes of them. site: values are first centred
    within their site, so that a difference between sites isn't taken for a relation."""
    if action not in ACTIONS:
        raise ValueError(f"action {action!r} is none of {', '.join(ACTIONS)}")
    out = Fitted(action)
    if action == "off" or len(columns) < 2:
        return out
    values = df.select(*(E.c(c) for c in columns))
    if site:
        means = df.groupBy(E.c(site).alias("_s")).agg(*(F.avg(E.c(c)).alias(f"_m{k}") for k, c in enumerate(columns)))
        values = df.join(means, E.c(site).eqNullSafe(F.col("_s")), "left").select(*((E.c(c) - F.col(f"_m{k}")).alias(c) for k, c in enumerate(columns)))
    p = correlations(values, columns, knobs)
    found = stability(values, clusters(p, knobs), list(columns), knobs)
    for c in found:
        c.representative = representative(p, c.members, prefer, knobs.least_shared)
        changed = action != "describe" and c.stability >= (knobs.stable if least_stability is None else least_stability)
        out.clusters.append({"name": c.name, "members": c.members, "representative": c.representative, "stability": c.stability, "weakest": c.weakest, "changed": changed})
        if not changed:
            continue
        if action == "keep_one":
            out.drop += [m for m in c.members if m != c.representative]
        elif action == "residualise":
            out.residuals += residuals(df, c.members, c.representative, p, knobs.least_shared)
        else:
            out.scores[f"{c.name}_score"] = summary(df, c.members, c.representative, p)
            out.drop += c.members
    return out


def transform(df: DataFrame, fitted: Fitted) -> DataFrame:
    """Recorded coefficients only: one projection, on any rows."""
    made = {n: score(s) for n, s in fitted.scores.items()} | {r["column"]: residual(r) for r in fitted.residuals}
    return df.withColumns(made).drop(*fitted.drop) if made else df.drop(*fitted.drop)


def membership(fitted: Fitted, columns: Sequence[str], retained: Sequence[str]) -> list[dict]:
    """A row for each column: its cluster or none, whether it represents it, and whether it is still there."""
    of = {m: c for c in fitted.clusters for m in c["members"]}
    return [{"parameter": c, "cluster": of[c]["name"] if c in of else "", "representative": c in of and of[c]["representative"] == c, "stability": of[c]["stability"] if c in of else None, "retained": c in retained} for c in columns]
