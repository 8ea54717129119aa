"""Numerical routines over small arrays on the driver: matrices of columns, never rows of data."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np


def linkage(similarity: np.ndarray, method: str = "complete") -> list[tuple[tuple[int, ...], tuple[int, ...], float]]:
    """Merges of agglomerative clustering by distance 1 - similarity: (members, members, distance), nearest first.

    An unknown similarity (NaN) is a distance of 2, so that unknown pairs never meet under complete linkage. Ties go to
    the pair of smallest indices.
    """
    d = np.where(np.isnan(similarity), 2.0, 1.0 - np.nan_to_num(similarity))
    np.fill_diagonal(d, np.inf)
    groups = {i: (i,) for i in range(len(d))}
    merges = []
    while len(groups) > 1:
        live = sorted(groups)
        sub = d[np.ix_(live, live)]
        i, j = divmod(int(np.argmin(sub)), len(live))
        a, b = sorted((live[i], live[j]))
        merges.append((groups[a], groups[b], float(d[a, b])))
        na, nb = len(groups[a]), len(groups[b])
        for k in live:
            if k not in (a, b):
                x = max(d[a, k], d[b, k]) if method == "complete" else (na * d[a, k] + nb * d[b, k]) / (na + nb)
                d[a, k] = d[k, a] = x
        d[b, :] = d[:, b] = np.inf
        groups[a] = tuple(sorted(groups[a] + groups.pop(b)))
    return merges


def clusters(similarity: np.ndarray, threshold: float, method: str = "complete", least: int = 2) -> list[list[int]]:
    """Groups of at least `least` whose merges are all at a similarity of threshold or more."""
    of = {i: (i,) for i in range(len(similarity))}
    for a, b, distance in linkage(similarity, method):
        if distance <= 1 - threshold + 1e-12:
            for i in a + b:
                of[i] = tuple(sorted(a + b))
    return sorted((list(g) for g in set(of.values()) if len(g) >= least), key=lambda g: (-len(g), g))


def benjamini_hochberg(p: Sequence[float]) -> np.ndarray:
    """Adjusted values, in the order given; NaN stays."""
    p = np.asarray(p, dtype=float)
    known = np.flatnonzero(~np.isnan(p))
    out = np.full(len(p), np.nan)
    order = known[np.argsort(-p[known], kind="stable")]
    m = len(known)
    out[order] = np.minimum(np.minimum.accumulate(p[order] * m / np.arange(m, 0, -1)), 1) if m else []
    return out


def _beta_fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function, by Lentz's rule."""
    tiny = 1e-300
    c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), tiny)
    h = d
    for m in range(1, 300):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + term * d
            c = 1 + term / c
            d, c = 1 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h


def student_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|)."""
    if math.isnan(t) or df <= 0:
        return math.nan
    x = df / (df + t * t)
    if x <= 0 or x >= 1:
        return float(x >= 1)
    a, b = df / 2, 0.5
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_fraction(b, a, 1 - x) / b


def correlation_p(r: float, n: float) -> float:
    """Two-sided p of a correlation of n pairs."""
    if n < 3 or math.isnan(r):
        return math.nan
    if abs(r) >= 1:
        return 0.0
    return student_two_sided(r * math.sqrt((n - 2) / (1 - r * r)), n - 2)


def core(similarity: np.ndarray, counts: np.ndarray, group: Sequence[int]) -> list[tuple[int, float]]:
    """Members by how well they stand for their group: mean similarity to the others, each weighted by the share of the
    other's values that they have together; ties go to the one with most values."""
    scores = []
    for i in group:
        others = [j for j in group if j != i]
        scores.append((i, float(np.mean([similarity[i, j] * counts[i, j] / counts[j, j] for j in others])) if others else 1.0))
    return sorted(scores, key=lambda s: (-round(s[1], 12), -counts[s[0], s[0]], s[0]))


def entropy(p: np.ndarray) -> float:
    p = p[p > 0]
    return float(-(p * np.log2(p)).sum())


def normalised_mutual_information(table: np.ndarray) -> float:
    """Of a table of counts: mutual information over the entropy of its columns (the target); 0 without any."""
    whole = table / max(1, table.sum())
    rows, columns = whole.sum(axis=1), whole.sum(axis=0)
    h = entropy(columns)
    return (entropy(rows) + h - entropy(whole.reshape(-1))) / h if h else 0.0


def phi(n: int, a: int, b: int, both: int) -> float:
    """Correlation of two flags of n rows that are set in a and b of them, in `both` together; 0 if one never changes."""
    spread = a * (n - a) * b * (n - b)
    return (n * both - a * b) / math.sqrt(spread) if spread else 0.0


def adjusted_r2(r2: float, n: int, parameters: int) -> float:
    return 1 - (1 - r2) * (n - 1) / (n - parameters - 1) if n > parameters + 1 else math.nan
