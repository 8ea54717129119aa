"""URL filter: host and path rules, and gradient-boosted trees on lexical features for what no rule decides."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_type, map_batches
from .url_labels import labelled_urls

#: Fixed values of the contract: (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url or one without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring({u}, instr({u}, '://') + 3)".format(u="_url"))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^(?s)([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^(?s)[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (host + path as one string) and its verdict; both null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


# --- features ------------------------------------------------------------------------------------------------------


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


FEATURES = ("url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digits", "hyphens", "longest_label", "host_entropy", "path_entropy", "parameters", "query_length", "vowel_ratio", "secure", "suffix_rate", "ending_rate", "gram_mean", "gram_high", "gram_low")
#: Length of the character strings of a host that have statistics.
GRAM = 4


def grams(host: str) -> set[str]:
    """The character strings of a host's name, without its last label; ^ and $ mark where labels begin and end."""
    name = "".join(f"^{label}$" for label in host.split(".")[:-1] if label not in ("www", "m"))
    return {name[i : i + GRAM] for i in range(max(0, len(name) - GRAM + 1))}


def features(url: str | None, host: str, path: str, statistics: dict[str, float]) -> list[float]:
    """Numbers in the order of FEATURES; a null url counts as empty."""
    url = url or ""
    letters = sum(c.isalpha() for c in host)
    query = url.partition("?")[2].partition("#")[0]
    labels = host.split(".")
    last = path.rpartition("/")[2]
    ending = "." + last.rpartition(".")[2] if "." in last else "/"
    rate = lambda key: statistics.get(key, statistics.get("", 0.5))
    odds = sorted(statistics.get("=" + g, 0.0) for g in grams(host)) or [0.0]
    few = max(1, len(odds) // 4)
    return [
        len(url), len(host), len(path), path.strip("/").count("/") + bool(path.strip("/")), len(labels), sum(c.isdigit() for c in url) / max(1, len(url)), sum(c.isdigit() for c in host), host.count("-"),
        max(map(len, labels)), _entropy(host), _entropy(path), query.count("=") + query.count("&") * ("=" not in query), len(query), sum(c in "aeiou" for c in host) / max(1, letters), url[:5].lower() == "https", rate("." + labels[-1]), rate(ending),
        sum(odds) / len(odds), sum(odds[-few:]) / few, sum(odds[:few]) / few,
    ]


def suffix_statistics(labelled: list[tuple[str, str, str, int]], prior_weight: float = 20.0) -> dict[str, float]:
    """From (url, host, path, label): the share of blocked urls for each top-level label and each ending of a path, drawn
    towards the overall share (""); and, under "=" and the string, log odds of the strings in hosts' names."""
    overall = sum(y for *_, y in labelled) / max(1, len(labelled))
    n, bad, there, blocked = Counter(), Counter(), Counter(), Counter()
    for _, host, path, y in labelled:
        last = path.rpartition("/")[2]
        for key in ("." + host.rpartition(".")[2], "." + last.rpartition(".")[2] if "." in last else "/"):
            n[key] += 1
            bad[key] += y
        for g in grams(host):
            there[g] += 1
            blocked[g] += y
    odds = {"=" + g: math.log((blocked[g] + overall) / (k - blocked[g] + 1 - overall)) for g, k in there.items() if k > 1}
    return {"": overall} | {k: (bad[k] + prior_weight * overall) / (n[k] + prior_weight) for k in n} | odds


# --- boosted trees -------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Boosted:
    """Complete trees of one depth: at each inner node a feature and a limit; a larger value goes right."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    limit: np.ndarray
    leaf: np.ndarray  # trees x leaves
    statistics: dict[str, float]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        for f, t, leaf in zip(self.feature, self.limit, self.leaf):
            node = np.zeros(len(x), dtype=np.intp)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def fit_boosted(x: np.ndarray, y: np.ndarray, statistics: dict[str, float], rounds: int = 60, depth: int = 3, rate: float = 0.2, most_bins: int = 32, ridge: float = 1.0) -> Boosted:
    """Newton boosting of the logistic loss; splits are searched over histograms of quantile bins."""
    limits = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, most_bins + 1)[1:-1], method="lower")) for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(limits[j], x[:, j], side="left") for j in range(x.shape[1])])
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    base = math.log(share / (1 - share))
    raw, inner = np.full(len(y), base), 2**depth - 1
    out_f, out_t, out_l = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        f, t, node = np.zeros(inner, dtype=np.intp), np.full(inner, np.inf), np.zeros(len(y), dtype=np.intp)
        for k in range(inner):
            at = np.flatnonzero(node == k)
            best, G, H = 1e-6, g[at].sum(), h[at].sum()
            for j in range(x.shape[1]) if len(at) else ():
                n = len(limits[j]) + 1
                gl = np.cumsum(np.bincount(binned[at, j], g[at], n))[:-1]
                hl = np.cumsum(np.bincount(binned[at, j], h[at], n))[:-1]
                gain = gl**2 / (hl + ridge) + (G - gl) ** 2 / (H - hl + ridge) - G**2 / (H + ridge)
                if len(gain) and gain.max() > best:
                    best, f[k], t[k] = gain.max(), j, limits[j][gain.argmax()]
            node[at] = 2 * k + 1 + (x[at, f[k]] > t[k])
        G, H = np.bincount(node - inner, g, inner + 1), np.bincount(node - inner, h, inner + 1)
        leaf = -rate * G / (H + ridge)
        raw += leaf[node - inner]
        out_f.append(f), out_t.append(t), out_l.append(leaf)
    return Boosted(base, np.array(out_f), np.array(out_t), np.array(out_l), statistics)


def train(labelled: list[tuple[str, int]], folds: int = 5, **knobs) -> Boosted:
    """A model from (url, 1 if it is to be blocked). The list is fitted on the driver; its length is the caller's bound.

    Statistics of strings would know the urls that they come from: what the trees learn from has those of the other
    folds, and hosts of one name are in one fold.
    """
    parsed = [(u, *split(u), y) for u, y in labelled]
    fold = [crc32(".".join(h.split(".")[-2:]).encode()) % folds for _, h, _, _ in parsed]
    x = np.zeros((len(parsed), len(FEATURES)))
    for k in range(folds):
        others = suffix_statistics([p for p, f in zip(parsed, fold) if f != k])
        for i, (u, h, p, _) in enumerate(parsed):
            if fold[i] == k:
                x[i] = features(u, h, p, others)
    return fit_boosted(x, np.array([y for *_, y in parsed], dtype=float), suffix_statistics(parsed), **knobs)


def split(url: str) -> tuple[str, str]:
    """host_and_path() of a text."""
    rest = url.partition("://")[2]
    host = rest
    for c in "/?#":
        host = host.partition(c)[0]
    path = rest[len(host) :]
    for c in "?#":
        path = path.partition(c)[0]
    return host.translate(str.maketrans(_UPPER, _LOWER)), path


@cache
def default_model() -> Boosted:
    return train(labelled_urls())


def url_filter(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, model: Boosted | None = None) -> DataFrame:
    """One row per input row: id_col, host, path, rule, verdict (allow or block) and score (the model's, 0 to 1).

    The longest rule that fits decides; where none does, the model blocks from a score of 0.5 on. A null url, or one
    without ://, has an empty host and path, and the model judges it by what there is. Repeated rows and null ids are
    rows like others; an empty table gives none. A very long url is read whole. The default model's labels are those of
    url_labels.
    """
    trees = model or default_model()
    plain = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("_url"))
    host, path = host_and_path(F.col("_url"))
    parsed = plain.select("id", "_url", host.alias("host"), path.alias("path"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    parsed = parsed.select("id", "_url", "host", "path", rule.alias("rule"), verdict.alias("ruled"))

    def scored(batches):
        for batch in batches:
            x = np.array([features(*row, trees.statistics) for row in zip(*(batch.column(c).to_pylist() for c in ("_url", "host", "path")))], dtype=float)
            score = trees.score(x.reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "host", "path", "rule", "ruled")), pa.array(score)], ["id", "host", "path", "rule", "ruled", "score"])

    schema = f"id {id_type(pages, id_col)}, host string, path string, rule string, ruled string, score double"
    judged = map_batches(parsed, scored, schema)
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
