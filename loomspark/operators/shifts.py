"""Parameters whose value runs in groups over days, as a lot does, and which of them change on the same days."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..functions import stats
from ..session import reach_workers

PERMUTATIONS, MOST_P, LEAST_DAYS, LEAST_VALUES, SIMILARITY = 200, 0.01, 2.0, 20, 0.8


def group_count(df: DataFrame, by: Sequence[str], day: str, value: str) -> DataFrame:
    """How many groups a value forms over the days: distinct (day, value) pairs, less the days with a value that the day
    before (of those with a value) has too - one carry a day at most. Windows are over distinct pairs only."""
    keys = list(map(E.c, by))
    pairs = df.where(E.c(day).isNotNull() & E.c(value).isNotNull()).select(*keys, E.c(day).alias("_day"), E.c(value).alias("_value")).distinct()
    days = pairs.select(*keys, "_day").distinct().withColumn("_before", F.lag("_day").over(W.partitionBy(*keys).orderBy("_day")))
    held = pairs.withColumn("_last", F.lag("_day").over(W.partitionBy(*keys, "_value").orderBy("_day")))
    carried = held.join(days, [*by, "_day"]).where(F.col("_last") == F.col("_before")).select(*keys, "_day").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("_carried"))
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("_pairs")).join(carried, list(by), "left").select(*keys, (F.col("_pairs") - F.coalesce("_carried", F.lit(0))).alias("groups"))


def count_groups(day: np.ndarray, code: np.ndarray) -> int:
    """group_count() of one column in memory; day and code from 0 up."""
    days, place = np.unique(day, return_inverse=True)
    width = int(code.max()) + 1 if len(code) else 1
    pairs = np.unique(place.reshape(-1).astype("i8") * width + code)
    carried = pairs[np.isin(pairs - width, pairs)] // width
    return len(pairs) - len(np.unique(carried))


def segments(day: np.ndarray, code: np.ndarray) -> list[list[int]]:
    """[first day, last day, value] from left to right. What carries on is the value that carried last, if the day has it,
    else the first value in order that both days share; a day's other values are groups of their own."""
    held: dict[int, list[int]] = {}
    for d, c in np.unique(np.column_stack([day, code]), axis=0).tolist():
        held.setdefault(d, []).append(c)
    out: list[list[int]] = []
    open_: dict[int, list[int]] = {}
    carrier = None
    for d in sorted(held):
        both = [c for c in held[d] if c in open_]
        chosen = carrier if carrier in both else both[0] if both else None
        now = {}
        for c in held[d]:
            if c == chosen:
                open_[c][1] = d
                now[c] = open_[c]
            else:
                out.append(seg := [d, d, c])
                now[c] = seg
        open_, carrier = now, chosen if chosen is not None else carrier if carrier in now else None
    return out


def shift_days(day: np.ndarray, code: np.ndarray) -> set[int]:
    """Days on which a group begins, but the first day."""
    first = int(day.min())
    return {s[0] for s in segments(day, code) if s[0] != first}


def shared_shifts(days_a: set[int], shifts_a: set[int], days_b: set[int], shifts_b: set[int]) -> float:
    """Jaccard similarity of the shift days, each moved to the next day that both have."""
    common = sorted(days_a & days_b)
    moved = []
    for shifts in (shifts_a, shifts_b):
        at = np.searchsorted(common, sorted(shifts))
        moved.append({common[i] for i in at if i < len(common)})
    either = moved[0] | moved[1]
    return len(moved[0] & moved[1]) / len(either) if either else 0.0


def tested(df: DataFrame, columns: Sequence[str], day: str, plant: str | None = None) -> DataFrame:
    """By plant and column: values, days, groups, p of a permutation test of the group count, kept, shift days.

    A column of a plant is one series, as long as the plant's history; its permutations are seeded by its name, so that a
    result doesn't depend on what else is tested.
    """
    at = F.datediff(F.to_date(E.c(day)), F.lit("1970-01-01").cast("date"))
    site = F.trim(E.c(plant).cast("string")) if plant else F.lit("")
    long = df.select(site.alias("plant"), at.alias("day"), F.explode(F.array(*(F.struct(F.lit(c).alias("column"), E.c(c).cast("string").alias("value")) for c in columns))).alias("x")).select("plant", "day", "x.*").where("plant is not null and day is not null and value is not null")

    reach_workers(df.sparkSession)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["day", "value"], kind="stable")
        days, d = np.unique(rows["day"], return_inverse=True)
        code = pd.factorize(rows["value"], sort=True)[0]
        groups = count_groups(d, code)
        p = 1.0
        if len(rows) >= LEAST_VALUES and len(days) / groups >= LEAST_DAYS:
            rng = np.random.default_rng(zlib.crc32(f"{key[0]}\0{key[1]}".encode()))
            p = (1 + sum(count_groups(d, rng.permutation(code)) <= groups for _ in range(PERMUTATIONS))) / (PERMUTATIONS + 1)
        kept = p <= MOST_P
        shifts = sorted(int(days[i]) for i in shift_days(d, code)) if kept else []
        return pd.DataFrame({"plant": [key[0]], "column": [key[1]], "values": [len(rows)], "days": [len(days)], "groups": [groups], "p": [p], "kept": [kept], "shift_days": [shifts], "all_days": [[int(x) for x in days] if kept else []]})

    return long.groupBy("plant", "column").applyInPandas(run, "plant string, column string, values long, days long, groups long, p double, kept boolean, shift_days array<long>, all_days array<long>")


def segment_rows(df: DataFrame, by: str, day: str, value: str) -> DataFrame:
    """Segments of each series, by its key: (key, first, last, value). Only distinct pairs reach a series' task."""
    pairs = df.where(E.c(day).isNotNull() & E.c(value).isNotNull()).select(E.c(by).cast("string").alias("key"), E.c(day).cast("long").alias("day"), E.c(value).cast("string").alias("value")).distinct()

    reach_workers(df.sparkSession)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        code, names = pd.factorize(rows["value"], sort=True)
        found = segments(rows["day"].to_numpy(), code)
        return pd.DataFrame({"key": rows["key"].iloc[0], "first": [s[0] for s in found], "last": [s[1] for s in found], "value": [names[s[2]] for s in found]})

    return pairs.groupBy("key").applyInPandas(run, "key string, first long, last long, value string")


def shift_groups(rows: Sequence, similarity: float = SIMILARITY) -> list[list[str]]:
    """Columns of one plant (kept rows of tested()) that change on the same days: complete linkage."""
    rows = sorted((r for r in rows if r["kept"]), key=lambda r: r["column"])
    s = np.array([[shared_shifts(set(a["all_days"]), set(a["shift_days"]), set(b["all_days"]), set(b["shift_days"])) for b in rows] for a in rows]).reshape(len(rows), len(rows))
    return [[rows[i]["column"] for i in g] for g in stats.clusters(s, similarity)] if len(rows) > 1 else []
