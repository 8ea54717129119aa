"""Joins with a table of facts, one row a key, when a few keys may have a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that meet their rows by a broadcast; any other key has at most this part of the rows.
HOT_KEYS = 1000


def hot_join(rows: DataFrame, facts: DataFrame, on: Sequence[str], weight: str, how: str = "inner") -> DataFrame:
    """rows joined with facts on columns of the same names; how is inner, left or left_semi.

    facts has one row for each key and, as weight, about how many rows have the key; it is read twice, so it should be
    cheap to compute again. The HOT_KEYS keys of the largest weight, a table of so many rows, are broadcast, and their
    rows stay where they are; only the other rows are shuffled, of which no key has more than a HOT_KEYS-th. Rows with a
    null in a key stay where they are too. A left join gives a null weight to rows without facts; a semi-join leaves
    the columns of rows.
    """
    on = list(on)
    kept = facts.columns if how != "left_semi" else on
    others = [c for c in facts.columns if c not in on]
    hot = facts.orderBy(F.desc(weight), *on).limit(HOT_KEYS).select(*on, F.struct(*others).alias("_hot"))
    # One broadcast serves both parts: what it finds, and what it leaves.
    tagged = rows.join(F.broadcast(hot), on, "left")
    there = F.lit(True)
    for c in on:
        there = there & F.col(c).isNotNull()
    found = tagged.where("_hot is not null").select(*rows.columns, *(F.col(f"_hot.{c}").alias(c) for c in kept if c not in on))
    left = tagged.where(F.col("_hot").isNull() & there).drop("_hot")
    rest = left.join(facts.select(*kept), on, how).select(*rows.columns, *(c for c in kept if c not in on))
    out = found.unionByName(rest)
    if how == "left":
        none = tagged.where(F.col("_hot").isNull() & ~there).select(*rows.columns, *(F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in kept if c not in on))
        out = out.unionByName(none)
    return out
