"""Order-dependent computations that don't gather all rows of an order in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..sources.shared import written


def _in_ranges(df: DataFrame, key: Column, inside: Callable[[WindowSpec], Column], size: Column, name: str) -> DataFrame:
    """df with name: what inside gives over the rows of a range in the key's order, plus the size of all ranges before.

    The rows with their ranges are written: a plan that dealt them out twice would draw other bounds, or merge other
    ranges, each time.
    """
    # Parquet has no type for columns without any value.
    void = {c for c, kind in df.dtypes if kind == "void"}
    kept = [c for c in df.columns if c not in void]
    ranged = df.select(*map(E.c, kept), key.alias("_key"), size.alias("_size")).repartitionByRange("_key").withColumn("_part", F.spark_partition_id())
    numbered = ranged.withColumn("_inside", inside(W.partitionBy("_part").orderBy("_key")))
    ranges = written(numbered.select(*(E.c(c).alias(f"c{k}") for k, c in enumerate(kept)), "_part", "_size", "_inside"), "ranges")
    starts = ranges.groupBy("_part").agg(F.sum("_size").alias("_total")).select("_part", F.coalesce(F.sum("_total").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    at = {c: f"c{k}" for k, c in enumerate(kept)}
    return ranges.join(F.broadcast(starts), "_part").select(*((F.lit(None) if c in void else F.col(at[c])).alias(c) for c in df.columns), (F.col("_start") + F.col("_inside")).alias(name))


def running_total(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """df (order, value; order unique) with the total of value over all smaller orders.

    Rows are dealt out by ranges of the order; totals of ranges, one row for each, give every range its start.
    """
    before = lambda w: F.coalesce(F.sum("_size").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return _in_ranges(df, E.c(order), before, E.c(value), name)


def ordered(df: DataFrame, order: str, tie: str | None = None) -> DataFrame:
    """df with _seq, its place in the order: nulls last, ties by `tie` or as read."""
    key = F.struct(E.c(order).isNull().alias("none"), E.c(order).alias("at"), (E.c(tie) if tie else F.monotonically_increasing_id()).alias("tie"))
    return _in_ranges(df, key, lambda w: F.row_number().over(w), F.lit(1), "_seq").withColumn("_seq", F.col("_seq").cast("long"))


def last_rows(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of the greatest order for each key; combined before the shuffle, so a hot key is no hot task."""
    row = F.struct(*(E.c(c).alias(c) for c in df.columns))
    return df.groupBy(*map(E.c, keys)).agg(F.max_by(row, E.c(order)).alias("_row")).select("_row.*")
