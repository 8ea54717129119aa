"""Connected components of links between ids, by alternating star contraction over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written
from .skew import hot_join

#: A contraction halves what is left of each component at least; so many rounds serve any graph that fits a disk.
MOST_ROUNDS = 60


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _settled(links: DataFrame) -> bool:
    """Whether links (u to v, once each) are stars: each u has one link, and no v is a u."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(links.select("v", F.lit(0), F.lit(1)))
    return not ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").limit(1).collect()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (u, v), root being the smallest node reachable.

    Links with a null end or with equal ends say nothing. Large-star: each node's larger neighbours are linked to the
    smallest of its neighbourhood; small-star: so are its smaller neighbours and it itself. What remains in the end is a
    star around each component's smallest node. Minima are combined before they are shuffled, and a hub's links meet its
    minimum by a broadcast (hot_join), so that no task has all of a hub. Each step is written: a join reads its facts
    twice and its rows twice, so a plan of a whole round has each step many times over, which fills the driver.
    """
    state = written(links.where("u <> v").select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")).select("u", "v").distinct(), "links")
    rounds = 0
    while not _settled(state):
        if rounds == MOST_ROUNDS:
            raise RuntimeError(f"components still change after {MOST_ROUNDS} rounds")
        rounds += 1
        both = _both_ways(state)
        least = written(both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n"), "least")
        large = hot_join(both, least, ["u"], "n").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # All links now lead from the larger to the smaller node.
        large = written(large.distinct(), "links")
        least = written(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "least")
        small = hot_join(large, least, ["u"], "n").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        state = written(small.where("u <> v").distinct(), "links")
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).union(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
