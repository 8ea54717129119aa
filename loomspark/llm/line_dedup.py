"""Boilerplate lines across sites, with DataFrame operations only.

Each distinct line gets a HyperLogLog sketch of the sites that have it; sketches of partitions merge by aggregation.
Lines whose estimate is near the threshold get an exact distinct count. Lines on enough sites are removed everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import hot_join
from .common import row_number, steady, whole_text, written

#: Relative standard error of a sketch of 2^12 registers, times three and a margin: how far off an estimate counts as near.
LOG_REGISTERS, BAND = 12, 0.06


def _lines(docs: DataFrame) -> DataFrame:
    """(_row, _site, at, h1, h2) of each line that isn't blank, told apart by 128 bits of hash."""
    spread = docs.select("_row", "_site", F.posexplode("_lines").alias("at", "line")).withColumn("line", F.trim(F.col("line"), F.lit(" \t\x0b\x0c\r"))).where("line <> ''")
    return spread.select("_row", "_site", "at", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2"))


def boilerplate(lines: DataFrame, least_sites: int) -> DataFrame:
    """(h1, h2, n) of lines that at least least_sites sites have, n being their number of occurrences with a site.

    A line on so many sites has as many occurrences, and sites that differ: only such lines are sketched. Occurrences of
    a frequent line are combined before they are shuffled, and told by a broadcast of the most frequent lines.
    """
    key, site = ["h1", "h2"], F.xxhash64("_site")
    sited = lines.where("_site is not null")
    frequent = sited.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(site).alias("low"), F.max(site).alias("high")).where((F.col("n") >= least_sites) & ((F.col("low") < F.col("high")) | F.lit(least_sites <= 1)))
    frequent = written(frequent.select(*key, "n"), "line-counts")
    candidates = hot_join(sited, frequent, key, "n", "left_semi")
    sketched = written(candidates.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_estimate(F.hll_sketch_agg("_site", LOG_REGISTERS)).alias("sites")), "line-sites")
    margin = 1 + BAND * least_sites
    near = sketched.where((F.col("sites") >= least_sites - margin) & (F.col("sites") <= least_sites + margin)).select(*key, "n")
    exact = hot_join(sited, near, key, "n").groupBy(*key, "n").agg(F.count_distinct("_site").alias("sites")).where(F.col("sites") >= least_sites)
    return written(sketched.where(F.col("sites") > least_sites + margin).select(*key, "n").union(exact.select(*key, "n")), "line-boilerplate")


def _without(lines: Column, places: Column) -> Column:
    """lines less those at places (sorted, from 0): the stretches between them, put together."""
    starts = F.concat(F.array(F.lit(0)), F.transform(places, lambda p: p + 1))
    ends = F.concat(places, F.array(F.size(lines)))
    return F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(lines, a + 1, b - a)))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", least_sites: int = 10) -> DataFrame:
    """One row per input row: id_col, n_lines, n_removed, text (what is left, joined by newlines).

    Lines are what \\n separates; they are equal when identical after trimming [\\x20\\x09\\x0B-\\x0D], and blank ones always
    stay. Null texts count as empty: one blank line. A null site is no site: its lines count nowhere, but boilerplate is
    removed from them too. Repeated rows count once, by their site, and each keeps its row; an empty table gives none.
    Two lines are taken for equal if 128 bits of hash agree (2 of 10^16 lines do so by chance less than once in 10^6
    corpora). A very long text is split where it is read, and its lines are spread by their hashes.
    """
    parted = steady(docs).select(row_number().alias("_row"), F.col(id_col).alias("_id"), F.col(site_col).cast("string").alias("_site"), F.split(whole_text(text_col), "\n", -1).alias("_lines"))
    lines = written(_lines(parted), "lines")
    removed = hot_join(lines, boilerplate(lines, least_sites), ["h1", "h2"], "n", "left_semi").groupBy("_row").agg(F.array_sort(F.collect_list("at")).alias("_at"))
    places = F.coalesce("_at", F.array().cast("array<int>"))
    return parted.join(removed, "_row", "left").select(
        F.col("_id").alias(id_col),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(places).cast("long").alias("n_removed"),
        F.when(F.col("_at").isNull(), F.array_join("_lines", "\n")).otherwise(F.array_join(_without(F.col("_lines"), places), "\n")).alias("text"),
    )
