"""Hot keys: what is joined is right, and no task has all of a key."""

import random
from pathlib import Path

import duckdb
import pytest
from oracle import expected, got
from pyspark.sql import functions as F

from loomspark import queries
from loomspark.operators import cohort, components, encode, enrich, missingness, skew, windows


@pytest.fixture
def hot(spark):
    """20,000 rows of which a third has one key, some none; and facts of most keys."""
    k = F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 4001)
    rows = spark.range(20_000, numPartitions=8).select("id", k.alias("k"))
    facts = rows.where("k is not null and k % 7 <> 5").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    return rows, facts


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_hot_join_is_the_join(hot, how):
    rows, facts = hot
    want = rows.join(facts, "k", how).select("id", "k", *([] if how == "left_semi" else ["n", "top"]))
    out = skew.hot_join(rows, facts, ["k"], "n", how)
    assert out.columns == want.columns and sorted(map(str, out.collect())) == sorted(map(str, want.collect()))


def test_rows_of_a_hot_key_are_not_gathered(spark, hot):
    rows, facts = hot
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    for k, v in zip(kept, ("-1", "false", "16")):
        spark.conf.set(k, v)
    try:
        most = lambda df: df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert most(rows.join(facts, "k")) > 6000 > 2500 > most(skew.hot_join(rows, facts, ["k"], "n"))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + k) for k in range(1, 80)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(5, 5), (None, 3)]
    got_ = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in pairs:
        if u is not None and u != v:
            a, b = sorted((find(u), find(v)))
            parent[b] = a
    assert got_ == {x: find(x) for x in list(parent)}


def test_a_long_chain_of_groups_is_one_unit(spark):
    rows = [(f"g{k:03d}", f"p{k + j:03d}") for k in range(300) for j in (0, 1)] + [("alone", None), (None, None)]
    units = cohort.grouping_units(spark.createDataFrame(rows, "g string, p string"), "g", "p").select("g", "_unit").distinct().collect()
    of = {r["g"]: r["_unit"] for r in units}
    assert of["alone"] == "alone" and of[None] == "(missing)"
    assert {of[f"g{k:03d}"] for k in range(300)} == {"+".join(f"g{k:03d}" for k in range(300))}


def test_rows_without_a_key_are_spread(spark):
    """A look-up of which most rows have no key, on text and on whole numbers."""
    rows = spark.range(4000).select("id", F.when(F.col("id") % 4 == 0, F.col("id") % 50).alias("k"))
    facts = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    for k, v in zip(kept, ("-1", "false", "16")):
        spark.conf.set(k, v)
    try:
        for left, right in ((rows, facts), (rows.withColumn("k", F.col("k").cast("string")), facts)):
            out = enrich.lookup_join(left, right, "k")
            sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 4000 and max(sizes) < 1000
            assert out.columns == ["id", "k", "x"] and out.where("x = 2 * cast(k as bigint)").count() == out.where("x is not null").count() == out.where("k < 40").count()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


@pytest.fixture
def few_samples(spark):
    """Many ranges, their bounds drawn from few rows, and merged by what the rows of a plan weigh, as in large tables."""
    adaptive = "spark.sql.adaptive."
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.execution.rangeExchange.sampleSizePerPartition", f"{adaptive}advisoryPartitionSizeInBytes", f"{adaptive}coalescePartitions.minPartitionSize", f"{adaptive}coalescePartitions.parallelismFirst")}
    for k, v in zip(kept, ("40", "2", "64k", "8k", "false")):
        spark.conf.set(k, v)
    yield spark.range(30_000, numPartitions=8).select("id", F.when(F.col("id") % 10 > 0, F.col("id") * 7919 % 1009).alias("at"), F.sha2(F.col("id").cast("string"), 512).alias("more"), F.lit(None).alias("nothing"))
    for k, v in kept.items():
        spark.conf.set(k, v)


def _in_order(rows):
    return sorted(rows, key=lambda r: (r["at"] is None, r["at"] or 0, r["id"]))


def test_blocks_of_many_ranges(few_samples):
    folded = encode.folds(few_samples, 5, order="at", id_column="id")
    assert [r["_fold"] for r in _in_order(folded.collect())] == [k // 6000 for k in range(30_000)]


def test_totals_of_many_ranges(few_samples):
    rows = windows.running_total(few_samples.select("id", "more", (F.col("id") % 5).alias("n")), "id", "n", "before").orderBy("id").collect()
    assert [r["before"] for r in rows] == [sum(range(5)) * (i // 5) + sum(range(i % 5)) for i in range(30_000)]


def test_groups_of_many_ranges(few_samples):
    sizes = [r["count"] for r in encode.folds(few_samples.withColumn("g", F.col("id") % 9001), 5, groups="g").groupBy("_fold").count().collect()]
    assert len(sizes) == 5 and sum(sizes) == 30_000 and max(abs(n - 6000) for n in sizes) <= 8


def test_profile_of_many_ranges(few_samples):
    row = missingness.profiles(few_samples.select("id", F.when(F.col("id") % 7 >= 2, 1).alias("a")), ["a"], "id", "id").first()
    assert (row["n"], row["missing"], row["runs"], row["leading"], row["longest"]) == (30_000, 8572, 4286, 2, 2)


def test_places_of_many_ranges(few_samples):
    rows = windows.ordered(few_samples, "at", "id").collect()
    assert [r["_seq"] for r in _in_order(rows)] == list(range(1, 30_001)) and rows[0]["nothing"] is None


@pytest.fixture
def many_rows(tmp_path):
    """Orders and events six times, with shifted keys; the other tables as they are."""
    repeated = {"orders": {"o_orderkey": 15_000, "o_custkey": 1500}, "events": {"event_id": 10_000, "user_id": 150}}
    for f in Path("/root/testdata/sf0.01").glob("*.parquet"):
        if keys := repeated.get(f.stem):
            shifted = ", ".join(f"{c} + {n} * r AS {c}" for c, n in keys.items())
            duckdb.execute(f"COPY (SELECT * EXCLUDE (r) REPLACE ({shifted}) FROM '{f}', range(6) AS t(r)) TO '{tmp_path / f.name}' (FORMAT parquet)")
        else:
            (tmp_path / f.name).symlink_to(f)
    return str(tmp_path)


@pytest.mark.parametrize("name", ["grouped_folds", "missing_profile_runs_test", "ordered_places"])
def test_query_of_many_ranges_matches_sql(spark, few_samples, many_rows, name):
    assert got(queries.QUERIES[name](spark, many_rows)) == expected(queries.ORACLE_SQL[name], many_rows)


def test_no_plan_of_linked_groups_has_a_whole_round(spark, monkeypatch):
    joins, written = [], components.written

    def counted(df, label):
        joins.append(str(df._jdf.queryExecution().optimizedPlan()).count("Join "))
        return written(df, label)

    monkeypatch.setattr(components, "written", counted)
    root = {r["node"]: r["root"] for r in components.components(spark.createDataFrame([(i, i + 1) for i in range(30)], "u long, v long")).collect()}
    assert set(root.values()) == {0} and len(root) == 31 and max(joins) <= 3
