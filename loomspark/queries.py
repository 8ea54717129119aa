"""The engine's operators as queries over the driver's tables, each with the SQL that says the same.

Missing cells are made alike in both: the tables have none. Floats are rounded on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import exprs as E
from .operators import clean, cohort, correlation, corrections, decorrelate, derive, encode, enrich, merge, missingness, screening, shifts, similarity, windows
from .operators.vocabulary import Vocabulary

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def registered(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return registered


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def r(x, digits: int = 6):
    return F.round(x, digits) + F.lit(0.0)


# --- joins ---------------------------------------------------------------------------------------------------------


@query("""
WITH o AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'),
n AS (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, c_mktsegment, n_name, round(o_totalprice / nullif(n_lines, 0), 6) AS price_per_line
FROM o LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN n ON l_orderkey = o_orderkey
""")
def lookup_join_m1(spark, sf):
    """Guarded many-to-one joins and a derived ratio."""
    orders = table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice")
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    df = enrich.lookup_join(orders, table(spark, sf, "customer"), "o_custkey", "c_custkey", "customers", columns=["c_mktsegment", "c_nationkey"])
    df = enrich.lookup_join(df, table(spark, sf, "nation"), "c_nationkey", "n_nationkey", "nations", columns=["n_name"])
    df = enrich.lookup_join(df, lines, "o_orderkey", "l_orderkey", "lines")
    return df.select("o_orderkey", "c_mktsegment", "n_name", r(E.safe_div("o_totalprice", "n_lines")).alias("price_per_line"))


@query("""
SELECT p_partkey, p_brand FROM part
WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45 AND l_partkey IS NOT NULL)
""")
def anti_join_unused(spark, sf):
    used = table(spark, sf, "lineitem").where("l_quantity > 45")
    return enrich.unused(table(spark, sf, "part"), used, "p_partkey", "l_partkey").select("p_partkey", "p_brand")


@query("""
WITH m AS (SELECT upper(n_name) AS k, n_name || '/' || n_regionkey AS v, 0 AS f, n_nationkey AS i FROM nation
           UNION ALL SELECT upper(n_name), 'late ' || n_nationkey, 1, n_nationkey FROM nation WHERE n_nationkey % 5 = 0),
w AS (SELECT k, arg_max(v, f * 1000 + i) AS v FROM m GROUP BY k),
c AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'zz' || c_nationkey ELSE n_name END AS code
      FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, coalesce(v, upper(trim(code))) AS code FROM c LEFT JOIN w ON upper(trim(code)) = k
""")
def mapping_keep_last(spark, sf):
    """A code is expanded by several mappings, of which later ones win; unknown codes stay."""
    nation = table(spark, sf, "nation")
    a = nation.select(F.col("n_name").alias("k"), F.concat("n_name", F.lit("/"), "n_regionkey").alias("v"), F.col("n_nationkey").alias("i"))
    b = nation.where("n_nationkey % 5 = 0").select(F.col("n_name").alias("k"), F.concat(F.lit("late "), "n_nationkey").alias("v"), F.col("n_nationkey").alias("i"))
    mapping = enrich.last_wins([a, b], "k", "v", "i")
    rows = enrich.lookup_join(table(spark, sf, "customer"), nation, "c_nationkey", "n_nationkey", columns=["n_name"])
    rows = rows.select("c_custkey", F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("zz"), "c_nationkey")).otherwise(F.col("n_name")).alias("code"))
    return enrich.expand(rows, "code", mapping)[0]


@query("""
SELECT CAST(s AS VARCHAR) AS supplier_group, round(100.0 * count(l_partkey) / count(*), 1) AS matched_pct FROM (
  SELECT s_suppkey % 4 AS s, p.l_partkey FROM supplier LEFT JOIN (SELECT DISTINCT l_suppkey, 1 AS l_partkey FROM lineitem WHERE l_quantity > 49) p ON l_suppkey = s_suppkey) GROUP BY s
""")
def join_coverage(spark, sf):
    """Share of rows that a join has found a match for."""
    used = table(spark, sf, "lineitem").where("l_quantity > 49").select("l_suppkey", F.lit(1).alias("witness")).distinct()
    df = enrich.lookup_join(table(spark, sf, "supplier"), used, "s_suppkey", "l_suppkey")
    return df.groupBy((F.col("s_suppkey") % 4).cast("string").alias("supplier_group")).agg(F.round(100 * F.count("witness") / F.count(F.lit(1)), 1).alias("matched_pct"))


@query("""
SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 AND n_name = (SELECT n_name FROM nation WHERE n_nationkey = 2) THEN 'Joined' ELSE n_name END AS country
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def harmonise_values(spark, sf):
    df = enrich.lookup_join(table(spark, sf, "customer"), table(spark, sf, "nation"), "c_nationkey", "n_nationkey", columns=["n_name"])
    name = table(spark, sf, "nation").where("n_nationkey = 2").select("n_name").first()[0]
    return enrich.harmonised(df.withColumnRenamed("n_name", "country"), "country", {name: "Joined"}, F.col("c_nationkey") % 2 == 0).select("c_custkey", "country")


# --- cleaning ------------------------------------------------------------------------------------------------------


@query("""
WITH t AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 5 WHEN 0 THEN '<' || CAST(CAST(l_quantity AS INT) AS VARCHAR)
  WHEN 1 THEN '> ' || replace(CAST(CAST(l_quantity AS INT) AS VARCHAR), '.', ',') || ',5' WHEN 2 THEN 'not measured' WHEN 3 THEN NULL ELSE ' ' || CAST(CAST(l_quantity AS INT) AS VARCHAR) || '.25 ' END AS x FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN regexp_full_match(x, '\\s*[<>]\\s*-?\\d+([.,]\\d+)?\\s*') THEN CAST(replace(regexp_extract(x, '[<>]\\s*([0-9.,]+)', 1), ',', '.') AS DOUBLE) / 2
  ELSE TRY_CAST(trim(x) AS DOUBLE) END AS value,
  CASE WHEN x IS NULL THEN NULL ELSE CAST(x LIKE '%<%' OR x LIKE '%>%' AS INT) END AS censored FROM t
""".replace("\\\\", "\\"))
def coerce_numeric_censored(spark, sf):
    q, k = F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber") % 5
    x = F.when(k == 0, F.concat(F.lit("<"), q)).when(k == 1, F.concat(F.lit("> "), q, F.lit(",5"))).when(k == 2, "not measured").when(k == 3, F.lit(None)).otherwise(F.concat(F.lit(" "), q, F.lit(".25 ")))
    t = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", x.alias("x"))
    return t.select("l_orderkey", "l_linenumber", E.censored_number("x", "half").alias("value"), E.is_censored("x").cast("int").alias("censored"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderkey % 30 AS DOUBLE) * 60 + o_orderkey % 60
  WHEN 1 THEN round((o_orderkey % 30) * 60 + o_orderkey % 60 + (o_orderkey % 50) / 60.0, 6) WHEN 2 THEN (o_orderkey % 90) + 0.5 ELSE NULL END AS minutes FROM orders
""")
def coerce_duration(spark, sf):
    k, two = F.col("o_orderkey"), lambda x: F.lpad(x.cast("string"), 2, "0")
    h, m, s = (k % 30).cast("string"), two(k % 60), two(k % 50)
    x = F.when(k % 4 == 0, F.concat_ws(":", h, m)).when(k % 4 == 1, F.concat_ws(":", h, m, s)).when(k % 4 == 2, F.concat((k % 90).cast("string"), F.lit(",5"))).otherwise("soon")
    return table(spark, sf, "orders").select("o_orderkey", F.round(E.duration_minutes(x), 6).alias("minutes"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN date_trunc('day', o_orderdate) WHEN 1 THEN date_trunc('second', o_orderdate) + to_milliseconds(500)
  WHEN 2 THEN TIMESTAMP '1900-01-01 00:00:00' + to_minutes(8 * 60 + o_orderkey % 60) ELSE NULL END AS at FROM orders
""".replace(" AS at ", " AS happened "))
def coerce_datetime(spark, sf):
    k, t = F.col("o_orderkey"), F.col("o_orderdate")
    x = F.when(k % 4 == 0, F.date_format(t, "yyyy-MM-dd")).when(k % 4 == 1, F.concat(F.date_format(t, "yyyy-MM-dd HH:mm:ss"), F.lit(".5"))).when(k % 4 == 2, F.concat(F.lit("8:"), F.lpad((k % 60).cast("string"), 2, "0"))).otherwise("tomorrow")
    return table(spark, sf, "orders").select("o_orderkey", E.moment(x).alias("happened"))


@query("SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS VARCHAR) || ':' || l_returnflag AS right_side FROM lineitem WHERE l_linenumber < 3 UNION ALL SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_linenumber >= 3")
def ratio_right(spark, sf):
    x = F.when(F.col("l_linenumber") < 3, F.concat(F.lit("1 : "), F.col("l_linenumber").cast("string"), F.lit(":"), "l_returnflag")).otherwise(F.col("l_returnflag"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", E.ratio_right(x).alias("right_side"))


@query("SELECT l_orderkey, l_linenumber, round(CASE WHEN l_linenumber % 2 = 0 THEN l_discount ELSE l_extendedprice END, 6) AS value FROM lineitem")
def eu_number(spark, sf):
    x = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.replace(F.format_string("%.6f", F.col("l_discount") * 100), F.lit("."), F.lit(",")), F.lit("%"))).otherwise(F.replace(F.format_string("%.6f", F.col("l_extendedprice")), F.lit("."), F.lit(",")))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", r(E.european_number(x)).alias("value"))


@query("SELECT o_orderkey, nullif(trim(o_orderpriority), '') AS stripped FROM orders WHERE o_orderkey % 3 > 0 UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 3 = 0")
def strip_text(spark, sf):
    x = F.when(F.col("o_orderkey") % 3 > 0, F.concat(F.lit("\t  "), "o_orderpriority", F.lit("  \n"))).otherwise("   \t")
    return table(spark, sf, "orders").select("o_orderkey", E.strip(x).alias("stripped"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'fixed' ELSE replace(replace(o_orderpriority, '1-', ''), 'URGENT', 'FIRST') END AS o_orderpriority,
  CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'P' THEN 'part' ELSE o_orderstatus END AS o_orderstatus, round(o_totalprice / 1000, 6) AS o_totalprice FROM orders
""")
def corrections_rules(spark, sf):
    rules = corrections.from_rows([
        {"Name": "cut", "Column": "o_orderpriority", "Action": "replace_text", "Old": "1-", "New": ""}, {"Name": "cut", "Column": "o_orderpriority", "Action": "replace_text", "Old": "URGENT", "New": "FIRST"},
        {"Name": "open", "Column": "o_orderpriority", "Action": "set", "New": "fixed", "When column": "o_orderstatus", "When equals": "O"},
        {"Name": "names", "Column": "o_orderstatus", "Action": "replace_values", "Old": "F", "New": "done"}, {"Name": "names", "Column": "o_orderstatus", "Action": "replace_values", "Old": "P", "New": "part"},
        {"Name": "unit", "Column": "o_totalprice", "Action": "divide_by", "New": "1000"}])
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    df = corrections.apply(df, rules, corrections.INTEGRITY, count=False)[0]
    return corrections.apply(df, rules, corrections.SCALE, count=False)[0].withColumn("o_totalprice", r("o_totalprice"))


@query("SELECT 'corrected' AS what, CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS cells FROM orders")
def corrections_audit(spark, sf):
    rules = [corrections.Rule("f", "o_orderstatus", "replace_values", pairs=(("F", "done"),))]
    out = corrections.apply(table(spark, sf, "orders"), rules, corrections.INTEGRITY)[1]
    return spark.createDataFrame([("corrected", out[0].rows)], "what string, cells long")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'N' WHEN o_orderkey % 2 = 0 THEN 'Y' ELSE 'N' END AS done FROM orders")
def yes_no_fill(spark, sf):
    k = F.col("o_orderkey")
    df = table(spark, sf, "orders").select("o_orderkey", F.when(k % 5 == 0, F.lit(None)).when(k % 2 == 0, "Y").otherwise("N").alias("done"))
    return clean.clean(df, {"done": "categorical"}, options=clean.Options(yes_no_defaults={"done": "No"}))[0]


@query("SELECT 'Tax (%)' AS parameter, CAST(count(*) FILTER (l_tax * 2000 > 100) AS BIGINT) AS outside FROM lineitem")
def pct_out_of_range(spark, sf):
    df = table(spark, sf, "lineitem").select((F.col("l_tax") * 2000).alias("Tax (%)"))
    report = clean.clean(df, {"Tax (%)": "numeric"})[1]
    return spark.createDataFrame([("Tax (%)", report.out_of_percent.get("Tax (%)", 0))], "parameter string, outside long")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0.0 WHEN o_orderkey % 3 = 1 THEN 1.0 ELSE NULL END AS seen FROM orders")
def yes_no_number(spark, sf):
    k = F.col("o_orderkey")
    x = F.when(k % 3 == 0, " No clumps ").when(k % 3 == 1, "few small")
    return table(spark, sf, "orders").select("o_orderkey", E.yes_no(x).alias("seen"))


@query("""
SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN 1 WHEN 3 THEN NULL ELSE 0 END AS below, CASE WHEN l_linenumber % 4 = 0 THEN CAST(CAST(l_quantity AS INT) AS DOUBLE) + 0.5 END AS bound FROM lineitem
""")
def below_quantification(spark, sf):
    """Values given as below a limit, and the limit."""
    q, k = F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber") % 4
    x = F.when(k == 0, F.concat(F.lit(" < "), q, F.lit(",5"))).when(k == 1, q).when(k == 2, F.concat(F.lit("> "), q))
    t = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", x.alias("x"))
    return t.select("l_orderkey", "l_linenumber", E.below_limit("x").alias("below"), E.limit_of("x").alias("bound"))


@query("""
SELECT event_id, CAST(date_part('hour', ts) * 3600 + date_part('minute', ts) * 60 + date_part('second', ts) AS INT) AS clock, round((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 6e7, 4) AS waited FROM events
""")
def minutes_and_clock(spark, sf):
    """Seconds of the day, and minutes between two times."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return table(spark, sf, "events").select("event_id", E.seconds_of_day(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("clock"), F.round(E.minutes_between("ts", start), 4).alias("waited"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN upper(substr(c_mktsegment, 1, 3)) ELSE 'X-' || c_custkey END AS place FROM customer
""")
def patient_site(spark, sf):
    """The site that an id with the patients' prefix names."""
    k = F.col("c_custkey")
    own = F.when(k % 3 == 0, F.concat(F.lit("P-"), F.upper(F.substring("c_mktsegment", 1, 3)), F.lit("-"), k.cast("string"))).otherwise(F.concat(F.lit("X-"), k.cast("string")))
    return table(spark, sf, "customer").select("c_custkey", enrich.site_of_patient(own, "P-").alias("place"))


@query("SELECT s_suppkey AS \"Lot\", s_name AS \"Name\", s_acctbal AS \"Name_1\", s_nationkey AS \"Site\" FROM supplier")
def mapped_renames(spark, sf):
    """Two source columns that the mapping gives one name: the later one is numbered."""
    df = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal", F.col("s_nationkey").alias("Site"))
    return df.toDF(*merge.renamed(df.columns, {"s_suppkey": "Lot", "s_name": "Name", "s_acctbal": "Name"}))


# --- rows ----------------------------------------------------------------------------------------------------------

_PIVOT = """WITH p AS (SELECT l_orderkey, max(l_quantity) FILTER (l_linenumber = 1) AS a, max(l_quantity) FILTER (l_linenumber = 2) AS b, max(l_quantity) FILTER (l_linenumber = 3) AS c FROM lineitem GROUP BY l_orderkey)"""


def _pivot(spark, sf):
    at = lambda k: F.max(F.when(F.col("l_linenumber") == k, F.col("l_quantity")))
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(at(1).alias("a"), at(2).alias("b"), at(3).alias("c"))


@query(_PIVOT + """ SELECT l_orderkey, round(CASE WHEN coalesce(a, b, c) IS NULL THEN NULL ELSE coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0) END, 6) AS total,
 round((coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0)) / nullif((a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT, 0), 6) AS mean,
 greatest(a, b, c) AS highest, least(a, b, c) AS lowest FROM p""")
def row_sum_min_count(spark, sf):
    xs = ["a", "b", "c"]
    return _pivot(spark, sf).select("l_orderkey", r(E.row_sum(xs)).alias("total"), r(E.row_mean(xs)).alias("mean"), E.row_greatest(xs).alias("highest"), E.row_least(xs).alias("lowest"))


@query(_PIVOT + """, u AS (SELECT l_orderkey, 6.0::DOUBLE AS d, a AS y FROM p WHERE a IS NOT NULL UNION ALL SELECT l_orderkey, 8.0, b FROM p WHERE b IS NOT NULL UNION ALL SELECT l_orderkey, 10.0, c FROM p WHERE c IS NOT NULL),
s AS (SELECT l_orderkey, CASE WHEN count(*) >= 2 THEN round(regr_slope(y, d), 6) + 0 END AS slope FROM u GROUP BY l_orderkey)
SELECT p.l_orderkey, slope FROM p LEFT JOIN s USING (l_orderkey)""")
def row_slope(spark, sf):
    return _pivot(spark, sf).select("l_orderkey", r(E.row_slope((6, 8, 10), ["a", "b", "c"])).alias("slope"))


@query(_PIVOT + """ SELECT l_orderkey, round(CASE WHEN a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL THEN a + b + b + c WHEN a IS NOT NULL AND b IS NOT NULL THEN a + b
 WHEN b IS NOT NULL AND c IS NOT NULL THEN b + c WHEN a IS NOT NULL AND c IS NOT NULL THEN (a + c) * 2 END, 6) AS area FROM p""")
def row_auc(spark, sf):
    return _pivot(spark, sf).select("l_orderkey", r(E.row_auc((6, 8, 10), ["a", "b", "c"])).alias("area"))


@query(_PIVOT + " SELECT l_orderkey, round(abs(a - b) / nullif(a + b, 0), 6) AS imbalance, round(log10(nullif(a, 0) / nullif(b, 0)), 6) + 0 AS log_ratio FROM p")
def imbalance(spark, sf):
    return _pivot(spark, sf).select("l_orderkey", r(E.safe_div(F.abs(F.col("a") - F.col("b")), F.col("a") + F.col("b"))).alias("imbalance"), r(E.log10(E.safe_div("a", "b"))).alias("log_ratio"))


@query("SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER (PARTITION BY c_mktsegment)) / nullif(stddev_pop(c_acctbal) OVER (PARTITION BY c_mktsegment), 0), 4) + 0 AS z FROM customer")
def zscore_by_site(spark, sf):
    df = derive.zscores(table(spark, sf, "customer"), {"z": "c_acctbal"}, ["c_mktsegment"])
    return df.select("c_custkey", r("z", 4).alias("z"))


@query("""
WITH t AS (SELECT o_orderkey, o_totalprice AS viable, o_orderkey % 100 AS cd3, o_custkey % 100 AS cd4 FROM orders)
SELECT o_orderkey, round(viable * cd3 / 100, 4) AS f_pt_cd3_cells, round(cd4 * cd3 / 100.0, 6) AS f_pt_cd4_share, round(cd4 * cd3 / 100.0 / 100 * viable, 6) AS f_pt_cd4_cells,
 CASE WHEN cd4 <= 40 THEN 'low' WHEN cd4 >= 60 THEN 'high' ELSE 'middle' END AS f_cd4_profile FROM t
""")
def derived_registry(spark, sf):
    """A part of the registry, levels and statuses included, over renamed columns."""
    df = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("viable"), (F.col("o_orderkey") % 100).alias("cd3"), (F.col("o_custkey") % 100).alias("cd4"))
    v, s = Vocabulary({"pt_viable_cells": "viable", "pt_cd3_pct": "cd3", "pt_cd4_pct": "cd4"}), derive.Settings()
    wanted = ["f_pt_cd3_cells", "f_pt_cd4_share", "f_pt_cd4_cells", "f_cd4_profile"]
    out, _ = derive.apply(df, derive.registry(s, df.columns, v), s, v, wanted)
    return out.select("o_orderkey", r("f_pt_cd3_cells", 4).alias("f_pt_cd3_cells"), r("f_pt_cd4_share").alias("f_pt_cd4_share"), r("f_pt_cd4_cells").alias("f_pt_cd4_cells"), "f_cd4_profile")


#: Made-up readings for keys of the registry: whole numbers from a start on, by a factor and a modulus of the order's key.
_READINGS = {
    "pt_viable_cells": (7, 900, 100), "pt_cd3_pct": (11, 90, 5), "pt_cd4_pct": (13, 80, 10), "pt_cd8_pct": (17, 70, 10), "pw_cd3_pct": (19, 90, 5), "pw_cd4_pct": (23, 80, 10), "pw_cd8_pct": (29, 70, 10),
    "vessel_count": (1, 3, 1), "vsvg_cells": (31, 1000, 1000), "cpdl": (37, 7, 1), "medium_unused": (1, 2, 0),
    **{f"d{d}_{w}_{x}": (41 + 2 * d + k, 20, 2) for d in (6, 8) for w in ("lactate", "glucose") for k, x in enumerate("ab")}, "harvest_lactate": (43, 20, 2), "harvest_glucose": (47, 20, 2),
    "d3_viability": (53, 30, 70), "pw_viability": (59, 30, 70), "harvest_viability": (61, 30, 70), "washed_viability": (67, 30, 70), "cells_available": (71, 500, 500), "cells_seeded_a": (73, 200, 50), "cells_seeded_b": (79, 200, 50), "culture_bags": (83, 4, 1),
    "vector_volume_a": (89, 50, 5), "vector_volume_b": (97, 50, 5), "coa_titer": (101, 40, 10), "coa_pi_ratio": (103, 9, 1), "contact_time": (107, 100, 80), "contact_time_a": (109, 100, 80), "contact_time_b": (113, 100, 80),
    "clumps_pre_count": (127, 30, 1), "clumps_post_count": (131, 30, 1), "clumps_pre_size": (137, 9, 1), "clumps_post_size": (139, 9, 1), "clumps_mix_count": (149, 30, 1), "clumps_mix_size": (151, 9, 1), "mixing_cycles": (157, 12, 1),
    "dose_per_kg": (163, 900000, 1000), "dose_cells": (167, 90000, 1000), "formulated_concentration": (173, 9000, 500), "bag_volume": (179, 60, 10), "harvest_car_pct": (181, 70, 10), "subject_weight": (191, 70, 40), "washed_cells": (193, 9000, 100), "fp_car_pct": (197, 70, 10), "vcn": (199, 5, 1),
    "formulated_viability": (211, 30, 70), "washed_concentration": (223, 900, 50), "formulation_cell_volume": (227, 40, 5), "formulation_medium_volume": (229, 40, 5), "harvest_cells": (233, 9000, 100),
    **{f"coa_impurity_{k}": (239 + 2 * k, 50, 1) for k in range(1, 6)}, "il2_activity_d6": (257, 30, 1), "il2_content_d6": (263, 30, 1), "il2_activity_d8": (269, 30, 1), "il2_content_d8": (271, 30, 1),
}
_CASE = "CASE WHEN vessel_count = 1 THEN {0} WHEN vessel_count = 2 THEN {0} + {1} END * 1e9 / vsvg_cells"
_SETTINGS = derive.Settings(moi_target=2.0, medium_glucose=25.0, medium_lactate=1.0, impurity_spec_limits=(10.0, 20.0, 30.0, 40.0, 50.0))
#: What the registry says, as SQL over the readings.
_FORMULAS = {
    "f_log_pt_cd4_cd8": "log10(pt_cd4_pct / pt_cd8_pct)", "f_log_pw_cd4_cd8": "log10(pw_cd4_pct / pw_cd8_pct)", "f_cd4_cd8_shift": "log10(pt_cd4_pct / pt_cd8_pct) - log10(pw_cd4_pct / pw_cd8_pct)",
    "f_pt_cd3_cells": "pt_viable_cells * pt_cd3_pct / 100", "f_pt_cd4_share": "pt_cd4_pct * pt_cd3_pct / 100", "f_pt_cd4_cells": "pt_cd4_pct * pt_cd3_pct * pt_viable_cells / 10000", "f_pw_cd4_share": "pw_cd4_pct * pw_cd3_pct / 100", "f_pw_cd8_share": "pw_cd8_pct * pw_cd3_pct / 100",
    **{f"f_{w}_per_cell_d{d}": _CASE.format(f"d{d}_{w}_a", f"d{d}_{w}_b") for d in (6, 8) for w in ("lactate", "glucose")}, **{f"f_{w}_per_cell_d10": f"harvest_{w} * 1e9 * vessel_count / vsvg_cells" for w in ("lactate", "glucose")},
    "f_lactate_yield_d6": "((d6_lactate_a + d6_lactate_b) / 2 - 1) / CASE WHEN 25 - (d6_glucose_a + d6_glucose_b) / 2 > 0 THEN 25 - (d6_glucose_a + d6_glucose_b) / 2 END", "f_lactate_yield_d10": "(harvest_lactate - 1) / CASE WHEN 25 - harvest_glucose > 0 THEN 25 - harvest_glucose END",
    "f_viability_drop_pts": "d3_viability - pw_viability", "f_viability_d3_d10_rel": "(1 - harvest_viability / d3_viability) * 100", "f_viability_d3_d10_pts": "washed_viability - d3_viability", "f_viability_wash": "(washed_viability / harvest_viability - 1) * 100",
    "f_seeding_pct": "vsvg_cells / (vessel_count * 5e7) * 100", "f_seeding_error": "abs(vsvg_cells / (vessel_count * 5e7) * 100 - 100)", "f_seeding_within": "CAST(abs(vsvg_cells / (vessel_count * 5e7) * 100 - 100) <= 5 AS DOUBLE)", "f_seeding_loss": "1 - (cells_seeded_a + cells_seeded_b) / cells_available", "f_dead_cells_d3": "cells_available * (100 - d3_viability) / d3_viability", "f_cells_per_bag": "cells_available / culture_bags",
    "f_seeded_mean": "(cells_seeded_a + cells_seeded_b) / 2", "f_seeded_imbalance": "abs(cells_seeded_a - cells_seeded_b) / (cells_seeded_a + cells_seeded_b)", "f_vector_volume_mean": "(vector_volume_a + vector_volume_b) / 2", "f_vector_volume_imbalance": "abs(vector_volume_a - vector_volume_b) / (vector_volume_a + vector_volume_b)",
    "f_moi_a": "coa_titer * vector_volume_a / cells_seeded_a", "f_moi_b": "coa_titer * vector_volume_b / cells_seeded_b", "f_log_moi_a": "ln(1 + coa_titer * vector_volume_a / cells_seeded_a)", "f_log_moi_b": "ln(1 + coa_titer * vector_volume_b / cells_seeded_b)",
    "f_moi_pool": "coa_titer * (vector_volume_a + vector_volume_b) / cells_available", "f_log_moi_pool": "ln(1 + coa_titer * (vector_volume_a + vector_volume_b) / cells_available)", "f_moi_quality": "coa_titer * (vector_volume_a + vector_volume_b) / cells_available * coa_pi_ratio", "f_moi_vs_target": "coa_titer * (vector_volume_a + vector_volume_b) / cells_available / 2", "f_moi_per_cd3": "coa_titer * (vector_volume_a + vector_volume_b) / (pt_viable_cells * pt_cd3_pct / 100)",
    **{f"f_contact_deviation{x}": f"abs(contact_time{x} - 120)" for x in ("", "_a", "_b")}, **{f"f_contact_within{x}": f"CAST(contact_time{x} BETWEEN 90 AND 150 AS DOUBLE)" for x in ("", "_a", "_b")},
    **{f"f_clump_{x}_reduction": f"1 - clumps_post_{x} / clumps_pre_{x}" for x in ("count", "size")}, **{f"f_clump_burden_{x}": f"clumps_{x}_count * clumps_{x}_size" for x in ("pre", "post", "mix")}, "f_mixing_x_clumps": "mixing_cycles * clumps_pre_count",
    "f_dose_all": "dose_per_kg / 1e6", "f_post_formulation_dose": "formulated_concentration / 1e6 * bag_volume * harvest_car_pct / 100 / subject_weight", "f_achievable_dose": "harvest_car_pct / 100 * washed_cells / (subject_weight * 1e6)", "f_car_cells": "harvest_car_pct * washed_cells / 100", "f_car_yield": "harvest_car_pct / 100 * pow(2, cpdl)", "f_vcn_per_cell": "fp_car_pct * vcn / 100", "f_flow_accuracy": "fp_car_pct / harvest_car_pct",
    "f_formulated_total_concentration": "formulated_concentration / 10000 / formulated_viability", "f_cells_into_formulation": "washed_concentration * formulation_cell_volume", "f_cells_out_of_formulation": "formulated_concentration * formulation_medium_volume", "f_cells_lost_formulation": "washed_concentration * formulation_cell_volume - formulated_concentration * formulation_medium_volume", "f_pct_lost_formulation": "(washed_concentration * formulation_cell_volume - formulated_concentration * formulation_medium_volume) * 100 / (washed_concentration * formulation_cell_volume)", "f_cells_lost_wash": "harvest_cells - washed_cells", "f_wash_recovery": "washed_cells / harvest_cells",
    "f_coa_impurity_spec_index": " + ".join(f"coa_impurity_{k} / {10 * k}" for k in range(1, 6)), "f_il2_d6": "il2_activity_d6 * il2_content_d6 / 1000", "f_il2_d8": "il2_activity_d8 * il2_content_d8 / 1000",
}
#: Digits where five would leave ties.
_DIGITS = {"f_post_formulation_dose": 12, "f_achievable_dose": 12, "f_dose_all": 6, "f_seeding_pct": 6, "f_seeding_error": 6, "f_formulated_total_concentration": 12}
_READ = ", ".join(f"CAST((o_orderkey * {f}) % {m} + {start} AS DOUBLE) AS {key}" for key, (f, m, start) in _READINGS.items())


@query(f"WITH t AS (SELECT o_orderkey, {_READ} FROM orders) SELECT o_orderkey, " + ", ".join(f"round({x}, {_DIGITS.get(key, 5)}) + 0 AS {key}" for key, x in _FORMULAS.items()) + " FROM t")
def derived_registry_wide(spark, sf):
    """Most of the registry's numbers, of several levels, by their keys' own names."""
    df = table(spark, sf, "orders").selectExpr("o_orderkey", *_READ.split(", "))
    out, _ = derive.apply(df, derive.registry(_SETTINGS, df.columns), _SETTINGS, Vocabulary(), list(_FORMULAS))
    return out.select("o_orderkey", *(r(key, _DIGITS.get(key, 5)).alias(key) for key in _FORMULAS))


# --- sites ---------------------------------------------------------------------------------------------------------


@query("SELECT c_custkey AS k, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, 'A' AS \"Site Merged\" FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, 'B' FROM supplier")
def union_by_name_site(spark, sf):
    a = table(spark, sf, "customer").selectExpr("c_custkey k", "c_name name", "c_acctbal balance", "c_mktsegment segment")
    return merge.union_sites({"A": a, "B": table(spark, sf, "supplier").selectExpr("s_acctbal balance", "s_suppkey k", "s_name name")})


@query("SELECT l_orderkey, l_linenumber FROM lineitem")
def never_recorded(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_quantity") < 0, F.col("l_quantity")).alias("empty"))
    return merge.never_recorded(df, df.columns)[0]


@query("""
SELECT 'p_name' AS "column", p_name AS value, 'A' AS only_at, 'B' AS not_at FROM (SELECT DISTINCT p_name FROM part WHERE p_size % 2 = 0 EXCEPT SELECT DISTINCT p_name FROM part WHERE p_size % 2 = 1)
UNION ALL SELECT 'p_name', p_name, 'B', 'A' FROM (SELECT DISTINCT p_name FROM part WHERE p_size % 2 = 1 EXCEPT SELECT DISTINCT p_name FROM part WHERE p_size % 2 = 0)
""")
def category_diff(spark, sf):
    """Of two sites that share out all parts."""
    part = table(spark, sf, "part")
    return clean.category_differences({"A": part.where("p_size % 2 = 0"), "B": part.where("p_size % 2 = 1")}, ["p_name", "p_type"]).where(E.c("column") == "p_name")


@query("SELECT column_name AS parameter, CAST(present AS BIGINT) AS present, round(100.0 * (n - present) / n, 4) AS missing_pct, CAST(distinct_values AS BIGINT) AS distinct_values FROM (SELECT count(*) AS n, count(nullif(l_tax, 0)) AS present, count(DISTINCT nullif(l_tax, 0)) AS distinct_values, 'tax' AS column_name FROM lineitem UNION ALL SELECT count(*), count(nullif(l_discount, 0)), count(DISTINCT nullif(l_discount, 0)), 'discount' FROM lineitem)")
def quality_rows(spark, sf):
    """Present, missing and distinct values of each column, in one pass."""
    df = table(spark, sf, "lineitem").select(F.nullif("l_tax", F.lit(0.0)).alias("tax"), F.nullif("l_discount", F.lit(0.0)).alias("discount"))
    wide = df.agg(F.count(F.lit(1)).alias("n"), *(x for c in df.columns for x in (F.count(c).alias(f"p_{c}"), F.count_distinct(c).alias(f"d_{c}"))))
    return wide.select(F.explode(F.array(*(F.struct(F.lit(c).alias("parameter"), F.col(f"p_{c}").alias("present"), F.round(100.0 * (F.col("n") - F.col(f"p_{c}")) / F.col("n"), 4).alias("missing_pct"), F.col(f"d_{c}").alias("distinct_values")) for c in df.columns))).alias("x")).select("x.*")


# --- cohorts -------------------------------------------------------------------------------------------------------

_FILTERS = [cohort.Filter("o_orderstatus", "in", ("F", "O"), label="status"), cohort.Filter("o_totalprice", "min", 50000.0, label="price"), cohort.Filter("clerk", "not_equals", "3", missing="include", label="clerk")]


def _orders(spark, sf):
    return table(spark, sf, "orders").withColumn("clerk", F.when(F.col("o_custkey") % 11 != 0, (F.col("o_custkey") % 7).cast("string")))


@query("""
WITH t AS (SELECT *, CASE WHEN o_custkey % 11 <> 0 THEN CAST(o_custkey % 7 AS VARCHAR) END AS clerk FROM orders),
m AS (SELECT CASE WHEN NOT coalesce(o_orderstatus IN ('F', 'O'), false) THEN 0 WHEN NOT coalesce(o_totalprice >= 50000, false) THEN 1 WHEN NOT coalesce(clerk <> '3', true) THEN 2 WHEN NOT (o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '2000-12-31') THEN 3 ELSE 9 END AS k FROM t),
n AS (SELECT count(*) AS a, count(*) FILTER (k = 0) AS r0, count(*) FILTER (k = 1) AS r1, count(*) FILTER (k = 2) AS r2, count(*) FILTER (k = 3) AS r3 FROM m)
SELECT 0 AS step, a AS before, r0 AS removed FROM n UNION ALL SELECT 1, a - r0, r1 FROM n UNION ALL SELECT 2, a - r0 - r1, r2 FROM n UNION ALL SELECT 3, a - r0 - r1 - r2, r3 FROM n
""")
def cohort_funnel(spark, sf):
    steps = cohort.select(_orders(spark, sf), _FILTERS, ("o_orderdate", date(1996, 1, 1), date(2000, 12, 31)))[2]
    return spark.createDataFrame([(k, s.before, s.removed) for k, s in enumerate(steps)], "step int, before long, removed long")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_totalprice >= 50000 AND (o_custkey % 11 = 0 OR o_custkey % 7 <> 3)")
def cohort_select(spark, sf):
    return cohort.select(_orders(spark, sf), _FILTERS)[0].select("o_orderkey")


@query("SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01' THEN 0.0 WHEN o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-07-01' THEN 1.0 END AS y FROM orders")
def period_target(spark, sf):
    df = table(spark, sf, "orders")
    periods = [("before", date(1996, 1, 1), date(1996, 12, 31)), ("after", date(1998, 1, 1), date(1999, 6, 30))]
    return df.select("o_orderkey", cohort.period_target(df, "o_orderdate", periods, "after").alias("y"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1.0 WHEN o_orderstatus = 'O' THEN 0.0 END AS y FROM orders WHERE o_orderstatus IN ('F', 'O')")
def binary_target(spark, sf):
    df = table(spark, sf, "orders").withColumn("status", F.concat(F.lit(" "), F.lower("o_orderstatus"), F.lit("  ")))
    y = cohort.binary_target("status", ["f"], ["o"])
    return cohort.with_target(df, y, "status", binary=True)[0].select("o_orderkey", F.col(cohort.TARGET).alias("y"))


# --- encoders ------------------------------------------------------------------------------------------------------


def _priced(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    return enrich.lookup_join(orders, table(spark, sf, "customer"), "o_custkey", "c_custkey", columns=["c_mktsegment"], check=False)


@query("""
WITH o AS (SELECT o_totalprice, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey), p AS (SELECT avg(o_totalprice) AS prior FROM o)
SELECT c_mktsegment, round((sum(o_totalprice) + 10 * any_value(prior)) / (count(*) + 10), 4) AS mean FROM o, p GROUP BY c_mktsegment
""")
def target_encoding(spark, sf):
    df = _priced(spark, sf)
    state = encode.fit_target(df, "c_mktsegment", "o_totalprice", set())
    return df.select("c_mktsegment", *(x.alias("mean") for x in encode.applied(state).values())).groupBy("c_mktsegment").agg(r(F.max("mean"), 4).alias("mean"))


@query("""
WITH o AS (SELECT o_orderkey, o_totalprice AS y, o_orderpriority AS c, o_custkey % 5 AS f FROM orders),
t AS (SELECT c, f, sum(y) AS s, count(*) AS n FROM o GROUP BY c, f), g AS (SELECT f, sum(s) AS s, sum(n) AS n FROM t GROUP BY f),
pr AS (SELECT f, ((SELECT sum(s) FROM g) - s) / ((SELECT sum(n) FROM g) - n) AS prior FROM g),
w AS (SELECT c, sum(s) AS s, sum(n) AS n FROM t GROUP BY c)
SELECT o_orderkey, round((w.s - t.s + 10 * prior) / (w.n - t.n + 10), 3) AS mean FROM o JOIN t USING (c, f) JOIN w USING (c) JOIN pr USING (f)
""")
def target_encoding_crossfit(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", (F.col("o_custkey") % 5).alias("fold"))
    return encode.crossfitted(df, "o_orderpriority", "o_totalprice", "fold", "mean").select("o_orderkey", r("mean", 3).alias("mean"))


@query("""
WITH t AS (SELECT p_partkey, p_brand FROM part), k AS (SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) AS i FROM t GROUP BY p_brand)
SELECT p_partkey, CAST(i = 1 AS INT) AS first, CAST(i = 2 AS INT) AS second, CAST(i = 3 AS INT) AS third, CAST(i > 3 AS INT) AS other FROM t JOIN k USING (p_brand)
""")
def one_hot_topk(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_brand")
    state = encode.fit_one_hot(df, "p_brand", set(), encode.Knobs(top=3))
    return df.select("p_partkey", *(x.alias(n) for n, x in zip(("first", "second", "third", "other"), encode.applied(state).values())))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 5 THEN NULL WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS encoded FROM lineitem")
def binary_encode(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") != 5, F.col("l_linestatus")).alias("s"))
    state = encode.fit_binary(df, "s", set())
    return df.select("l_orderkey", "l_linenumber", *(x.alias("encoded") for x in encode.applied(state).values()))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS encoded FROM orders")
def ordinal_encode(spark, sf):
    state = encode.fit_ordinal("o_orderstatus", encode.parsed_order("[O, P]"), set())
    return table(spark, sf, "orders").select("o_orderkey", *(x.alias("encoded") for x in encode.applied(state).values()))


@query("""
WITH d AS (SELECT o_orderkey, md5('o_orderpriority' || chr(0) || o_orderpriority) AS h FROM orders), e AS (SELECT o_orderkey, CAST(('0x' || substr(h, 1, 16))::UBIGINT % 8 AS INT) AS bucket, CASE WHEN ('0x' || substr(h, 17, 2))::INT % 2 = 0 THEN 1 ELSE -1 END AS sign FROM d)
SELECT o_orderkey, """ + ", ".join(f"CASE WHEN bucket = {k} THEN sign ELSE 0 END AS o_orderpriority_hash_{k}" for k in range(8)) + " FROM e")
def hash_encode(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    state = encode.fit_hashed(df, "o_orderpriority", set())
    return df.select("o_orderkey", *(x.alias(n) for n, x in encode.applied(state).items()))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN '(missing)' ELSE p_brand END AS label FROM part
""")
def label_view(spark, sf):
    """Categories as encoders see them, an empty cell being one."""
    cell = F.when(F.col("p_partkey") % 5 == 0, "  ").otherwise(F.concat(F.lit(" "), "p_brand", F.lit("\t")))
    return table(spark, sf, "part").select("p_partkey", encode.labels(cell, encode.Knobs(missing_is_category=True)).alias("label"))


@query("""
SELECT o_orderkey, least(4, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) * 5 // count(*) OVER ()) AS fold FROM orders
""")
def chronological_folds(spark, sf):
    df = encode.folds(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), 5, order="o_orderdate", id_column="o_orderkey")
    return df.select("o_orderkey", F.col("_fold").alias("fold"))


@query("""
WITH g AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey), t AS (SELECT count(*) AS rows FROM orders)
SELECT 'one fold a group' AS what, count(*) AS n FROM g UNION ALL SELECT 'rows', rows FROM t UNION ALL SELECT 'folds within one group of even', 5 FROM t
""")
def grouped_folds(spark, sf):
    df = encode.folds(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), 5, groups="o_custkey")
    largest = df.groupBy("o_custkey").count().agg(F.max("count").alias("most"))
    whole = df.groupBy("o_custkey").agg(F.count_distinct("_fold").alias("k")).agg(F.count_if(F.col("k") == 1).alias("n")).select(F.lit("one fold a group").alias("what"), "n")
    even = df.groupBy("_fold").count().join(F.broadcast(largest)).join(F.broadcast(df.agg((F.count(F.lit(1)) / 5).alias("share")))).agg(F.count_if(F.abs(F.col("count") - F.col("share")) <= 2 * F.col("most")).alias("n")).select(F.lit("folds within one group of even").alias("what"), "n")
    return whole.union(df.agg(F.count(F.lit(1)).alias("n")).select(F.lit("rows").alias("what"), "n")).union(even)


@query("SELECT CAST(p_partkey AS VARCHAR) AS parameter, CASE WHEN p_partkey % 2 = 0 THEN 'even; size ' || p_size % 3 ELSE 'size ' || p_size % 3 END AS groups FROM part")
def groups_of_parameters(spark, sf):
    """Groups that each parameter belongs to, joined."""
    part = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("parameter"), "p_partkey", "p_size")
    members = part.select("parameter", F.concat(F.lit("size "), (F.col("p_size") % 3).cast("string")).alias("group")).union(part.where("p_partkey % 2 = 0").select("parameter", F.lit("even")))
    return enrich.groups_of(members.union(members))


@query("""SELECT c AS parameter, CASE WHEN k <= 1 THEN 'skip' WHEN k = 2 THEN 'binary' WHEN k / n > 0.5 THEN 'skip' WHEN k <= 15 THEN 'one_hot' WHEN k <= 50 THEN 'target' ELSE 'hash' END AS encoder FROM (
 SELECT 'p_name' AS c, count(DISTINCT p_name) AS k, count(*) AS n FROM part UNION ALL SELECT 'p_brand', count(DISTINCT p_brand), count(*) FROM part UNION ALL SELECT 'p_type', count(DISTINCT p_type), count(*) FROM part)""")
def encoder_routing(spark, sf):
    found = encode.route(table(spark, sf, "part"), ["p_name", "p_brand", "p_type"])
    return spark.createDataFrame([(c, e) for c, (e, _) in found.items()], "parameter string, encoder string")


# --- profiles ------------------------------------------------------------------------------------------------------


@query("""
WITH o AS (SELECT row_number() OVER (ORDER BY ts, event_id) AS i, event_id % 7 < 2 AS a, event_type = 'click' AS b, ts < (SELECT min(ts) + (max(ts) - min(ts)) / 3 FROM events) AS c FROM events),
u AS (SELECT 'a' AS "column", i, a AS g FROM o UNION ALL SELECT 'b', i, b FROM o UNION ALL SELECT 'c', i, c FROM o),
l AS (SELECT *, lag(g) OVER (PARTITION BY "column" ORDER BY i) AS before, count(*) OVER (PARTITION BY "column") AS n FROM u),
m AS (SELECT *, sum((g AND NOT coalesce(before, false))::INT) OVER (PARTITION BY "column" ORDER BY i) AS run FROM l),
e AS (SELECT "column", run, count(*) AS length FROM m WHERE g GROUP BY "column", run), x AS (SELECT "column", max(length) AS longest FROM e GROUP BY "column"),
s AS (SELECT "column", any_value(n) AS n, count(*) FILTER (g) AS missing, count(*) FILTER (g AND NOT coalesce(before, false)) AS runs, min(i) FILTER (NOT g) - 1 AS "leading", any_value(n) - max(i) FILTER (NOT g) AS "trailing",
 count(*) FILTER (g AND before)::DOUBLE / count(*) FILTER (g AND i < n) AS repeat_share, count(*) FILTER (g AND i > n - 10) AS missing_last_10 FROM l GROUP BY "column"),
z AS (SELECT *, (runs - missing::DOUBLE * (n - missing + 1) / n) / sqrt(missing::DOUBLE * (missing - 1) * (n - missing) * (n - missing + 1) / (n::DOUBLE * n * (n - 1))) AS z FROM s JOIN x USING ("column"))
SELECT "column", n, missing, runs, "leading", "trailing", longest, round(z, 4) + 0 AS z, round(repeat_share, 6) AS repeat_share, missing_last_10,
 CASE WHEN z > 2.576 THEN 'Regular skipping' WHEN z >= -2.576 THEN 'Random gaps' WHEN "leading" >= missing * 0.8 THEN 'Late start' WHEN "trailing" >= missing * 0.8 THEN 'Stopped' WHEN "leading" + "trailing" >= missing * 0.8 THEN 'Late start and stopped' WHEN longest >= missing * 0.8 THEN 'One long gap' ELSE 'Clumped' END AS pattern FROM z
""")
def missing_profile_runs_test(spark, sf):
    events = table(spark, sf, "events")
    third = events.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).select((F.col("low") + (F.col("high") - F.col("low")) / 3).alias("third"))
    df = events.join(F.broadcast(third)).select("event_id", "ts", F.when(F.col("event_id") % 7 >= 2, 1).alias("a"), F.when(F.col("event_type") != "click", 1).alias("b"), F.when(F.col("ts") >= F.col("third"), 1).alias("c"))
    return missingness.profiles(df, ["a", "b", "c"], "ts", "event_id").select("column", "n", "missing", "runs", "leading", "trailing", "longest", r("z", 4).alias("z"), r("repeat_share").alias("repeat_share"), "missing_last_10", "pattern")


@query("""SELECT a, b, round(x, 6) AS similarity FROM (
 SELECT 'tax' AS a, 'disc' AS b, count(*) FILTER (l_tax = 0 AND l_discount = 0)::DOUBLE / nullif(count(*) FILTER (l_tax = 0 OR l_discount = 0), 0) AS x FROM lineitem
 UNION ALL SELECT 'tax', 'part', count(*) FILTER (l_tax = 0 AND l_partkey % 9 = 0)::DOUBLE / nullif(count(*) FILTER (l_tax = 0 OR l_partkey % 9 = 0), 0) FROM lineitem
 UNION ALL SELECT 'disc', 'part', count(*) FILTER (l_discount = 0 AND l_partkey % 9 = 0)::DOUBLE / nullif(count(*) FILTER (l_discount = 0 OR l_partkey % 9 = 0), 0) FROM lineitem)""")
def jaccard_pairs(spark, sf):
    names = ["tax", "disc", "part"]
    df = table(spark, sf, "lineitem").select(F.nullif("l_tax", F.lit(0.0)).alias("tax"), F.nullif("l_discount", F.lit(0.0)).alias("disc"), F.when(F.col("l_partkey") % 9 != 0, 1).alias("part"))
    s, _, _ = similarity.jaccard_of_missing(df, names)
    return spark.createDataFrame([(names[i], names[j], round(float(s[i, j]), 6)) for i in range(3) for j in range(i + 1, 3)], "a string, b string, similarity double")


@query("""
WITH t AS (SELECT l_returnflag AS c, (l_tax = 0)::INT AS m FROM lineitem), n AS (SELECT count(*)::DOUBLE AS n FROM t),
j AS (SELECT c, m, count(*) / any_value(n) AS p FROM t, n GROUP BY c, m), a AS (SELECT c, sum(p) AS p FROM j GROUP BY c), b AS (SELECT m, sum(p) AS p FROM j GROUP BY m)
SELECT 'l_returnflag' AS "column", round(((SELECT -sum(p * log2(p)) FROM a) + (SELECT -sum(p * log2(p)) FROM b) - (SELECT -sum(p * log2(p)) FROM j)) / (SELECT -sum(p * log2(p)) FROM b), 8) + 0 AS score
""")
def nmi_explainer(spark, sf):
    df = table(spark, sf, "lineitem").select("l_returnflag", F.nullif("l_tax", F.lit(0.0)).alias("tax"))
    rows = missingness.explained(df, ["tax"], ["l_returnflag"])
    return spark.createDataFrame([(x["column"], round(x["score"], 8) + 0.0) for x in rows], "column string, score double")


_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_PAIRS = [(a, b) for i, a in enumerate(_NUMBERS) for b in _NUMBERS[i + 1 :]]


@query(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, count(*) AS n, round(corr({a}, {b}), 6) + 0 AS r FROM lineitem WHERE {a} <> 0 AND {b} <> 0" for a, b in _PAIRS))
def pearson_pairs(spark, sf):
    df = table(spark, sf, "lineitem").select(*(F.nullif(c, F.lit(0.0)).alias(c) for c in _NUMBERS))
    p = similarity.pearson(df, _NUMBERS)
    return spark.createDataFrame([(a, b, int(p.n[_NUMBERS.index(a), _NUMBERS.index(b)]), round(p.of(a, b), 6) + 0.0) for a, b in _PAIRS], "a string, b string, n long, r double")


@query(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr(x, y), 6) + 0 AS rho FROM (SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS x, rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS y FROM lineitem)" for a, b in _PAIRS))
def spearman_pairs(spark, sf):
    df = table(spark, sf, "lineitem").select(*_NUMBERS)
    p = similarity.spearman(df, _NUMBERS, cells_in_task=1000)
    return spark.createDataFrame([(a, b, round(p.of(a, b), 6) + 0.0) for a, b in _PAIRS], "a string, b string, rho double")


@query("""
WITH p AS (SELECT p_partkey, (p_partkey % 97 + 1) / 100.0 AS p FROM part), k AS (SELECT *, row_number() OVER (ORDER BY p DESC, p_partkey) AS d, count(*) OVER () AS m FROM p)
SELECT p_partkey, round(least(1.0, min(p * m / (m - d + 1)) OVER (ORDER BY d)), 6) AS q FROM k
""")
def bh_adjust(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", ((F.col("p_partkey") % 97 + 1) / 100).alias("p"))
    return correlation.adjusted(p, "p", "q").select("p_partkey", r("q").alias("q"))


@query("""
WITH x AS (SELECT unnest(['flat', 'l_quantity', 'l_tax', 'jitter']) AS parameter, unnest([1.5, l_quantity, l_tax, 1000 + l_tax / 10]) AS v FROM lineitem)
SELECT parameter FROM x GROUP BY parameter HAVING count(DISTINCT round(v, 9)) < 2 OR stddev_samp(v) <= 1e-4 * avg(abs(v))
""")
def near_constant(spark, sf):
    df = table(spark, sf, "lineitem").select("l_quantity", "l_tax", F.lit(1.5).alias("flat"), (1000 + F.col("l_tax") / 10).alias("jitter"))
    return spark.createDataFrame([(c,) for c in encode.near_constant(df, df.columns)], "parameter string")


@query("""
WITH x AS (SELECT l_quantity AS quantity, l_quantity * 2 + 1 AS twice, l_tax AS tax, l_extendedprice AS price, l_extendedprice + l_tax AS total FROM lineitem)
SELECT 'twice' AS dropped, 'quantity' AS kept FROM x HAVING corr(quantity, twice) ^ 2 >= 0.99 UNION ALL SELECT 'total', 'price' FROM x HAVING corr(price, total) ^ 2 >= 0.99
UNION ALL SELECT 'tax', 'quantity' FROM x HAVING corr(quantity, tax) ^ 2 >= 0.99 UNION ALL SELECT 'quantity', 'price' FROM x HAVING corr(quantity, price) ^ 2 >= 0.99
""")
def duplicate_pairs(spark, sf):
    df = table(spark, sf, "lineitem").select(F.col("l_quantity").alias("quantity"), (F.col("l_quantity") * 2 + 1).alias("twice"), F.col("l_tax").alias("tax"), F.col("l_extendedprice").alias("price"), (F.col("l_extendedprice") + F.col("l_tax")).alias("total"))
    d = decorrelate.duplicates(similarity.pearson(df, df.columns))
    return spark.createDataFrame(list(d.items()), "dropped string, kept string")


@query("SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) + 0 AS intercept, round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem")
def residual_simple(spark, sf):
    fit = decorrelate.regression(table(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity"])
    return spark.createDataFrame([(round(fit["coefficients"][0], 4), round(fit["intercept"], 2) + 0.0, round(fit["r2"], 6))], "slope double, intercept double, r2 double")


@query("""
WITH s AS (SELECT avg(l_quantity) AS a, stddev_pop(l_quantity) AS sa, avg(l_extendedprice) AS b, stddev_pop(l_extendedprice) AS sb, CASE WHEN corr(l_quantity, l_extendedprice) < 0 THEN -1 ELSE 1 END AS sign FROM lineitem)
SELECT l_orderkey, l_linenumber, round(((l_quantity - a) / sa + sign * (l_extendedprice - b) / sb) / 2, 5) + 0 AS score FROM lineitem, s
""")
def group_score(spark, sf):
    df = table(spark, sf, "lineitem")
    names = ["l_quantity", "l_extendedprice"]
    fit = decorrelate.summary(df, names, names[0], similarity.pearson(df, names))
    return df.select("l_orderkey", "l_linenumber", r(decorrelate.score(fit), 5).alias("score"))


@query("SELECT l_orderkey, l_linenumber, coalesce(nullif(l_tax, 0), (SELECT median(nullif(l_tax, 0)) FROM lineitem)) AS tax, CAST(l_tax = 0 AS INT) AS tax_missing FROM lineitem")
def median_impute(spark, sf):
    """A recipe with indicators and medians, written as JSON and read back."""
    from .plans import recipe

    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.nullif("l_tax", F.lit(0.0)).alias("tax"), F.col("l_quantity").alias(cohort.TARGET))
    fitted = recipe.fit(df, ["tax"], recipe.Options(action="off", indicators=True, impute=True))
    return recipe.Recipe.loads(fitted.dumps()).transform(df, ["l_orderkey", "l_linenumber"])


# --- over time -----------------------------------------------------------------------------------------------------

_DAYS = "SELECT DISTINCT user_id % 6 AS s, datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS d, (datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 4) * 10 + user_id % 2 AS v FROM events"
_GROUPS = f"""
WITH p AS ({_DAYS}), days AS (SELECT s, d, lag(d) OVER (PARTITION BY s ORDER BY d) AS before FROM (SELECT DISTINCT s, d FROM p)),
h AS (SELECT s, v, d, lag(d) OVER (PARTITION BY s, v ORDER BY d) AS held FROM p),
c AS (SELECT s, count(DISTINCT d) AS n FROM h JOIN days USING (s, d) WHERE held = before GROUP BY s)
SELECT s, count(*) - coalesce(any_value(n), 0) AS groups FROM p LEFT JOIN c USING (s) GROUP BY s
"""


def _daily(events):
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    return events.select((F.col("user_id") % 6).alias("s"), day.alias("d"), (F.floor(day / 4) * 10 + F.col("user_id") % 2).alias("v"))


@query(_GROUPS)
def shift_counts(spark, sf):
    return shifts.group_count(_daily(table(spark, sf, "events")), ["s"], "d", "v")


#: Lots of four days, of which one is on each day: a lot's segment is the days on which it is the day's lot.
_LOTS = """
WITH p AS (SELECT DISTINCT user_id % 6 AS s, datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS d FROM events), l AS (SELECT s, d, CAST((d // 4) % 3 AS VARCHAR) AS v FROM p),
b AS (SELECT *, v IS DISTINCT FROM lag(v) OVER (PARTITION BY s ORDER BY d) AS starts FROM l), r AS (SELECT *, sum(starts::INT) OVER (PARTITION BY s ORDER BY d) AS run FROM b)
SELECT CAST(s AS VARCHAR) AS key, CAST(min(d) AS BIGINT) AS first, CAST(max(d) AS BIGINT) AS last, any_value(v) AS value FROM r GROUP BY s, run
"""


@query(_LOTS)
def shift_lots(spark, sf):
    """Segments of a series with one value a day, where SQL can tell them."""
    days = _daily(table(spark, sf, "events")).select("s", "d", (F.floor(F.col("d") / 4) % 3).alias("v"))
    return shifts.segment_rows(days, "s", "d", "v")


@query()
def shift_segments(spark, sf):
    """Several values a day, which carry on by rule: tests hold it against plain Python."""
    return shifts.segment_rows(_daily(table(spark, sf, "events")), "s", "d", "v")


@query()
def shift_tests(spark, sf):
    """Permutation tests; tests hold them against plain Python."""
    df = table(spark, sf, "events").select("ts", (F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) / 5).cast("int").alias("lot"), F.col("event_type").alias("kind"), (F.col("user_id") % 2).alias("plant"))
    return shifts.tested(df, ["lot", "kind"], "ts", "plant").select("plant", "column", "values", "days", "groups", F.round("p", 6).alias("p"), "kept")


@query("""
WITH x AS (SELECT conv_id, turn, unnest(CASE WHEN turn % 3 = 0 THEN ['A', 'B'] WHEN turn % 3 = 1 THEN ['A'] ELSE ['B'] END) AS site, CASE WHEN turn % 2 = 0 THEN 'exclude' ELSE 'reinstate' END AS action FROM conversations)
SELECT CAST(conv_id AS VARCHAR) AS parameter, site, arg_max(action, turn) AS action FROM x GROUP BY conv_id, site
""")
def decision_replay(spark, sf):
    """The state of an append-only log: the last row for each parameter and site stands, rows for all count at each."""
    turn = F.col("turn")
    log = table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("parameter"), F.when(turn % 3 == 0, "all").when(turn % 3 == 1, "A").otherwise("B").alias("site"), F.lit("quality").alias("track"), F.when(turn % 2 == 0, "exclude").otherwise("reinstate").alias("action"), turn.alias("sequence"))
    return screening.current(log, ["A", "B"]).select("parameter", "site", "action")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderdate END NULLS LAST, o_orderkey) AS place FROM orders")
def ordered_places(spark, sf):
    """Places in a total order, nulls last, without one task that has all rows."""
    df = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderdate")).alias("at"))
    return windows.ordered(df, "at", "o_orderkey").select("o_orderkey", F.col("_seq").alias("place"))


@query("SELECT count(*) AS rows, count(DISTINCT n_regionkey) AS regions FROM nation")
def frame_digest(spark, sf):
    """Two digests of one table in different row orders are equal, and another table's isn't."""
    from .plans import provenance

    nation = table(spark, sf, "nation")
    same = provenance.frame_digest(nation) == provenance.frame_digest(nation.orderBy(F.desc("n_name")))
    other = provenance.frame_digest(nation) != provenance.frame_digest(nation.where("n_nationkey > 0"))
    return nation.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("n_regionkey").alias("regions")).where(F.lit(same and other))


@query("""
WITH RECURSIVE n AS (SELECT DISTINCT p_partkey % 40 AS k, CASE WHEN (p_partkey % 40) % 10 = 9 THEN NULL ELSE p_partkey % 40 + 1 END AS next FROM part),
r(k, reached) AS (SELECT k, k FROM n UNION SELECT r.k, n.next FROM r JOIN n ON r.reached = n.k WHERE n.next IS NOT NULL),
u AS (SELECT k, max(reached) AS root FROM r GROUP BY k),
l AS (SELECT root, string_agg('g' || lpad(CAST(k AS VARCHAR), 2, '0'), '+' ORDER BY k) AS unit FROM u GROUP BY root)
SELECT p_partkey, unit FROM part JOIN u ON p_partkey % 40 = k JOIN l USING (root)
""")
def grouping_units(spark, sf):
    """Groups in four chains of ten, each linked to the next by a patient that both have."""
    k = F.col("p_partkey") % 40
    group = F.concat(F.lit("g"), F.lpad(k.cast("string"), 2, "0"))
    part = table(spark, sf, "part").select("p_partkey", group.alias("g"), F.floor(F.col("p_partkey") / 40).alias("turn"), k.alias("k"))
    # Rows of a group have its own patient and that of the group before it, in turns; the first of a chain has none before.
    own = F.concat(F.lit("p"), F.when((F.col("turn") % 2 == 0) | (F.col("k") % 10 == 0), F.col("k")).otherwise(F.col("k") - 1).cast("string"))
    return cohort.grouping_units(part.withColumn("p", own), "g", "p").select("p_partkey", F.col("_unit").alias("unit"))


@query("SELECT 'MAX' AS what, round(max(greatest(l_quantity, l_linenumber * 10)), 4) AS value FROM lineitem UNION ALL SELECT 'DIFF', round(sum(greatest(l_quantity, l_linenumber * 10) - least(l_quantity, l_linenumber * 10)), 4) FROM lineitem UNION ALL SELECT 'dose', round(sum(l_quantity * l_tax), 4) FROM lineitem")
def certificate_block(spark, sf):
    """What is derived from certificate columns: donors' extremes, delivered dose."""
    text = lambda x: F.replace(x.cast("string"), F.lit("."), F.lit(","))
    raw = table(spark, sf, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("lot"), text(F.col("l_quantity")).alias("d1"), text(F.col("l_linenumber") * 10).alias("d2"), text(F.col("l_quantity")).alias("titer"), text(F.col("l_tax")).alias("volume"))
    out = enrich.certificates(raw, "lot", names={"titer": "titer", "volume": "volume"}, donors={"D": ("d1", "d2")})
    a = out.agg(F.max("D MAX").alias("m"), F.sum("D DIFF").alias("d"), F.sum("Delivered dose").alias("s"))
    return a.select(F.explode(F.array(F.struct(F.lit("MAX").alias("what"), F.round("m", 4).alias("value")), F.struct(F.lit("DIFF").alias("what"), F.round("d", 4).alias("value")), F.struct(F.lit("dose").alias("what"), F.round("s", 4).alias("value")))).alias("x")).select("x.*")


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Finished orders of a cohort, with joined look-ups, a derived column and smoothed means by segment."""
    df = lookup_join_m1(spark, sf)
    rows = cohort.select(df, [cohort.Filter("price_per_line", "min", 0.0)])[0]
    state = encode.fit_target(rows, "c_mktsegment", "price_per_line", set())
    return rows.select("o_orderkey", "n_name", "c_mktsegment", "price_per_line", *(x.alias(n) for n, x in encode.applied(state).items()))
