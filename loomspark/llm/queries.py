"""The corpus operators as queries over the synthetic tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, line_dedup, packing, quality, secrets, simhash, suffix_dedup, toxicity, url_filter
from .common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_scan(documents(spark, sf_dir))
    more = [f"n_{r.kind}" for r in secrets.RULES[3:]]
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", *more)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = {"text_sha256": F.sha2(exact_dedup.normalised("text"), 256)}
    return exact_dedup.exact_dedup(documents(spark, sf_dir), carry=digest)


OP2_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
k AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k
"""


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_dedup(documents(spark, sf_dir))
    return found.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
t AS (SELECT *, trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS bare FROM l),
b AS (SELECT bare FROM t WHERE bare <> '' AND source IS NOT NULL GROUP BY bare HAVING count(DISTINCT source) >= 10),
k AS (SELECT t.*, b.bare IS NOT NULL AS gone FROM t LEFT JOIN b USING (bare)),
d AS (
  SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept
  FROM k GROUP BY doc_id)
SELECT doc_id, n_lines, n_removed, CAST(length(kept) AS BIGINT) AS n_chars, sha256(kept) AS kept_sha256 FROM d
"""


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), keep_ids=False)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(documents(spark, sf_dir), keep_text=False)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir)).drop("_key")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(documents(spark, sf_dir), keep_ids=False)


QUERIES: dict[str, Query] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_quality_rules": op8_quality_rules,
    "op9_simhash": op9_simhash,
    "op10_bpe": op10_bpe,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = {"op2_exact_dedup": OP2_SQL, "op3_line_dedup": OP3_SQL}
