"""Readers: one source address for local folders, mounted shares and object stores, and the tables of a build."""

from __future__ import annotations

import csv
import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..operators import corrections, enrich, merge, screening
from ..operators.clean import VALUE_TYPES
from ..operators.encode import parsed_order
from ..operators.vocabulary import Vocabulary, from_table

DELIMITERS = ",;\t|"


@dataclass(frozen=True)
class Source:
    """What to read: a label, and a path under a root (a drive, a share, a bucket) that Spark's readers can open."""

    label: str
    path: str
    root: str = ""
    sep: str | None = None
    header: bool = True

    @property
    def uri(self) -> str:
        return f"{self.root.rstrip('/')}/{self.path.lstrip('/')}" if self.root else self.path

    def read(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.uri, self.sep, self.header)

    def record(self) -> dict:
        return {"label": self.label, "path": self.path, "root": self.root}


def _suffix(path: str) -> str:
    return path.rstrip("/").rpartition(".")[2].lower()


def sniffed(spark: SparkSession, path: str) -> str:
    """The delimiter of a text table, from its first line."""
    lines = spark.read.text(path).limit(1).collect()
    first = lines[0][0].lstrip("﻿") if lines else ""
    try:
        return csv.Sniffer().sniff(first, DELIMITERS).delimiter
    except csv.Error:
        return max(DELIMITERS, key=first.count) if any(d in first for d in DELIMITERS) else ","


def read_table(spark: SparkSession, path: str, sep: str | None = None, header: bool = True) -> DataFrame:
    """By the path's ending: csv, tsv or txt (all columns text; delimiter sniffed unless given), json, orc, else Parquet."""
    kind = _suffix(path)
    if kind in ("xls", "xlsx", "xlsm"):
        raise ValueError(f"{path}: worksheets have no reader here; save the sheet as CSV or Parquet")
    if kind in ("csv", "tsv", "txt"):
        df = spark.read.csv(path, header=header, sep=sep or ("\t" if kind == "tsv" else sniffed(spark, path)), encoding="UTF-8", multiLine=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        return df.toDF(*(c.lstrip("﻿") for c in df.columns))
    if kind in ("json", "jsonl"):
        return spark.read.json(path)
    return spark.read.orc(path) if kind == "orc" else spark.read.parquet(path)


def optional(spark: SparkSession, source: Source | None) -> tuple[DataFrame | None, str]:
    """The table, or None and why it can't be read."""
    if source is None:
        return None, "not configured"
    try:
        return source.read(spark), ""
    except AnalysisException as fault:
        return None, str(fault).splitlines()[0]


@dataclass
class Catalog:
    rows: list[dict]
    warnings: list[str]

    @property
    def names(self) -> list[str]:
        return [r["Parameter"] for r in self.rows]

    def types(self) -> dict[str, str]:
        return {r["Parameter"]: "categorical" if parsed_order(r["Value Type"]) else r["Value Type"] for r in self.rows}

    def orders(self) -> dict[str, list[str]]:
        return {r["Parameter"]: o for r in self.rows if (o := parsed_order(r["Value Type"]))}


def read_catalog(df: DataFrame) -> Catalog:
    """One row for each parameter (the first of repeated ones), blank names dropped. Unknown types are warned about."""
    lacking = {"Parameter", "Value Type"} - set(df.columns)
    if lacking:
        raise ValueError(f"catalog: no column {', '.join(sorted(lacking))}")
    seq = df.withColumn("_seq", F.monotonically_increasing_id()).withColumn("Parameter", E.key_text("Parameter")).where("Parameter is not null")
    first = seq.withColumn("_n", F.row_number().over(W.partitionBy("Parameter").orderBy("_seq"))).where("_n = 1").orderBy("_seq").drop("_n", "_seq")
    rows = [r.asDict() for r in first.collect()]
    warnings = []
    for r in rows:
        r["Value Type"] = (r["Value Type"] or "").strip() if parsed_order(r["Value Type"] or "") else (r["Value Type"] or "").strip().lower()
        if r["Value Type"] not in VALUE_TYPES and not parsed_order(r["Value Type"]):
            warnings.append(f"{r['Parameter']}: unknown value type {r['Value Type']!r}")
    twice = seq.groupBy("Parameter").count().where("count > 1").orderBy("Parameter").limit(50).collect()
    return Catalog(rows, warnings + [f"{r['Parameter']}: listed {r['count']} times, the first counts" for r in twice])


def records(spark: SparkSession, source: Source, key: str | None = None) -> DataFrame:
    """A site's batch records as they are; with a key, only that it is there is checked."""
    df = source.read(spark)
    if key and key not in df.columns:
        raise ValueError(f"{source.label}: no column {key}")
    return df


def mapped_records(spark: SparkSession, source: Source, mapping: dict[str, str]) -> DataFrame:
    df = source.read(spark)
    return df.toDF(*merge.renamed(df.columns, mapping))


def batch_table(spark: SparkSession, source: Source) -> DataFrame:
    df = source.read(spark)
    if merge.SITE not in df.columns:
        raise ValueError(f"{source.label}: not a batch table, it has no column {merge.SITE}")
    return df


def supplement(df: DataFrame, keys: Sequence[str], renames: dict[str, str] | None = None) -> tuple[DataFrame, str]:
    """Rows with a key, found by name, columns renamed; and the key's name."""
    key = enrich.find_key(df, keys, "supplement")
    return df.where(E.key_text(key).isNotNull()).withColumnsRenamed(renames or {}), (renames or {}).get(key, key)


def raw_materials(df: DataFrame, key: str) -> DataFrame:
    """Query[x] headers unwrapped, the first of repeated names kept, key trimmed."""
    names, keep = [], []
    for c in df.columns:
        name = merge.unwrapped(c)
        if name not in names:
            names.append(name)
            keep.append(c)
    return df.select(*(E.c(c).alias(n) for c, n in zip(keep, names))).withColumn(key, E.key_text(key))


def vocabulary(df: DataFrame) -> Vocabulary:
    return from_table(df)


def correction_rules(df: DataFrame) -> list[corrections.Rule]:
    return corrections.from_rows(r.asDict() for r in df.collect())


def warehouse(spark: SparkSession, options: dict[str, str], enabled: bool) -> DataFrame | None:
    """An external table by JDBC, if switched on; options as Spark's reader takes them."""
    return spark.read.format("jdbc").options(**options).load() if enabled else None


def register(spark: SparkSession, path: str, sites: Sequence[str], expected_digest: str | None = None) -> list[screening.Decision]:
    """The screening register. A digest that was kept beside it must agree: it tells of changes by hand."""
    log = screening.read((r.asDict() for r in read_table(spark, path).orderBy("sequence").collect()), sites)
    kept = expected_digest or _digest_beside(spark, path)
    if kept and kept != screening.digest(log):
        raise ValueError(f"{path}: changed since it was written")
    return log


def _digest_beside(spark: SparkSession, path: str) -> str | None:
    found, _ = optional(spark, Source("digest", path.rstrip("/") + ".digest.json"))
    return found.first()["digest"] if found is not None else None


def content_digest(lines: Sequence[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()
