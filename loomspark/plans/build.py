"""The three stages: catalog check, batch table, task."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..operators import clean, cohort, correlation, corrections, derive, enrich, merge, missingness, screening, shifts
from ..operators.vocabulary import Vocabulary
from ..sources import readers, sinks
from . import config as C
from . import dataset, events, manifest, provenance, report
from .recipe import Recipe
from .spec import Task


@dataclass
class Inputs:
    """What a build reads; only sites and catalog are needed."""

    sites: dict[str, DataFrame]
    catalog: readers.Catalog
    mapping: dict[str, dict[str, str]] = field(default_factory=dict)
    rules: Sequence[corrections.Rule] = ()
    lookups: Sequence[tuple[DataFrame, str, str]] = ()
    site_maps: tuple[Sequence[DataFrame], str, str, str] | None = None
    vocabulary: Vocabulary = Vocabulary()
    sources: list[dict] = field(default_factory=list)


@dataclass
class Built:
    table: DataFrame
    cleaning: list[clean.Report]
    features: dict[str, derive.Applied]
    checks: merge.Checks
    origins: dict[str, str]
    coverage: dict[str, float]


def check_catalog(inputs: Inputs) -> dict[str, list[str]]:
    mapping = {k: v for m in inputs.mapping.values() for k, v in m.items()}
    return merge.new_parameters(inputs.catalog.names, {s: df.columns for s, df in inputs.sites.items()}, mapping)


def batch_table(inputs: Inputs, config: dict, sites: Sequence[str] | None = None) -> Built:
    """Each site cleaned, joined and derived on its own, then united; parameters that no row has are dropped."""
    settings, cleaning = C.settings(config), config.get("cleaning") or {}
    options = clean.Options(cleaning.get("censored", "limit"), bool(cleaning.get("censored_flags")), cleaning.get("duration_unit", "minutes"), cleaning.get("yes_no_defaults") or {}, cleaning.get("unit_suffixes") or {}, tuple(cleaning.get("disable") or ()))
    reports, applied, done, origins, coverage = [], {}, {}, {}, {}
    for site in sites or (config["site"],):
        df = inputs.sites[site]
        df = df.toDF(*merge.renamed(df.columns, inputs.mapping.get(site, {})))
        origins |= {c: f"records of {site}" for c in df.columns}
        df, cleaned = clean.clean(df, inputs.catalog.types(), site, options, inputs.rules)
        reports.append(cleaned)
        for table, key, label in inputs.lookups:
            if key not in df.columns:
                continue
            before = set(df.columns)
            df = enrich.lookup_join(df, table, key, what=label)
            new = [c for c in df.columns if c not in before]
            origins |= {c: label for c in new}
            if new:
                coverage[f"{site}: {label}"] = enrich.coverage(df, new[0])
        if inputs.site_maps:
            maps, column, k, v = inputs.site_maps
            if column in df.columns:
                df, _ = enrich.expand(df, column, enrich.last_wins(maps, k, v))
        features = derive.registry(settings, df.columns, inputs.vocabulary)
        df, applied[site] = derive.apply(df, features, settings, inputs.vocabulary, inputs.catalog.names)
        origins |= {e["feature"]: "derived" for e in applied[site].entries if e["status"] == "created"}
        done[site] = df
    table, empty = merge.never_recorded(merge.union_sites(done), inputs.catalog.names)
    checks = merge.checks(table, inputs.catalog.names, config.get("build", {}).get("id_column"))
    checks.empty = empty
    return Built(table, reports, applied, checks, origins, coverage)


def analyses(table: DataFrame, catalog: readers.Catalog, order: str, threshold: float = 0.9, plant: str | None = None) -> dict:
    """Missingness profiles and groups, rank groups, and which parameters run in groups over time."""
    there = [c for c in catalog.names if c in table.columns and c != order]
    kinds = dict(table.dtypes)
    numeric = [c for c in there if kinds[c] in ("double", "float", "int", "bigint")]
    profiles = [r.asDict() for r in missingness.profiles(table, there, order).orderBy("column").collect()] if there else []
    groups = missingness.groups(table, there)
    ranks, closest = correlation.rank_groups(table, numeric, threshold) if len(numeric) > 1 else ([], {})
    tested = [r.asDict() for r in shifts.tested(table, there, order, plant).orderBy("plant", "column").collect()] if there else []
    by_plant: dict[str, list[list[str]]] = {p: shifts.shift_groups([r for r in tested if r["plant"] == p]) for p in sorted({r["plant"] for r in tested})}
    return {"profiles": profiles, "groups": groups, "ranks": ranks, "closest": closest, "shifts": tested, "shift_groups": by_plant}


def _tell(built: Built) -> None:
    """What cleaning, joins and features of a build should be looked at for."""
    for r in built.cleaning:
        for c, n in r.unreadable.items():
            events.log.warn("clean", f"{r.site}: {n} cells of {c} can't be read", ", ".join(r.examples.get(c, ())))
        for c, n in r.out_of_percent.items():
            events.log.warn("clean", f"{r.site}: {n} cells of {c} lie outside 0 to 100 %")
        for o in r.corrections:
            if o.skipped:
                events.log.info("corrections", f"{o.rule} on {o.column}: {o.skipped}")
    for site, f in built.features.items():
        if n := f.count("errored"):
            events.log.warn("features", f"{site}: {n} features could not be computed")
    if built.checks.duplicate_ids:
        events.log.warn("checks", f"{len(built.checks.duplicate_ids)} ids repeat")


def run_build(spark: SparkSession, inputs: Inputs, config: dict, sites: Sequence[str] | None = None, order: str | None = None) -> Path:
    """The batch table as Parquet by site, and a package with report, evidence and manifest."""
    started, root, mark = datetime.now(UTC), Path(config["output"]), events.log.mark()
    events.log.step("build", f"batch table of {', '.join(sites or (config['site'],))}")
    for w in inputs.catalog.warnings:
        events.log.warn("catalog", w)
    with sinks.package(root, "build") as pkg:
        built = batch_table(inputs, config, sites)
        _tell(built)
        at = str(root / "tables" / pkg.id / "batch_table.parquet")
        sinks.write_parquet(built.table, at, [merge.SITE])
        table = spark.read.parquet(at)
        digest = provenance.frame_digest(table)
        found = analyses(table, inputs.catalog, order, float((config.get("build") or {}).get("correlation_threshold", 0.9))) if order and order in table.columns else {"profiles": [], "groups": [], "ranks": [], "shifts": []}
        first = next(iter(built.features.values()))
        payload = report.build_payload({"rows": built.checks.rows, **built.checks.rows_by_site}, built.cleaning, first, built.checks, found["profiles"], found["groups"], found["ranks"], built.origins)
        pkg.json("report.json", payload)
        pkg.text("report.html", sinks.page(payload, "Batch table"))
        pkg.rows("missingness.csv", found["profiles"])
        pkg.rows("shifts.csv", found["shifts"])
        pkg.rows("features.csv", first.entries)
        events.log.success("build", f"{built.checks.rows} rows")
        said = events.log.since(mark)
        pkg.text("run.log", events.text(said))
        record = manifest.envelope("build", pkg.id, started, "complete", provenance.capture(spark, inputs.sources, config, config.get("seed", 0)), manifest.files(pkg.staging, pkg.written), events.told(said, "warning"), [], content_digest=digest, catalog_digest=provenance.config_digest({"rows": inputs.catalog.rows}), table=at)
        pkg.text("manifest.json", manifest.dumps(record))
    return pkg.destination


def run_catalog(spark: SparkSession, inputs: Inputs, config: dict) -> dict[str, list[str]]:
    new = check_catalog(inputs)
    with sinks.package(config["output"], "catalog") as pkg:
        payload = report.catalog_payload(new, inputs.catalog.warnings)
        pkg.json("report.json", payload)
        pkg.rows("new_parameters.csv", [{"source": s, "parameter": n} for s, names in new.items() for n in names], ("source", "parameter"))
    return new


def run_task(spark: SparkSession, table: DataFrame, task: Task, root: str, catalog: readers.Catalog | None = None, log: Sequence[screening.Decision] = (), sites: Sequence[str] = (), config: dict | None = None) -> Path:
    """A package with the raw and encoded table, recipe, decisions and report; it can be run again from its own copies."""
    started, mark = datetime.now(UTC), events.log.mark()
    events.log.step("task", task.name)
    if task.site and merge.SITE in table.columns:
        cohort.only_site(table, merge.SITE, task.site)
    screened = {}
    if log:
        gone = screening.excluded(screening.frame(spark, log), sites or [task.site], task.name)
        screened = {r["parameter"]: r["reason"] for r in gone.where(F.col("site") == task.site).collect()}
    features = derive.registry(C.settings(config or {}), table.columns)
    with sinks.package(root, task.name) as pkg:
        d = dataset.build(table, task, catalog, screened, features)
        if faults := dataset.consistent(d):
            raise ValueError("; ".join(faults))
        order = [task.id_column] if task.id_column else []
        pkg.frame("dataset_raw.csv", d.raw, order)
        pkg.frame("dataset.csv", d.encoded, order)
        pkg.text("recipe.json", d.recipe.dumps())
        pkg.rows("columns.csv", d.columns)
        pkg.rows("left_out.csv", d.left_out, ("column", "stage", "reason"))
        pkg.rows("clusters.csv", d.clusters)
        pkg.json("task.json", task.as_dict())
        payload = report.task_payload(task, d)
        pkg.json("report.json", payload)
        pkg.text("report.html", sinks.page(payload, task.name))
        for note in d.notes:
            events.log.warn("task", note)
        events.log.success("task", f"{d.target.rows - d.target.missing - d.target.unreadable} rows, {len(d.recipe.output)} columns")
        said = events.log.since(mark)
        pkg.text("run.log", events.text(said))
        record = manifest.envelope("task", pkg.id, started, "complete", provenance.capture(spark, [], config or {}, task.seed), manifest.files(pkg.staging, pkg.written), events.told(said, "warning"), [], content_digest=provenance.frame_digest(table))
        pkg.text("manifest.json", manifest.dumps(record))
        d.raw.unpersist()
    return pkg.destination


def rerun(spark: SparkSession, run: Path, table: DataFrame, task: Task, **more) -> bool:
    """Whether the same task over the same rows gives the same dataset, byte by byte."""
    again = run_task(spark, table, task, str(run.parent.parent / ".rerun"), **more)
    return (again / "dataset.csv").read_bytes() == (run / "dataset.csv").read_bytes()


def encode_rows(run: Path, rows: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """New rows by a run's recipe, and the inputs they lack."""
    fitted = Recipe.loads((run / "recipe.json").read_text())
    return fitted.transform(rows, keep), fitted.missing_inputs(rows)


def task_rows(run: Path) -> dict:
    return json.loads((run / "task.json").read_text())


def missing_evidence(table: DataFrame, columns: Sequence[str], site: str) -> DataFrame:
    """(parameter, site, missing_pct) of each column, from one aggregate."""
    wide = table.agg(F.count(F.lit(1)).alias("n"), *(F.count(E.c(c)).alias(f"c{k}") for k, c in enumerate(columns)))
    return wide.select(F.explode(F.array(*(F.struct(F.lit(c).alias("parameter"), F.lit(site).alias("site"), (100.0 * (F.col("n") - F.col(f"c{k}")) / F.col("n")).alias("missing_pct")) for k, c in enumerate(columns)))).alias("x")).select("x.*")
