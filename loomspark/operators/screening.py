"""The screening register: an append-only log of decisions about parameters, and what stands at present.

The log is a table of decisions, small enough to be validated row by row; what stands is its replay, as a DataFrame.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, fields
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .windows import last_rows

TRACKS = ("quality", "redundancy")
ACTIONS = ("exclude", "reinstate")
ALL_SITES = "all"
REVIEW_AFTER, DRIFT_POINTS = 91, 20.0


@dataclass(frozen=True)
class Decision:
    sequence: int
    id: str
    decided: str
    parameter: str
    site: str
    track: str
    action: str
    reason: str
    rationale: str = ""
    author: str = ""
    represented_by: str = ""
    group: str = ""
    cohort: str = ""
    missing_pct: float | None = None
    batch_table: str = ""
    review: str = ""


SCHEMA = "sequence long, id string, decided string, parameter string, site string, track string, action string, reason string, rationale string, author string, represented_by string, `group` string, cohort string, missing_pct double, batch_table string, review string"


def frame(spark: SparkSession, log: Sequence[Decision]) -> DataFrame:
    return spark.createDataFrame([tuple(asdict(d).values()) for d in log], SCHEMA)


def read(rows: Iterable[dict], sites: Sequence[str]) -> list[Decision]:
    """Decisions from table rows; every fault is told at once."""
    out, faults, names = [], [], [f.name for f in fields(Decision)]
    for n, r in enumerate(rows, 1):
        x = {k: r.get(k) for k in names}
        if x["site"] not in (*sites, ALL_SITES):
            faults.append(f"row {n}: unknown site {x['site']!r}")
        if x["track"] not in TRACKS:
            faults.append(f"row {n}: unknown track {x['track']!r}")
        if x["action"] not in ACTIONS:
            faults.append(f"row {n}: unknown action {x['action']!r}")
        if not x["parameter"] or not x["id"]:
            faults.append(f"row {n}: parameter and id must not be empty")
        out.append(Decision(**{k: (v if v is not None else 0 if k == "sequence" else None if k == "missing_pct" else "") for k, v in x.items()}))
    if len({d.sequence for d in out}) < len(out):
        faults.append("sequence numbers repeat")
    if faults:
        raise ValueError("screening register: " + "; ".join(faults))
    return sorted(out, key=lambda d: d.sequence)


def digest(log: Sequence[Decision]) -> str:
    """Of all rows in order: a register that was edited by hand has another."""
    return hashlib.sha256("\n".join(repr(tuple(asdict(d).values())) for d in log).encode()).hexdigest()


def current(log: DataFrame, sites: Sequence[str]) -> DataFrame:
    """The last decision for each parameter, site and track; one for all sites counts at each."""
    each = log.withColumn("site", F.explode(F.when(F.col("site") == ALL_SITES, F.array(*map(F.lit, sites))).otherwise(F.array("site"))))
    return last_rows(each, ["parameter", "site", "track"], "sequence")


def excluded(log: DataFrame, sites: Sequence[str], cohort: str | None = None) -> DataFrame:
    """(parameter, site) that any track excludes; decisions for another cohort don't count."""
    standing = current(log, sites).where("action = 'exclude'")
    if cohort is not None:
        standing = standing.where((F.coalesce("cohort", F.lit("")) == "") | (F.col("cohort") == cohort))
    return standing.groupBy("parameter", "site").agg(F.array_sort(F.collect_set("track")).alias("tracks"), F.min_by("reason", "sequence").alias("reason"))


def represented(log: DataFrame, sites: Sequence[str]) -> DataFrame:
    return current(log, sites).where("action = 'exclude' and represented_by <> ''").select("parameter", "site", "represented_by")


def conflicts(log: DataFrame, sites: Sequence[str]) -> DataFrame:
    """Parameters that stand for another and are excluded themselves."""
    gone = excluded(log, sites).select(F.col("parameter").alias("represented_by"), "site")
    return represented(log, sites).join(gone, ["represented_by", "site"]).select("site", "represented_by", "parameter")


def at_site(log: DataFrame, sites: Sequence[str], site: str, track: str | None = None) -> DataFrame:
    found = current(log, sites).where(F.col("site") == site)
    return found.where(F.col("track") == track) if track else found


def review(log: DataFrame, sites: Sequence[str], evidence: DataFrame, today: date) -> DataFrame:
    """Standing exclusions that are due, or whose share of missing values (evidence: parameter, site, missing_pct) has moved
    by DRIFT_POINTS or more since."""
    standing = current(log, sites).where("action = 'exclude'")
    now = evidence.select("parameter", "site", F.col("missing_pct").alias("missing_now"))
    drift = F.abs(F.col("missing_now") - F.col("missing_pct"))
    return standing.join(now, ["parameter", "site"], "left").withColumns({"due": F.coalesce(F.col("review") <= str(today), F.lit(False)), "drifted": F.coalesce(drift >= DRIFT_POINTS, F.lit(False))}).where("due or drifted").select("parameter", "site", "track", "review", "missing_pct", "missing_now", "due", "drifted")


def add(log: Sequence[Decision], proposals: Sequence[dict], sites: Sequence[str], columns: Sequence[str], author: str, today: date, batch_table: str = "", missing: dict[str, float] | None = None) -> list[Decision]:
    """The log with the proposals appended. Rows of one group share an id; all faults of all rows are told at once."""
    faults, new = [], []
    number = max([int(d.id.split("-")[1]) for d in log if d.id.startswith("S-")], default=0)
    sequence = max([d.sequence for d in log], default=0)
    standing: dict[tuple[str, str], str] = {}
    for d in log:
        for s in sites if d.site == ALL_SITES else (d.site,):
            standing[d.parameter, s, d.track] = d.action
    ids: dict[str, str] = {}
    proposed_out = {(p.get("parameter"), s) for p in proposals if p.get("action") == "exclude" for s in (sites if p.get("site") == ALL_SITES else (p.get("site"),))}
    for n, p in enumerate(proposals, 1):
        get = lambda k: str(p.get(k) or "").strip()
        parameter, site, track, action = get("parameter"), get("site"), get("track"), get("action")
        at = sites if site == ALL_SITES else (site,)
        if parameter not in columns:
            faults.append(f"row {n}: no parameter {parameter!r}")
        if site not in (*sites, ALL_SITES) or track not in TRACKS or action not in ACTIONS:
            faults.append(f"row {n}: site, track or action is unknown")
        if action == "exclude" and not get("reason"):
            faults.append(f"row {n}: an exclusion needs a reason")
        if action == "reinstate" and not any(standing.get((parameter, s, track)) == "exclude" for s in at):
            faults.append(f"row {n}: {parameter} isn't excluded")
        if action == "exclude" and all(standing.get((parameter, s, track)) == "exclude" for s in at):
            faults.append(f"row {n}: {parameter} is excluded already")
        by = get("represented_by")
        if by and (by == parameter or by not in columns or any((by, s) in proposed_out or any(standing.get((by, s, t)) == "exclude" for t in TRACKS) for s in at)):
            faults.append(f"row {n}: {by!r} can't stand for {parameter}")
        key = get("group") or f"#{n}"
        if key not in ids:
            number += 1
            ids[key] = f"S-{number:04d}"
        sequence += 1
        new.append(Decision(sequence, ids[key], str(today), parameter, site, track, action, get("reason"), get("rationale"), author, by, get("group"), get("cohort"), (missing or {}).get(parameter), batch_table, str(today + timedelta(days=REVIEW_AFTER)) if action == "exclude" else ""))
    if faults:
        raise ValueError("screening: " + "; ".join(faults))
    return [*log, *new]


def summary(log: DataFrame, sites: Sequence[str]) -> DataFrame:
    return current(log, sites).groupBy("site", "track", "action").agg(F.count(F.lit(1)).alias("parameters"))


def note(parameter: str, site: str, gone: dict[tuple[str, str], str], stands_for: dict[tuple[str, str], Sequence[str]]) -> str:
    """One line about a parameter at a site: why it is out, or whom it stands for."""
    if (parameter, site) in gone:
        return f"left out: {gone[parameter, site]}"
    others = stands_for.get((parameter, site), ())
    return f"stands for {', '.join(sorted(others))}" if others else ""


def task_catalog(catalog: DataFrame, usable: Sequence[str], log: DataFrame, sites: Sequence[str], site: str, cohort: str | None = None) -> DataFrame:
    """The catalog's parameters that a task may use, each with its state in the register."""
    gone = excluded(log, sites, cohort).where(F.col("site") == site).select(F.col("parameter").alias("Parameter"), F.col("reason").alias("Left out because"))
    return catalog.where(F.col("Parameter").isin(list(usable))).join(gone, "Parameter", "left")


def proposal_rows(picked: Sequence[str], group_of: dict[str, str], site: str, action: str, reason: str, track: str = "quality", represented_by: str = "", rationale: str = "") -> list[dict]:
    """Proposals from parameters picked in a report; the representative itself isn't proposed."""
    return [{"parameter": p, "site": site, "track": track, "action": action, "reason": reason, "rationale": rationale, "group": group_of.get(p, ""), "represented_by": represented_by} for p in picked if p != represented_by]
