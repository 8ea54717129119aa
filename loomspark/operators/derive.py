"""Derived columns: a registry of declared formulas, applied level by level.

A formula is an expression over vocabulary keys; what it needs is read off it. All features that depend only on what is
there are added in one projection, then those that depend on them, so that a hundred features are a handful of
projections and not a chain of a hundred.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E
from .vocabulary import Vocabulary


@dataclass(frozen=True)
class Settings:
    """Set points and thresholds of the process. Unset ones block the features that need them."""

    co2_target: float = 5.0
    temp_target: float = 37.0
    contact_target: float = 120.0
    contact_tolerance: float = 30.0
    seeding_tolerance: float = 5.0
    cpdl_low: float = 4.0
    cpdl_high: float = 5.0
    lactate_low: float = 12.5
    lactate_high: float = 30.0
    cd4_low: float = 40.0
    cd4_high: float = 60.0
    seeding_target_per_vessel: float = 5e7
    shift_cutoff: str = "11:59"
    moi_target: float | None = None
    medium_glucose: float | None = None
    medium_lactate: float | None = None
    impurity_spec_limits: tuple[float, ...] | None = None


#: What a formula may use of the frame: the keys that are there, each as a column.
Compute = Callable[["Inputs"], Column]


@dataclass(frozen=True)
class Feature:
    """requires: each item is a key, or alternatives of which one is enough. setting: must be set, else it is blocked."""

    key: str
    requires: tuple[str | tuple[str, ...], ...]
    compute: Compute
    group: str
    kind: str = "numeric"
    setting: str = ""
    name: str = ""
    site_relative: bool = False


class Inputs:
    """Columns by key: i("key") as double, i.raw("key") as it is, i.first(...) of alternatives, i.there(...) those present."""

    def __init__(self, frame: DataFrame, vocabulary: Vocabulary) -> None:
        self.frame, self.types, self.vocabulary = frame, dict(frame.dtypes), vocabulary

    def has(self, key: str) -> bool:
        return self.vocabulary.name(key) in self.types

    def raw(self, key: str) -> Column:
        return E.c(self.vocabulary.name(key))

    def __call__(self, key: str) -> Column:
        return E.as_double(self.raw(key), self.types[self.vocabulary.name(key)])

    def first(self, *keys: str) -> Column:
        return next((self(k) for k in keys if self.has(k)), F.lit(None).cast("double"))

    def there(self, *keys: str) -> list[Column]:
        return [self(k) for k in keys if self.has(k)]

    def time(self, key: str) -> Column:
        x = self.raw(key)
        return x if self.types[self.vocabulary.name(key)].startswith("timestamp") else E.moment(x)

    def yes_no(self, key: str) -> Column:
        return E.yes_no(self.raw(key), self.types[self.vocabulary.name(key)])


def _feature(group: str, key: str, requires: str, compute: Compute, **more) -> Feature:
    """requires as text: keys by spaces, alternatives by |."""
    needs = tuple(tuple(r.split("|")) if "|" in r else r for r in requires.split())
    return Feature(key, needs, compute, group, **more)


DAYS = (6.0, 8.0, 10.0)
TITER = ("coa_titer", "vector_titer")
IMPURITIES = ("coa_impurity_1", "coa_impurity_2", "coa_impurity_3", "coa_impurity_4", "coa_impurity_5")
PER_MILLION_CELLS = 1e9


def _vessels(i: Inputs) -> Column:
    n = i("vessel_count")
    return F.when((n >= 1) & (n == F.round(n)), n)


def _times(a: str, b: str, factor: float = 1.0) -> Compute:
    return lambda i: i(a) * i(b) * factor


def _minus(a: str, b: str) -> Compute:
    return lambda i: i(a) - i(b)


def _over(a: str, b: str, factor: float = 1.0) -> Compute:
    return lambda i: E.safe_div(i(a) * factor, i(b))


def _lost(a: str, b: str, factor: float = 1.0) -> Compute:
    """The share of a that b doesn't have."""
    return lambda i: (1 - E.safe_div(i(b), i(a))) * factor


def _per_cell(a: str, b: str) -> Compute:
    def compute(i: Inputs) -> Column:
        n = _vessels(i)
        total = F.when(n == 1, i(a)).when(n == 2, i(a) + i(b))
        return E.safe_div(total * PER_MILLION_CELLS, i("vsvg_cells"))

    return compute


def _harvest_per_cell(a: str) -> Compute:
    return lambda i: E.safe_div(i(a) * PER_MILLION_CELLS * _vessels(i), i("vsvg_cells"))


def _between(later: str, earlier: str, negative: bool = True) -> Compute:
    def compute(i: Inputs) -> Column:
        minutes = E.minutes_between(i.time(later), i.time(earlier))
        return minutes if negative else F.when(minutes >= 0, minutes)

    return compute


def _seconds(i: Inputs, key: str) -> Column:
    if i.types[i.vocabulary.name(key)].startswith("timestamp"):
        t = i.raw(key)
        return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    return E.seconds_of_day(i.raw(key))


def _thaw_wait(i: Inputs) -> Column:
    """The thaw is placed on the day of the incubator; a wait that is negative then stays open."""
    into = i.time("incubator_in_d0")
    wait = ((F.unix_micros(into) - F.unix_micros(F.date_trunc("day", into))) / 1e6 - _seconds(i, "thaw_time")) / 60
    return F.when(wait >= 0, wait)


def _pooled_moi(i: Inputs) -> Column:
    cells = i("cells_available") if i.has("cells_available") else E.row_sum(i.there("cells_seeded_a", "cells_seeded_b"))
    return i.first(*TITER) * E.safe_div(E.row_sum(i.there("vector_volume_a", "vector_volume_b")), cells)


def _yield(lactate: Sequence[str], glucose: Sequence[str], s: Settings) -> Compute:
    def compute(i: Inputs) -> Column:
        used = s.medium_glucose - E.row_mean(i.there(*glucose))
        return E.safe_div(E.row_mean(i.there(*lactate)) - s.medium_lactate, F.when(used > 0, used))

    return compute


def _growth(s: Settings, v: Vocabulary) -> Compute:
    def compute(i: Inputs) -> Column:
        doublings, lactate = i("cpdl"), i.first("f_lactate_per_cell_d10", "f_harvest_lactate_norm")
        found = F.when((doublings < s.cpdl_low) | (lactate < s.lactate_low), v.value("slow")).when((doublings > s.cpdl_high) & (lactate > s.lactate_high), v.value("fast")).otherwise(v.value("typical"))
        return F.when(doublings.isNotNull() & lactate.isNotNull(), found)

    return compute


def zscores(df: DataFrame, columns: dict[str, str], by: Sequence[str] = ()) -> DataFrame:
    """df with new columns (new name: column), each a z-score within its partition: population spread, null without one.

    Means and spreads are aggregated first and joined back, so no partition is gathered in one place.
    """
    stats = df.groupBy(*map(E.c, by)).agg(*(x for k, c in enumerate(columns.values()) for x in (F.avg(E.c(c)).alias(f"_m{k}"), F.stddev_pop(E.c(c)).alias(f"_s{k}"))))
    if by:
        keys = stats.select(*(E.c(b).alias(f"_k{j}") for j, b in enumerate(by)), *(c for c in stats.columns if c not in by))
        same = [E.c(b).eqNullSafe(F.col(f"_k{j}")) for j, b in enumerate(by)]
        joined = df.join(keys, same, "left")
    else:
        joined = df.crossJoin(F.broadcast(stats))  # one row
    scored = {new: F.try_divide(E.c(c) - F.col(f"_m{k}"), F.when(F.col(f"_s{k}") > 0, F.col(f"_s{k}"))) for k, (new, c) in enumerate(columns.items())}
    return joined.select(*(E.c(c) for c in df.columns), *(x.alias(n) for n, x in scored.items()))


def _impurity_index(i: Inputs) -> Column:
    """Strict sum of z-scores: means and spreads are two numbers for each of at most five columns."""
    there = [k for k in IMPURITIES if i.has(k)]
    found = i.frame.agg(*(x for k in there for x in (F.avg(i(k)), F.stddev_pop(i(k))))).first()
    total = F.lit(0.0)
    for k, key in enumerate(there):
        mean, spread = found[2 * k], found[2 * k + 1]
        total = total + ((i(key) - mean) / spread if spread else F.lit(None).cast("double"))
    return total


def _spec_index(s: Settings) -> Compute:
    limits = s.impurity_spec_limits or ()
    if s.impurity_spec_limits is not None and len(limits) != len(IMPURITIES):
        raise ValueError(f"impurity_spec_limits: {len(limits)} limits for {len(IMPURITIES)} impurities")
    return lambda i: E.row_sum([i(k) / x for k, x in zip(IMPURITIES, limits) if x and i.has(k)])


def registry(s: Settings, columns: Sequence[str] = (), v: Vocabulary | None = None) -> list[Feature]:
    """All features in the order of their groups. Environment features depend on which columns there are."""
    v = v or Vocabulary()
    f, out = _feature, []
    g = "Flow and phenotype"
    out += [
        f(g, "f_log_pt_cd4_cd8", "pt_cd4_pct pt_cd8_pct", lambda i: E.log10(E.safe_div(i("pt_cd4_pct"), i("pt_cd8_pct")))),
        f(g, "f_log_pw_cd4_cd8", "pw_cd4_pct pw_cd8_pct", lambda i: E.log10(E.safe_div(i("pw_cd4_pct"), i("pw_cd8_pct")))),
        f(g, "f_cd4_cd8_shift", "f_log_pt_cd4_cd8 f_log_pw_cd4_cd8", _minus("f_log_pt_cd4_cd8", "f_log_pw_cd4_cd8")),
        f(g, "f_pt_cd3_cells", "pt_viable_cells pt_cd3_pct", _times("pt_viable_cells", "pt_cd3_pct", 0.01)),
        f(g, "f_pt_cd4_share", "pt_cd4_pct pt_cd3_pct", _times("pt_cd4_pct", "pt_cd3_pct", 0.01)),
        f(g, "f_pt_cd4_cells", "f_pt_cd4_share pt_viable_cells", _times("f_pt_cd4_share", "pt_viable_cells", 0.01)),
        f(g, "f_pw_cd4_share", "pw_cd4_pct pw_cd3_pct", _times("pw_cd4_pct", "pw_cd3_pct", 0.01)),
        f(g, "f_pw_cd8_share", "pw_cd8_pct pw_cd3_pct", _times("pw_cd8_pct", "pw_cd3_pct", 0.01)),
    ]
    g = "Metabolites"
    for what in ("lactate", "glucose"):
        per = tuple(f"f_{what}_per_cell_d{int(d)}" for d in DAYS)
        out += [f(g, per[k], f"vessel_count d{d}_{what}_a d{d}_{what}_b vsvg_cells", _per_cell(f"d{d}_{what}_a", f"d{d}_{what}_b")) for k, d in enumerate((6, 8))]
        out.append(f(g, per[2], f"vessel_count harvest_{what} vsvg_cells", _harvest_per_cell(f"harvest_{what}")))
        pairs = lambda i, per=per: [(d, i(k)) for d, k in zip(DAYS, per) if i.has(k)]
        out.append(f(g, f"f_{what}_slope", "|".join(per), lambda i, pairs=pairs: E.row_slope(*zip(*pairs(i)))))
        out.append(f(g, f"f_{what}_auc", "|".join(per), lambda i, pairs=pairs: E.row_auc(*zip(*pairs(i)))))
        out += [f(g, f"f_{what}_increment_{k + 1}", f"{per[k]} {per[k + 1]}", _minus(per[k + 1], per[k])) for k in (0, 1)]
    readings = {6: (("d6_lactate_a", "d6_lactate_b"), ("d6_glucose_a", "d6_glucose_b")), 8: (("d8_lactate_a", "d8_lactate_b"), ("d8_glucose_a", "d8_glucose_b")), 10: (("harvest_lactate",), ("harvest_glucose",))}
    for d, (lactate, glucose) in readings.items():
        out.append(f(g, f"f_lactate_glucose_ratio_d{d}", f"f_lactate_per_cell_d{d} f_glucose_per_cell_d{d}", _over(f"f_lactate_per_cell_d{d}", f"f_glucose_per_cell_d{d}")))
        out.append(f(g, f"f_lactate_yield_d{d}", f"{'|'.join(lactate)} {'|'.join(glucose)}", _yield(lactate, glucose, s), setting="medium_glucose medium_lactate"))
    g = "Profiles"
    out += [
        f(g, "f_growth_profile", "cpdl f_lactate_per_cell_d10|f_harvest_lactate_norm", _growth(s, v), kind="categorical"),
        f(g, "f_cd4_profile", "pt_cd4_pct", lambda i: F.when(i("pt_cd4_pct") <= s.cd4_low, v.value("low")).when(i("pt_cd4_pct") >= s.cd4_high, v.value("high")).when(i("pt_cd4_pct").isNotNull(), v.value("middle")), kind="categorical"),
    ]
    g = "Viability"
    out += [
        f(g, "f_viability_drop_pts", "d3_viability pw_viability", _minus("d3_viability", "pw_viability")),
        f(g, "f_viability_d3_d10_rel", "d3_viability harvest_viability", _lost("d3_viability", "harvest_viability", 100.0)),
        f(g, "f_viability_d3_d10_pts", "d3_viability washed_viability", _minus("washed_viability", "d3_viability")),
        f(g, "f_viability_wash", "washed_viability harvest_viability", _lost("harvest_viability", "washed_viability", -100.0)),
    ]
    g = "Seeding"
    error = lambda i: F.abs(i("f_seeding_pct") - 100)
    out += [
        f(g, "f_seeding_pct", "vessel_count vsvg_cells", lambda i: E.safe_div(i("vsvg_cells"), _vessels(i) * s.seeding_target_per_vessel) * 100),
        f(g, "f_seeding_error", "f_seeding_pct", error),
        f(g, "f_seeding_within", "f_seeding_pct", lambda i: (error(i) <= s.seeding_tolerance).cast("double"), kind="boolean"),
        f(g, "f_seeding_loss", "cells_available cells_seeded_a", lambda i: 1 - E.safe_div(E.row_sum(i.there("cells_seeded_a", "cells_seeded_b")), i("cells_available"))),
        f(g, "f_dead_cells_d3", "cells_available d3_viability", lambda i: i("cells_available") * E.safe_div(100 - i("d3_viability"), i("d3_viability"))),
        f(g, "f_cells_per_bag", "cells_available culture_bags", _over("cells_available", "culture_bags")),
    ]
    g = "Vessel balance"
    for key, a, b in (("f_seeded", "cells_seeded_a", "cells_seeded_b"), ("f_vector_volume", "vector_volume_a", "vector_volume_b")):
        out.append(f(g, f"{key}_mean", f"{a} {b}", lambda i, a=a, b=b: E.row_mean([i(a), i(b)])))
        out.append(f(g, f"{key}_imbalance", f"{a} {b}", lambda i, a=a, b=b: E.safe_div(F.abs(i(a) - i(b)), i(a) + i(b))))
    g, titer = "MOI", "|".join(TITER)
    for x in "ab":
        out.append(f(g, f"f_moi_{x}", f"{titer} vector_volume_{x} cells_seeded_{x}", lambda i, x=x: i.first(*TITER) * E.safe_div(i(f"vector_volume_{x}"), i(f"cells_seeded_{x}"))))
        out.append(f(g, f"f_log_moi_{x}", f"f_moi_{x}", lambda i, x=x: E.log1p(i(f"f_moi_{x}"))))
    out += [
        f(g, "f_moi_pool", f"{titer} vector_volume_a vector_volume_b cells_available|cells_seeded_a", _pooled_moi),
        f(g, "f_log_moi_pool", "f_moi_pool", lambda i: E.log1p(i("f_moi_pool"))),
        f(g, "f_moi_quality", "f_moi_pool coa_pi_ratio", _times("f_moi_pool", "coa_pi_ratio")),
        f(g, "f_moi_per_cd3", f"{titer} vector_volume_a vector_volume_b f_pt_cd3_cells", lambda i: i.first(*TITER) * E.safe_div(E.row_sum(i.there("vector_volume_a", "vector_volume_b")), i("f_pt_cd3_cells"))),
        f(g, "f_moi_vs_target", "f_moi_pool", lambda i: E.safe_div(i("f_moi_pool"), F.lit(s.moi_target)), setting="moi_target"),
    ]
    g = "Contact time"
    for x in ("", "_a", "_b"):
        k, low, high = f"contact_time{x}", s.contact_target - s.contact_tolerance, s.contact_target + s.contact_tolerance
        out.append(f(g, f"f_contact_deviation{x}", k, lambda i, k=k: F.abs(i(k) - s.contact_target)))
        out.append(f(g, f"f_contact_within{x}", k, lambda i, k=k, low=low, high=high: i(k).between(low, high).cast("double"), kind="boolean"))
    g = "Incubation"
    out.append(f(g, "f_thaw_to_incubator", "thaw_time incubator_in_d0", _thaw_wait))
    spans = (("d0_d1", "incubator_out_d1", "incubator_in_d0"), ("d1_d3", "incubator_out_d3", "incubator_in_d1"), ("d3_d6", "incubator_out_d6", "incubator_back_d3"), ("d6_d8", "incubator_out_d8", "incubator_back_d6"), ("d8_d10", "incubator_out_d10", "incubator_back_d8"))
    out += [f(g, f"f_incubation_{x}", f"{later} {earlier}", _between(later, earlier)) for x, later, earlier in spans]
    out.append(f(g, "f_incubation_total", "f_incubation_d3_d6 f_incubation_d6_d8 f_incubation_d8_d10", lambda i: i("f_incubation_d3_d6") + i("f_incubation_d6_d8") + i("f_incubation_d8_d10")))
    out += [f(g, f"f_out_of_incubator_{d}", f"incubator_out_{d} incubator_back_{d}", _between(f"incubator_back_{d}", f"incubator_out_{d}", negative=False)) for d in ("d3", "d6", "d8")]
    g = "Clumps"
    out += [f(g, f"f_clump_{x}_reduction", f"clumps_pre_{x} clumps_post_{x}", _lost(f"clumps_pre_{x}", f"clumps_post_{x}")) for x in ("count", "size")]
    out += [f(g, f"f_clump_burden_{x}", f"clumps_{x}_count clumps_{x}_size", _times(f"clumps_{x}_count", f"clumps_{x}_size")) for x in ("pre", "post", "mix")]
    bags = tuple(f"clump_bag_{k}" for k in (1, 2, 3))
    out += [
        f(g, "f_mixing_x_clumps", "mixing_cycles clumps_pre_count", _times("mixing_cycles", "clumps_pre_count")),
        f(g, "f_d3_clumps", "d3_clump_pattern", lambda i: i.yes_no("d3_clump_pattern"), kind="boolean"),
        # Strict: a bag without a reading leaves the count open.
        f(g, "f_clump_bag_count", "|".join(bags), lambda i: sum((i.yes_no(k) for k in bags if i.has(k)), F.lit(0.0))),
    ]
    g = "Dose and CAR"
    out += [
        f(g, "f_dose_all", "dose_per_kg dose_cells", lambda i: F.coalesce(i("dose_per_kg") / 1e6, i("dose_cells") / 1e8)),
        f(g, "f_dose_basis", "dose_per_kg dose_cells", lambda i: F.when(i.raw("dose_per_kg").isNotNull(), v.value("weight based")).when(i.raw("dose_cells").isNotNull(), v.value("fixed")), kind="categorical"),
        f(g, "f_post_formulation_dose", "formulated_concentration bag_volume harvest_car_pct subject_weight", lambda i: E.safe_div(i("formulated_concentration") / 1e6 * i("bag_volume") * i("harvest_car_pct") / 100, i("subject_weight"))),
        f(g, "f_achievable_dose", "harvest_car_pct washed_cells subject_weight", lambda i: E.safe_div(i("harvest_car_pct") / 100 * i("washed_cells"), i("subject_weight") * 1e6)),
        f(g, "f_car_cells", "harvest_car_pct washed_cells", _times("harvest_car_pct", "washed_cells", 0.01)),
        f(g, "f_car_yield", "harvest_car_pct cpdl", lambda i: i("harvest_car_pct") / 100 * F.pow(F.lit(2.0), i("cpdl"))),
        f(g, "f_vcn_per_cell", "fp_car_pct vcn", _times("fp_car_pct", "vcn", 0.01)),
        f(g, "f_flow_accuracy", "fp_car_pct harvest_car_pct", _over("fp_car_pct", "harvest_car_pct")),
    ]
    g = "Formulation and wash"
    out += [
        f(g, "f_formulated_total_concentration", "formulated_concentration formulated_viability", _over("formulated_concentration", "formulated_viability", 1e-4)),
        f(g, "f_cells_into_formulation", "washed_concentration formulation_cell_volume", _times("washed_concentration", "formulation_cell_volume")),
        f(g, "f_cells_out_of_formulation", "formulated_concentration formulation_medium_volume", _times("formulated_concentration", "formulation_medium_volume")),
        f(g, "f_cells_lost_formulation", "f_cells_into_formulation f_cells_out_of_formulation", _minus("f_cells_into_formulation", "f_cells_out_of_formulation")),
        f(g, "f_pct_lost_formulation", "f_cells_lost_formulation f_cells_into_formulation", _over("f_cells_lost_formulation", "f_cells_into_formulation", 100.0)),
        f(g, "f_cells_lost_wash", "harvest_cells washed_cells", _minus("harvest_cells", "washed_cells")),
        f(g, "f_wash_recovery", "washed_cells harvest_cells", _over("washed_cells", "harvest_cells")),
    ]
    g = "Vector certificate"
    out += [
        f(g, "f_coa_impurity_index", "|".join(IMPURITIES), _impurity_index, site_relative=True),
        f(g, "f_coa_impurity_spec_index", "|".join(IMPURITIES), _spec_index(s), setting="impurity_spec_limits"),
        f(g, "f_vector_age", "date_start coa_made", lambda i: E.minutes_between(i.time("date_start"), i.time("coa_made")) / 1440),
    ]
    g = "Cytokine"
    out += [f(g, f"f_il2_{d}", f"il2_activity_{d} il2_content_{d}", _times(f"il2_activity_{d}", f"il2_content_{d}", 0.001)) for d in ("d6", "d8")]
    hours, minutes = (int(x) for x in s.shift_cutoff.split(":")[:2])
    shift = lambda i: F.when(_seconds(i, "thaw_time") < hours * 3600 + minutes * 60, "Morning").when(_seconds(i, "thaw_time").isNotNull(), "Afternoon")
    out.append(f("Context", "f_shift", "thaw_time", shift, kind="categorical"))
    for column in columns:
        for marker, target, unit in ((v.name("co2_marker"), s.co2_target, "pct"), (v.name("temperature_marker"), s.temp_target, "C")):
            if marker in column:
                out.append(Feature(column, (column,), lambda i, column=column, target=target: F.abs(i(column) - target), "Environment", name=f"{column} dev_from_{target}{unit}"))
                break
    return out


def process_day(column: str) -> str:
    """The process day that a column's name gives, else Context."""
    found = re.search(r"\bday\s*(\d+)|\bD(0|10|1|3|6|8)\b", column, re.IGNORECASE)
    return f"D{found[1] or found[2]}" if found else "Context"


@dataclass
class Applied:
    """Each feature with its status: not in catalog, present, blocked or created (and errored, with what was wrong)."""

    entries: list[dict] = field(default_factory=list)
    levels: int = 0

    def count(self, status: str) -> int:
        return sum(e["status"] == status for e in self.entries)


def apply(df: DataFrame, features: Sequence[Feature], settings: Settings, vocabulary: Vocabulary | None = None, catalog: Sequence[str] | None = None) -> tuple[DataFrame, Applied]:
    """df with the features that can be made. catalog: only names that it lists are made (None: all).

    Statuses take precedence as Applied lists them. A feature is made at the first level at which its inputs are there.
    """
    v, report = vocabulary or Vocabulary(), Applied()
    listed = None if catalog is None else set(catalog)
    waiting: list[tuple[Feature, str]] = []
    name_of = lambda f: f.name or v.name(f.key)
    for f in features:
        name, status, why = name_of(f), "", ""
        if listed is not None and name not in listed:
            status = "not in catalog"
        elif name in df.columns:
            status = "present"
        elif unset := [x for x in f.setting.split() if getattr(settings, x) is None]:
            status, why = "blocked", "unset: " + ", ".join(unset)
        if status:
            report.entries.append({"feature": name, "group": f.group, "status": status, "why": why})
        else:
            waiting.append((f, name))
    while waiting:
        i = Inputs(df, v)
        ready, later = {}, []
        for f, name in waiting:
            met = all(any(map(i.has, (r,) if isinstance(r, str) else r)) for r in f.requires)
            # With alternatives, a better one may still be on its way.
            coming = any(n == v.name(k) for r in f.requires for k in ((r,) if isinstance(r, str) else r) for g, n in waiting if g is not f)
            if not met or coming:
                later.append((f, name))
                continue
            try:
                ready[name] = f.compute(i)
                report.entries.append({"feature": name, "group": f.group, "status": "created", "why": ""})
            except (ValueError, TypeError, KeyError) as fault:
                report.entries.append({"feature": name, "group": f.group, "status": "errored", "why": str(fault)})
        if not ready:
            blocked = [(f, n) for f, n in later if not all(any(map(i.has, (r,) if isinstance(r, str) else r)) for r in f.requires)]
            for f, name in blocked:
                needs = [r if isinstance(r, str) else " or ".join(r) for r in f.requires if not any(map(i.has, (r,) if isinstance(r, str) else r))]
                report.entries.append({"feature": name, "group": f.group, "status": "blocked", "why": "missing: " + ", ".join(needs)})
            if not blocked:
                raise ValueError("features that need each other: " + ", ".join(n for _, n in later))
            waiting = [w for w in later if w not in blocked]
            continue
        df = df.withColumns(ready)
        report.levels += 1
        waiting = later
    return df, report


def lineage(features: Sequence[Feature], vocabulary: Vocabulary | None = None) -> dict[str, tuple[str, ...]]:
    """What each feature may be computed from, alternatives included."""
    v = vocabulary or Vocabulary()
    return {f.name or v.name(f.key): tuple(v.name(k) for r in f.requires for k in ((r,) if isinstance(r, str) else r)) for f in features}


def descendants(target: str, parents: dict[str, tuple[str, ...]], names: Sequence[str] = ()) -> set[str]:
    """Everything computed from target, however indirectly, with the columns that say a value was censored."""
    found = {target}
    while new := {k for k, needs in parents.items() if k not in found and found.intersection(needs)} | {n for n in names if n not in found and n.removesuffix(" censored") in found}:
        found |= new
    return found - {target}
