"""Formulas by hand."""

import datetime as dt

import pytest

from loomspark.operators import derive
from loomspark.operators.vocabulary import Vocabulary

ALL = derive.Settings(moi_target=0.5, medium_glucose=4.5, medium_lactate=0.5, impurity_spec_limits=(10.0,) * 5)


def made(spark, rows, wanted, settings=ALL, schema=None):
    df = spark.createDataFrame(rows, schema) if schema else spark.createDataFrame(rows)
    out, report = derive.apply(df, derive.registry(settings, df.columns), settings)
    return [tuple(r[w] if w in out.columns else "absent" for w in (wanted if isinstance(wanted, tuple) else (wanted,))) for r in out.collect()], report


def close(a, b):
    assert [x == pytest.approx(y, abs=1e-9) if isinstance(y, float) else x == y for r, s in zip(a, b) for x, y in zip(r, s)] and all(x == pytest.approx(y, abs=1e-9) if isinstance(y, float) else x == y for r, s in zip(a, b) for x, y in zip(r, s))


def test_there_are_98_fixed_features():
    assert len(derive.registry(ALL)) == 98


def test_cells_and_shares(spark):
    rows, _ = made(spark, [{"pt_viable_cells": 1e8, "pt_cd3_pct": 80.0, "pt_cd4_pct": 50.0}], ("f_pt_cd3_cells", "f_pt_cd4_share", "f_pt_cd4_cells"))
    close(rows, [(8e7, 40.0, 4e7)])


def test_lactate_per_cell_by_vessels(spark):
    schema = "vessel_count double, d6_lactate_a double, d6_lactate_b double, harvest_lactate double, vsvg_cells double"
    rows, _ = made(spark, [(1.0, 1.0, None, 2.0, 1e8), (2.0, 1.0, 0.5, 2.0, 1e8), (3.0, 1.0, 0.5, 2.0, 1e8)], ("f_lactate_per_cell_d6", "f_lactate_per_cell_d10"), schema=schema)
    close(rows[:2], [(10.0, 20.0), (15.0, 40.0)])
    assert rows[2][0] is None


def test_growth_profile_needs_both(spark):
    schema = "cpdl double, f_harvest_lactate_norm double"
    rows, _ = made(spark, [(4.5, 5.0), (5.5, 31.0), (4.5, 20.0), (4.5, None), (None, 5.0)], "f_growth_profile", schema=schema)
    assert [r[0] for r in rows] == ["slow", "fast", "typical", None, None]


def test_increments_slope_and_area(spark):
    rows, _ = made(spark, [{f"f_lactate_per_cell_d{d}": v for d, v in ((6, 10.0), (8, 15.0), (10, 25.0))}], ("f_lactate_increment_1", "f_lactate_increment_2", "f_lactate_slope", "f_lactate_auc"))
    close(rows, [(5.0, 10.0, 3.75, 65.0)])


def test_yield_is_blocked_without_its_setting(spark):
    row = {"harvest_lactate": 2.5, "harvest_glucose": 2.5}
    close(made(spark, [row], "f_lactate_yield_d10")[0], [(1.0,)])
    rows, report = made(spark, [row], "f_lactate_yield_d10", derive.Settings())
    assert rows == [("absent",)] and report.count("blocked") > 0


def test_seeding(spark):
    rows, _ = made(spark, [{"vessel_count": 1.0, "vsvg_cells": 5e7}, {"vessel_count": 2.0, "vsvg_cells": 1.1e8}], ("f_seeding_pct", "f_seeding_error", "f_seeding_within"))
    close(rows, [(100.0, 0.0, 1.0), (110.0, 10.0, 0.0)])
    rows, _ = made(spark, [{"cells_available": 1e8, "cells_seeded_a": 4e7, "cells_seeded_b": 5e7, "d3_viability": 80.0}], ("f_seeding_loss", "f_dead_cells_d3"))
    close(rows, [(0.1, 2.5e7)])


def test_vessel_balance(spark):
    rows, _ = made(spark, [(30.0, 10.0), (40.0, None)], ("f_seeded_mean", "f_seeded_imbalance"), schema="cells_seeded_a double, cells_seeded_b double")
    close(rows, [(20.0, 0.5), (40.0, None)])


def test_moi(spark):
    schema = "coa_titer double, vector_volume_a double, vector_volume_b double, cells_available double, coa_pi_ratio double"
    rows, _ = made(spark, [(1e7, 2.0, None, 4e7, 100.0)], ("f_moi_pool", "f_moi_vs_target", "f_moi_quality"), schema=schema)
    close(rows, [(0.5, 1.0, 50.0)])


def test_contact_window_keeps_missing(spark):
    rows, _ = made(spark, [(100.0,), (200.0,), (None,)], "f_contact_within", schema="contact_time double")
    assert [r[0] for r in rows] == [1.0, 0.0, None]


def test_times_and_shift(spark):
    day = dt.datetime(2026, 1, 5)
    at = lambda h, m: day.replace(hour=h, minute=m)
    schema = "thaw_time string, incubator_in_d0 timestamp, incubator_out_d3 timestamp, incubator_back_d3 timestamp"
    rows, _ = made(spark, [("08:30", at(9, 15), at(9, 0), at(11, 30)), ("13:00", at(9, 15), at(11, 0), at(9, 0)), (None, None, None, None)], ("f_thaw_to_incubator", "f_out_of_incubator_d3", "f_shift"), schema=schema)
    close(rows, [(45.0, 150.0, "Morning"), (None, None, "Afternoon"), (None, None, None)])


def test_dose_and_wash(spark):
    rows, _ = made(spark, [(2e6, None), (None, 1e8), (None, None)], ("f_dose_all", "f_dose_basis"), schema="dose_per_kg double, dose_cells double")
    close(rows, [(2.0, "weight based"), (1.0, "fixed"), (None, None)])
    close(made(spark, [{"harvest_cells": 1e9, "washed_cells": 8e8}], ("f_wash_recovery", "f_cells_lost_wash"))[0], [(0.8, 2e8)])


def test_impurities_and_age(spark):
    row = {k: 5.0 for k in derive.IMPURITIES} | {"date_start": dt.datetime(2026, 1, 11), "coa_made": dt.datetime(2026, 1, 1)}
    close(made(spark, [row], ("f_coa_impurity_spec_index", "f_coa_impurity_index", "f_vector_age"))[0], [(2.5, None, 10.0)])


def test_environment_and_statuses(spark):
    df = spark.createDataFrame([(6.5, 1.0)], "`Day 6 CO2 (%)` double, f_il2_d6 double")
    s, v = derive.Settings(), Vocabulary({"co2_marker": "CO2", "temperature_marker": "Temperature"})
    out, report = derive.apply(df, derive.registry(s, df.columns, v), s, v)
    assert out.first()["Day 6 CO2 (%) dev_from_5.0pct"] == 1.5
    assert {e["feature"]: e["status"] for e in report.entries}["f_il2_d6"] == "present"
    assert report.levels <= 2
    _, listed = derive.apply(df, derive.registry(s, df.columns, v), s, v, catalog=[])
    assert listed.count("not in catalog") == 99


def test_lineage_closes_over_alternatives():
    parents = derive.lineage(derive.registry(ALL))
    found = derive.descendants("cells_available", parents, ["cells_available censored", "other"])
    assert {"f_moi_pool", "f_log_moi_pool", "f_moi_vs_target", "cells_available censored"} <= found and "other" not in found


def test_levels_not_one_projection_each(spark):
    df = spark.createDataFrame([(50.0, 60.0, 40.0, 50.0)], "pt_cd4_pct double, pt_cd8_pct double, pw_cd4_pct double, pw_cd8_pct double")
    assert derive.apply(df, derive.registry(ALL), ALL)[1].levels == 2
