import datetime as dt
import json

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from loomspark import cli
from loomspark.operators import cohort, corrections, encode
from loomspark.plans import build, config, dataset, events, leaks, manifest, provenance, recipe, report, spec
from loomspark.sources import readers, sinks
from loomspark.streaming import apply as streaming

CATALOG = [("Batch", "categorical"), ("Start", "datetime"), ("Yield (%)", "numeric"), ("Cells", "numeric"), ("Team", "categorical"), ("Grade", "[Low, Mid, High]"), ("Lot", "categorical"), ("Titer", "numeric"), ("Never", "numeric"), ("f_wash_recovery", "numeric"), ("harvest_cells", "numeric"), ("washed_cells", "numeric"), ("Team", "numeric"), ("Odd", "mystery")]


def inputs(spark, n=60):
    rows = [(f"B{i}", f"2024-01-{i % 28 + 1:02d}", f"{50 + i % 17}", "<5" if i % 9 == 0 else f" {i * 3 % 41} ", "red blue green".split()[i % 3], ("Low", "Mid", "High")[i % 3], f"L{i % 4}", f"{1000 + i * 7}", f"{900 + i * 5}", None) for i in range(n)]
    df = spark.createDataFrame(rows, "Batch string, Start string, `Yield (%)` string, Cells string, Team string, Grade string, Lot string, harvest_cells string, washed_cells string, Never string")
    catalog = readers.read_catalog(spark.createDataFrame(CATALOG, "Parameter string, `Value Type` string"))
    lots = spark.createDataFrame([(f"L{k}", 1.0 * k) for k in range(4)], "Lot string, Titer double")
    rules = [corrections.Rule("team", "Team", "replace_values", pairs=(("blue", "navy"),))]
    return build.Inputs({"A": df, "B": df.limit(5)}, catalog, {}, rules, [(lots, "Lot", "lots")])


def conf(tmp_path):
    return config.validated({"site": "A", "sites": {"A": "a", "B": "b"}, "output": str(tmp_path), "cleaning": {"censored": "half"}})


def test_catalog(spark):
    c = inputs(spark).catalog
    assert len(c.names) == 13 and c.orders() == {"Grade": ["Low", "Mid", "High"]} and len(c.warnings) == 2
    assert build.check_catalog(inputs(spark)) == {"A": [], "B": []}


def test_build_and_task_end_to_end(spark, tmp_path):
    made = build.run_build(spark, inputs(spark), conf(tmp_path), order="Start")
    record = json.loads((made / "manifest.json").read_text())
    assert manifest.verify(made / "manifest.json") == [] and record["stage"] == "build"
    table = spark.read.parquet(record["table"])
    assert "Never" not in table.columns and table.where("Team = 'navy'").count() == 20
    assert table.where("Batch = 'B0'").select("Cells", "Titer", F.round("f_wash_recovery", 3)).first() == (2.5, 0.0, 0.9)
    assert sinks.payload_of((made / "report.html").read_text())["title"] == "Batch table"
    (made / "features.csv").write_text("changed")
    assert manifest.verify(made / "manifest.json") == ["features.csv: changed"]

    task = spec.parse({"task": {"name": "yield"}, "site": "A", "target": {"column": "Yield (%)"}, "roles": {"id": "Batch", "group": "Lot"}, "cohort": {"filters": [{"column": "Cells", "min": 3}]}, "predictors": {"exclude": [{"column": "Start", "reason": "a date"}]}})
    catalog = inputs(spark).catalog
    run = build.run_task(spark, table, task, str(tmp_path / "runs"), catalog)
    assert manifest.verify(run / "manifest.json") == []
    assert build.rerun(spark, run, table, task, catalog=catalog)
    rows, lacking = build.encode_rows(run, table.drop("Cells"), ["Batch"])
    assert lacking == ["Cells"] and rows.count() == 60
    left = {r.split(",")[0]: r.split(",")[1] for r in (run / "left_out.csv").read_text().splitlines()[1:]}
    assert left["Start"] == "task" and left["Batch"] == "role"


def test_dataset_parts_agree(spark):
    table = build.batch_table(inputs(spark), {"site": "A"}).table
    d = dataset.build(table, spec.parse({"target": {"column": "Yield (%)"}, "roles": {"id": "Batch"}}), inputs(spark).catalog)
    assert dataset.consistent(d) == [] and "grade_rank" in d.recipe.output
    assert {c["parameter"]: c["unit"] for c in d.columns}.get("Yield (%)") is None
    assert report.task_payload(spec.Task(), d)["blocks"][0]["kind"] == "heading"


def test_recipe_round_trip_stage_and_stream(spark, tmp_path):
    rows = [(i, float(i % 7) if i % 5 else None, "abc"[i % 3], float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, f"id int, x double, c string, {cohort.TARGET} double")
    fitted = recipe.fit(df, ["x", "c"], recipe.Options(action="off", indicators=True))
    again = recipe.Recipe.loads(fitted.dumps())
    want = sorted(fitted.transform(df, ["id"]).collect())
    assert sorted(again.transform(df, ["id"]).collect()) == want and again.output == ["x", "c_a", "c_b", "c_c", "x_missing"]
    assert sorted(Pipeline(stages=[recipe.TaskTransformer(predictors=["x", "c"], options=recipe.Options(action="off", indicators=True), keep=["id"])]).fit(df).transform(df).collect()) == want
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df.write.parquet(source)
    streaming.write(spark.readStream.schema(df.schema).parquet(source), again, out, str(tmp_path / "cp"), ["id"]).awaitTermination()
    assert sorted(spark.read.parquet(out).collect()) == want
    with pytest.raises(ValueError, match="version"):
        recipe.Recipe.loads('{"version": 1}')


def test_recipe_unknown_and_missing_categories(spark):
    df = spark.createDataFrame([(v, float(i)) for i, v in enumerate("aabbbccccd" * 3)], f"c string, {cohort.TARGET} double")
    r = recipe.fit(df, ["c"], recipe.Options(encode=encode.Knobs(top=2), impute=False))
    new = spark.createDataFrame([("zz",), (None,)], "c string")
    assert [tuple(x) for x in r.transform(new).collect()] == [(0, 0, 1), (None, None, None)]


def test_recipe_drops_thin_and_flat_outputs_and_names_proxies(spark):
    rows = [(i, 2.0 * i, float(i * 7 % 5) if i < 19 else None, 3.0 + 1e-6 * (i % 2), float(i % 4)) for i in range(40)]
    df = spark.createDataFrame([(float(i), *more) for i, *more in rows], f"{cohort.TARGET} double, near double, thin double, flat double, x double")
    r = recipe.fit(df, ["near", "thin", "flat", "x"], recipe.Options(action="off"))
    assert r.output == ["near", "x"] and {d["column"]: d["stage"] for d in r.dropped} == {"thin": "sparse", "flat": "constant"}
    assert r.notes == ["near is nearly the target"] and r.medians == {}
    with pytest.raises(ValueError, match="every predictor was dropped"):
        recipe.fit(df, ["thin"], recipe.Options(action="off"))


def test_events_of_a_run(tmp_path):
    log = events.EventLog()
    log.warn("a", "before")
    mark = log.mark()
    log.step("a", "go", "with detail")
    for _ in range(2):
        log.warn("a", "odd")
    log.error("b", "bad")
    said = log.since(mark)
    assert events.told(said, "warning") == ["a: odd (2 times)"] and events.summary(said)["errors"] == 1
    assert events.text(said).count("\n") == 5 and "before" not in events.text(said)
    with pytest.raises(ValueError):
        log.add("loud", "a", "b")


def test_config_and_task_tell_all_faults():
    with pytest.raises(ValueError, match="unknown section x.*site.*output.*censored"):
        config.validated({"x": 1, "sites": {"A": "a"}, "cleaning": {"censored": "maybe"}})
    with pytest.raises(ValueError, match="HOME_OF_NOTHING"):
        config.validated({"site": "A", "sites": {"A": "${HOME_OF_NOTHING}"}, "output": "o"}, {})
    with pytest.raises(ValueError, match="unknown section y.*target.column.*two roles|two roles"):
        spec.parse({"y": 1, "target": {}, "roles": {"id": "a", "group": "a"}})
    with pytest.raises(ValueError, match="overlap"):
        spec.parse({"target": {"column": "d", "kind": "periods", "periods": [{"label": "a", "from": "2024-01-01", "to": "2024-02-01"}, {"label": "b", "from": "2024-02-01", "to": "2024-03-01"}]}})
    assert spec.parse(__import__("yaml").safe_load(spec.template("t", "y"))).target.column == "y"


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "t.csv").write_text("﻿Lot;Query[Medium lot]\n A ;1\n;2\n", encoding="utf-8")
    df = readers.read_table(spark, str(tmp_path / "t.csv"))
    assert df.columns == ["Lot", "Query[Medium lot]"]
    assert readers.raw_materials(df, "Lot").columns == ["Lot", "Medium lot"] and readers.supplement(df, ["x", "Lot"])[0].count() == 1
    assert readers.optional(spark, readers.Source("gone", str(tmp_path / "gone.parquet")))[0] is None
    with pytest.raises(ValueError, match="worksheets"):
        readers.read_table(spark, "a.xlsx")
    with pytest.raises(ValueError, match="outside"), sinks.package(tmp_path, "p") as pkg:
        pkg.text("../x", "")
    assert list((tmp_path / "p").glob("*.failed"))
    log = [readers.screening.Decision(1, "S-0001", "2024-01-01", "a", "A", "quality", "exclude", "r")]
    sinks.write_register(spark, log, str(tmp_path / "reg.parquet"))
    assert readers.register(spark, str(tmp_path / "reg.parquet"), ["A"]) == log
    with pytest.raises(ValueError, match="changed"):
        readers.register(spark, str(tmp_path / "reg.parquet"), ["A"], "0")
    words = spark.createDataFrame([("column", "k", "Name {day}"), ("list", "l", "x"), ("list", "l", "y")], "Kind string, Key string, Name string")
    v = readers.vocabulary(words)
    assert v.name("k", day=3) == "Name 3" and v.names("l") == ("x", "y") and v.name("other") == "other"
    sinks.write_names(spark, ["b", "a", "a"], str(tmp_path / "new"))
    assert [r[0] for r in spark.read.csv(str(tmp_path / "new"), header=True).collect()] == ["a", "b"]
    (tmp_path / "f").write_text("1")
    assert sinks.upload({"f.txt": tmp_path / "f"}, tmp_path / "up")[0].read_text() == "1"


def test_small_parts(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 4.0)], "i int, x double")
    assert report.histogram(df, "x", 2)["counts"] == [1, 1] and report.missing_strings(df, ["x"], "i") == {"x": "010"} and report.missing_strings(df, ["x"], "i", most=2) == {"x": "00"}
    assert provenance.capture(spark, [], {"a": 1})["environment"]["pyspark"]
    f = tmp_path / "a.txt"
    f.write_text("the Secret Name\nSecret Names")
    assert [x["line"] for x in leaks.scan([f], ["secret name", "abc"])] == [1]
    assert cli.main(["verify", str(tmp_path / "none.json")]) == 1
    (tmp_path / "c.yaml").write_text(f"site: A\nsites: {{A: a}}\noutput: {tmp_path}\n")
    assert cli.main(["--config", str(tmp_path / "c.yaml"), "validate"]) == 0
    assert cli.main(["task", "new", str(tmp_path / "q"), "--target", "y"]) == 0 and spec.load(tmp_path / "q" / "task.yaml").name == "q"
    assert dataset.unit_of("a (g/L)") == "g/L" and dt.date.today()
