import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspark.functions import exprs as E
from loomspark.functions import stats
from loomspark.operators import clean, cohort, correlation, corrections, decorrelate, encode, enrich, merge, missingness, screening, shifts, similarity


def values(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


# --- expressions ---------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("text", "want"), [(" 1.5 ", 1.5), ("1e3", 1000.0), ("NaN", None), ("1d", None), ("inf", None), ("1_000", None), ("0x1A", None), ("abc", None), ("1e400", None), ("", None), (None, None), ("-.5", -0.5)])
def test_number(spark, text, want):
    assert spark.createDataFrame([(text,)], "x string").select(E.number("x")).first()[0] == want


def test_times(spark):
    rows = [("2024-1-2",), ("8:30",), ("08:30:15",), ("2024-01-02 03:04:05.5",), ("2024-01-02 03:04:05",), ("2024-13-01",), ("x",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "x string").select(E.moment("x")).collect()]
    assert got == [dt.datetime(2024, 1, 2), dt.datetime(1900, 1, 1, 8, 30), dt.datetime(1900, 1, 1, 8, 30, 15), dt.datetime(2024, 1, 2, 3, 4, 5, 500000), dt.datetime(2024, 1, 2, 3, 4, 5), None, None, None]


def test_censored_policies_and_commas(spark):
    df = spark.createDataFrame([("<0,5",), (">3",), ("0,5",), ("7",)], "x string")
    assert [tuple(r) for r in df.select(*(E.censored_number("x", p) for p in E.CENSORED_POLICIES)).collect()] == [(0.5, 0.25, None), (3.0, 1.5, None), (None, None, None), (7.0, 7.0, 7.0)]


def test_strip_and_ratio(spark):
    df = spark.createDataFrame([("  a\u00a0b\t", "1 : 2:3"), (" ", "x"), (None, None)], "a string, b string")
    assert [tuple(r) for r in df.select(E.strip("a"), E.ratio_right("b")).collect()] == [("ab", "2:3"), (None, "x"), (None, None)]


# --- corrections, cleaning -----------------------------------------------------------------------------------------


def test_rules_tell_all_faults():
    with pytest.raises(ValueError, match="row 1.*row 2.*row 3"):
        corrections.from_rows([{"Name": "", "Column": "a", "Action": "set"}, {"Name": "n", "Column": "a", "Action": "jump"}, {"Name": "d", "Column": "a", "Action": "divide_by", "New": "0"}])


def test_rules_round_trip():
    rules = [corrections.Rule("r", "a", "replace_values", pairs=(("x", "y"), ("z", ""))), corrections.Rule("d", "b", "divide_by", 10.0, site="A")]
    assert corrections.from_rows(corrections.to_rows(rules)) == rules


def test_corrections_count_conditions_and_disabled(spark):
    df = spark.createDataFrame([("x", " go "), ("x", "stop"), (None, "go")], "a string, b string")
    rules = [corrections.Rule("s", "a", "set", "new", when_column="b", when_equals="go"), corrections.Rule("off", "a", "set", "no"), corrections.Rule("gone", "c", "set", "no")]
    out, log = corrections.apply(df, rules, corrections.INTEGRITY, disabled=["off"])
    assert [r[0] for r in out.collect()] == ["new", "x", "new"]
    assert [(o.rows, bool(o.skipped)) for o in log] == [(2, False), (0, True), (0, True)]


def test_clean_counts(spark):
    df = spark.createDataFrame([(" 5 ", "105", "2024-01-01", "1:30", ""), ("<2", "50", "soon", "90", "keep "), ("odd", None, None, "x", None)], "`n` string, `Share (%)` string, d string, t string, other string")
    out, report = clean.clean(df, {"n": "numeric", "Share (%)": "numeric", "d": "datetime", "t": "duration"}, "A", clean.Options(censored_flags=True))
    assert values(out, "n", "n censored", "t", "other")[:2] == [(5.0, 0, 90.0, None), (2.0, 1, 90.0, "keep ")]
    assert report.cells_stripped == {"n": 1} and report.unreadable == {"n": 1, "d": 1, "t": 1}
    assert report.out_of_percent == {"Share (%)": 1} and report.censored == {"n": 1} and report.examples["n"] == ["odd"]


def test_yes_no_uses_the_columns_spelling(spark):
    df = spark.createDataFrame([("Yes",), (None,), ("Yes",)], "x string")
    out, report = clean.clean(df, {"x": "categorical"}, options=clean.Options(yes_no_defaults={"x": "no"}))
    assert [r[0] for r in out.collect()] == ["Yes", "No", "Yes"] and report.filled == {"x": 1}


# --- joins, sites --------------------------------------------------------------------------------------------------


def test_contradicting_lookup_is_refused(spark):
    df = spark.createDataFrame([("a",), (None,), (" b ",)], "k string")
    twice = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(enrich.AmbiguousLookup, match="a"):
        enrich.lookup_join(df, twice, "k")
    fine = spark.createDataFrame([("a ", 1), ("a", 1), (None, 9), ("b", 2)], "k string, v int")
    assert sorted(values(enrich.lookup_join(df, fine, "k"), "k", "v"), key=str) == [(" b ", 2), ("a", 1), (None, None)]


def test_unused_and_expand(spark):
    lots = spark.createDataFrame([("L2",), ("L1",), ("L3",)], "lot string")
    assert [r[0] for r in enrich.unused(lots, lots.where("lot = 'L3'"), "lot").collect()] == ["L1", "L2"]
    first = spark.createDataFrame([("ab", "one", 1), ("cd", "old", 2)], "k string, v string, i int")
    later = spark.createDataFrame([("CD", "new", 1)], "k string, v string, i int")
    df = spark.createDataFrame([("ab",), ("cd ",), ("zz",), (None,)], "c string")
    out, unknown = enrich.expand(df, "c", enrich.last_wins([first, later], "k", "v", "i"))
    assert sorted(map(str, (r[0] for r in out.collect()))) == ["None", "ZZ", "new", "one"] and [r[0] for r in unknown.select("_code").collect()] == ["ZZ"]


def test_renames_collide_in_order():
    assert merge.renamed(["a", "b", "X_1"], {"a": "X", "b": "X"}) == ["X", "X_2", "X_1"]


def test_union_mixed_types_and_new_parameters(spark):
    a, b = spark.createDataFrame([(1, "x")], "n int, s string"), spark.createDataFrame([("y", 2.5)], "n string, t double")
    out = merge.union_sites({"A": a, "B": b})
    assert sorted(values(out, "n", "s", "t", merge.SITE)) == [("1", "x", None, "A"), ("y", None, 2.5, "B")]
    assert merge.new_parameters(["Known  One"], {"s": ["known one", "Query[New]"]}) == {"s": ["New"]}
    assert merge.never_recorded(out.withColumn("e", F.lit(None).cast("int")), ["e", "n"])[1] == ["e"]


def test_certificates(spark):
    raw = spark.createDataFrame([("L1", "yes", "3,40E+07", None, "10", "<0,5", "42,0%", "40,0%"), ("L2", "no", "1", "1", "1", "1", "1%", "1%")], "lot string, ok string, titer string, titer_raw string, vol string, dna string, d1 string, d2 string")
    out = enrich.certificates(raw, "lot", ("ok", "yes"), ["dna"], "half", names={"titer": "titer", "titer_raw": "titer_raw", "volume": "vol"}, donors={"CAR": ("d1", "d2")}).first()
    assert out["titer"] == 3.4e7 and out["dna"] == 0.25 and out["dna below LOQ"] == 1 and out["Delivered dose"] == 3.4e8
    assert out["CAR DIFF"] == pytest.approx(0.02) and out["CAR MAX"] == pytest.approx(0.42)


# --- cohorts -------------------------------------------------------------------------------------------------------


def test_missing_policy(spark):
    df = spark.createDataFrame([("done",), ("Withdrawn ",), ("withdrawn",), ("WITHDRAWN",), (None,), (None,)], "s string")
    for policy, left in (("include", 3), ("exclude", 1)):
        assert cohort.select(df, [cohort.Filter("s", "not_equals", "withdrawn", policy, normalise=True)])[0].count() == left


def test_date_window_ends_at_midnight_and_periods_do_not(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 31, 0, 0),), (dt.datetime(2024, 1, 31, 9, 0),)], "t timestamp")
    assert cohort.select(df, [], ("t", dt.date(2024, 1, 1), dt.date(2024, 1, 31)))[0].count() == 1
    y = cohort.period_target(df, "t", [("a", dt.date(2024, 1, 1), dt.date(2024, 1, 31))], "a")
    assert [r[0] for r in df.select(y).collect()] == [1.0, 1.0]


def test_binary_target_needs_two_classes(spark):
    df = spark.createDataFrame([("pass",), ("pass",)], "s string")
    with pytest.raises(ValueError, match="two classes"):
        cohort.with_target(df, cohort.binary_target("s", ["pass"]), "s", binary=True)


def test_predictor_cascade():
    chosen, out = cohort.predictors(["id", "y", "a", "b", "c", "d"], [{"Parameter": "b", "Stage": "late"}], roles=["id"], target="y", excluded=["a"], categories={"Stage": ((), ("late",))}, leaking=["c", "a"])
    assert chosen == ["d"] and [o["stage"] for o in out] == ["role", "target", "task", "category", "lineage"]


def test_grouping_units(spark):
    df = spark.createDataFrame([("g1", "p1"), ("g2", "p1"), ("g2", "p2"), ("g3", None), (None, None), ("g4", "p2")], "g string, p string")
    got = {(r["g"], r["p"]): r["_unit"] for r in cohort.grouping_units(df, "g", "p").collect()}
    assert got["g1", "p1"] == got["g4", "p2"] == "g1+g2+g4" and got["g3", None] == "g3" and got[None, None] == "(missing)"


# --- encoders ------------------------------------------------------------------------------------------------------


def test_one_hot_tail_named_other(spark):
    df = spark.createDataFrame([(v,) for v in ["Other"] * 5 + ["A"] * 4 + ["B"] * 3 + ["C", "D"]] + [(None,)], "c string")
    state = encode.fit_one_hot(df, "c", set(), encode.Knobs(top=2))
    assert state["categories"] == ["Other", "A"] and state["rest"] == "Other (rare)"
    total = df.select(*(F.sum(x) for x in encode.applied(state).values())).first()
    assert tuple(total) == (5, 4, 5)


def test_crossfit_does_not_see_its_fold(spark):
    rows = [(i, "ab"[i % 2], float(i), i % 3) for i in range(12)]
    df = spark.createDataFrame(rows, "i int, c string, y double, f int")
    before = {r["i"]: r["m"] for r in encode.crossfitted(df, "c", "y", "f", "m").collect()}
    moved = df.withColumn("y", F.when(F.col("f") == 0, F.col("y") + 1000).otherwise(F.col("y")))
    after = {r["i"]: r["m"] for r in encode.crossfitted(moved, "c", "y", "f", "m").collect()}
    assert all(before[i] == after[i] for i in range(12) if i % 3 == 0) and any(before[i] != after[i] for i in range(12) if i % 3)


def test_chronological_folds(spark):
    df = spark.createDataFrame([(i, "a", float(i)) for i in range(9)], "i int, c string, y double")
    folded = encode.folds(df, 3, order="i")
    got = {r["i"]: r["m"] for r in encode.crossfitted(folded, "c", "y", "_fold", "m", 0.0, chronological=True).collect()}
    assert got[0] is None and got[3] == 1.0 and got[8] == 2.5


def test_groups_stay_together(spark):
    df = spark.createDataFrame([(f"g{i % 7}", i) for i in range(70)], "g string, i int")
    assert encode.folds(df, 3, groups="g").groupBy("g").agg(F.count_distinct("_fold").alias("n")).where("n > 1").count() == 0


def test_hash_agrees_with_md5(spark):
    import hashlib

    for text in ("abc", "é", ""):
        bucket, sign = spark.createDataFrame([(text,)], "v string").select(*E.bucket_and_sign("c", "v", 16)).first()
        d = hashlib.md5(f"c\0{text}".encode()).digest()
        assert (bucket, sign) == (int.from_bytes(d[:8], "big") % 16, 1 if d[8] % 2 == 0 else -1)


# --- numbers -------------------------------------------------------------------------------------------------------


def test_average_and_complete_linkage_differ():
    s = np.array([[1, 0.97, 0.86], [0.97, 1, 0.96], [0.86, 0.96, 1]])
    assert stats.clusters(s, 0.9, "average") == [[0, 1, 2]] and stats.clusters(s, 0.9, "complete") == [[0, 1]]
    assert stats.clusters(np.array([[1, np.nan], [np.nan, 1]]), 0.1) == []


def test_tails():
    assert stats.student_two_sided(2.228138852, 10) == pytest.approx(0.05, abs=1e-8)
    assert stats.student_two_sided(0, 5) == 1.0
    assert stats.benjamini_hochberg([0.01, 0.04, 0.03, math.nan])[:3] == pytest.approx([0.03, 0.04, 0.04])


def test_rank_groups(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(size=90)
    rows = [tuple(map(float, r)) for r in np.column_stack([a, np.exp(a), -(a**3), 2 * a, a + 1, rng.normal(size=90)])]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, noise double")
    df = df.withColumn("b", F.when(F.col("a") > df.agg(F.min("a")).first()[0], F.col("b")))
    groups, closest = correlation.rank_groups(df, df.columns)
    assert len(groups) == 1 and len(groups[0].members) == 5 and groups[0].weakest > 0.99 and groups[0].shared == 89
    assert {m["parameter"]: m["sign"] for m in groups[0].members}["c"] == -{m["parameter"]: m["sign"] for m in groups[0].members}["a"]


def test_spearman_on_spark_equals_driver(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(200, 4)), 1)
    x[rng.random(x.shape) < 0.1] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], "a double, b double, c double, d double")
    here, there = similarity.spearman(df, df.columns), similarity.spearman(df, df.columns, cells_in_task=0)
    assert np.allclose(here.r, there.r, atol=1e-12) and (here.n == there.n).all()


def test_vif_and_duplicates(spark):
    df = spark.createDataFrame([(float(i), float(i * i), float(2 * i)) for i in range(20)], "a double, b double, c double")
    assert decorrelate.most_inflated(df, ["a", "c"]) == math.inf and decorrelate.most_inflated(df, ["a", "b"]) > 1
    assert math.isnan(decorrelate.most_inflated(df.limit(2), ["a", "b"]))
    assert decorrelate.duplicates(similarity.pearson(df, df.columns)) == {"c": "a"}


def test_cluster_actions(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=120)
    rows = [(float(v), float(2 * v + e), float(n)) for v, e, n in zip(base, rng.normal(scale=0.1, size=120), rng.normal(size=120))]
    df = spark.createDataFrame(rows, "a double, b double, noise double")
    for action, want in (("describe", {"a", "b", "noise"}), ("keep_one", 2), ("summarise", {"noise", "G1_score"}), ("residualise", {"a", "b", "noise"})):
        f = decorrelate.fit(df, df.columns, action)
        assert f.clusters[0]["stability"] == 1.0
        got = set(decorrelate.transform(df, f).columns)
        assert got == want or len(got) == want
    r = similarity.pearson(decorrelate.transform(df, decorrelate.fit(df, df.columns, "residualise")), ["a", "b"])
    assert abs(r.of("a", "b")) < 1e-6


def test_near_constant(spark):
    df = spark.createDataFrame([(1.0, 0.015228), (1.0, 0.0)], "a double, b double")
    assert encode.near_constant(df, ["a", "b"]) == ["a"]


# --- missing values ------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("bits", "want"), [("0" * 40, "Complete"), ("1" * 40, "Never recorded"), ("01" * 20, "Regular skipping"), ("1" * 20 + "0" * 20, "Late start"), ("0" * 20 + "1" * 20, "Stopped"), ("1" * 10 + "0" * 20 + "1" * 10, "Late start and stopped"), ("0" * 10 + "1" * 20 + "0" * 10, "One long gap")])
def test_patterns(spark, bits, want):
    df = spark.createDataFrame([(i, None if b == "1" else 1) for i, b in enumerate(bits)], "t int, x int")
    assert missingness.profiles(df, ["x"], "t", "t").first()["pattern"] == want


def test_missing_groups(spark):
    df = spark.createDataFrame([(None if i % 4 == 0 else 1, None if i % 4 == 0 else 1, None if i % 5 == 0 else 1, "ab"[i % 4 == 0]) for i in range(60)], "a int, b int, c int, k string")
    groups = missingness.groups(df, ["a", "b", "c"])
    assert [g.members for g in groups] == [["a", "b"]] and groups[0].tightness == 1.0
    best = missingness.explained(df, ["a", "b"], ["k"])[0]
    assert best["score"] == pytest.approx(1.0) and best["category"] == "b" and best["rate"] == 1.0


# --- shifts --------------------------------------------------------------------------------------------------------


def test_shift_counts_and_segments(spark):
    a = np.array
    assert shifts.count_groups(a([0, 1, 1, 2]), a([0, 0, 1, 1])) == 2
    assert shifts.segments(a([0, 1, 1, 2]), a([0, 0, 1, 1])) == [[0, 1, 0], [1, 2, 1]] or shifts.segments(a([0, 1, 1, 2]), a([0, 0, 1, 1])) == [[0, 1, 0], [1, 1, 1], [2, 2, 1]]
    assert shifts.count_groups(a([0, 0, 1, 1, 2, 2]), a([0, 1, 0, 1, 0, 1])) == 4
    assert [shifts.count_groups(a([0, 1, 2]), a(c)) for c in ([0, 0, 1], [0, 1, 0])] == [2, 3]
    rows = [(0, d, v) for d, v in zip([0, 0, 1, 1, 2, 2], [0, 1, 0, 1, 0, 1])] + [(1, d, v) for d, v in zip([0, 1, 1, 2], [0, 0, 1, 1])]
    got = {r["s"]: r["groups"] for r in shifts.group_count(spark.createDataFrame(rows, "s int, d int, v int"), ["s"], "d", "v").collect()}
    assert got == {0: 4, 1: 2}


def test_lots_shift_together(spark):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=i // 3), f"lot{i // 10}", f"titre{i // 10}", "xyz"[i % 3]) for i in range(240)]
    found = shifts.tested(spark.createDataFrame(rows, "t timestamp, lot string, titre string, other string"), ["lot", "titre", "other"], "t").collect()
    by = {r["column"]: r for r in found}
    assert by["lot"]["groups"] == 24 and by["lot"]["kept"] and not by["other"]["kept"]
    assert shifts.shift_groups(found) == [["lot", "titre"]]


# --- screening -----------------------------------------------------------------------------------------------------


def test_register(spark):
    sites, today = ["North", "South"], dt.date(2026, 1, 1)
    log = screening.add([], [{"parameter": "a", "site": "all", "track": "quality", "action": "exclude", "reason": "bad"}], sites, ["a", "b"], "me", today)
    log = screening.add(log, [{"parameter": "a", "site": "South", "track": "quality", "action": "reinstate"}], sites, ["a", "b"], "me", today)
    assert values(screening.excluded(screening.frame(spark, log), sites), "parameter", "site") == [("a", "North")]
    with pytest.raises(ValueError, match="row 1.*row 2"):
        screening.add(log, [{"parameter": "z", "site": "North", "track": "quality", "action": "exclude", "reason": "r"}, {"parameter": "b", "site": "North", "track": "quality", "action": "exclude"}], sites, ["a", "b"], "me", today)
    assert screening.digest(log) != screening.digest(log[:1])
    due = screening.review(screening.frame(spark, log), sites, spark.createDataFrame([("a", "North", 50.0)], "parameter string, site string, missing_pct double"), dt.date(2026, 5, 1))
    assert values(due, "parameter", "due", "drifted") == [("a", True, False)]


# --- whole inputs --------------------------------------------------------------------------------------------------


def test_queries_see_all_rows(spark, sf):
    from loomspark import queries

    part, events = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("part", "events"))
    assert queries.bh_adjust(spark, sf).count() == part.count()
    assert queries.shift_tests(spark, sf).where("column = 'kind'").agg(F.sum("values")).first()[0] == events.where("ts is not null and event_type is not null").count()
    days = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    bounds = {r[0]: (r[1], r[2]) for r in events.groupBy((F.col("user_id") % 6).cast("string")).agg(F.min(days), F.max(days)).collect()}
    assert {r[0]: (r[1], r[2]) for r in queries.shift_segments(spark, sf).groupBy("key").agg(F.min("first"), F.max("last")).collect()} == bounds
    assert queries.shift_segments(spark, sf).count() == queries.shift_counts(spark, sf).agg(F.sum("groups")).first()[0]
    assert part.where("p_size % 2 = 0").count() + part.where("p_size % 2 = 1").count() == part.count()


def _plain_segments(held: dict[int, set]) -> list[tuple]:
    """(first, last, value), day by day: the carrier goes on if it can, else the least value that both days have."""
    open_, carrier, out = {}, None, []
    for day in sorted(held):
        both = sorted(v for v in held[day] if v in open_)
        goes_on = carrier if carrier in both else both[0] if both else None
        out += [[day, day, v] for v in sorted(held[day]) if v != goes_on]
        if goes_on is not None:
            open_[goes_on][1] = day
        open_ = {v: open_[v] if v == goes_on else next(s for s in reversed(out) if s[2] == v and s[0] == day) for v in held[day]}
        carrier = goes_on if goes_on is not None else carrier if carrier in held[day] else None
    return sorted(map(tuple, out))


def test_shift_segments_equal_plain_python(spark):
    rng = np.random.default_rng(7)
    rows = [(int(s), int(d), f"v{v}") for s in range(8) for d in range(30) for v in rng.choice(5, rng.integers(0, 4))]
    df = spark.createDataFrame(rows + rows[:9], "s int, d int, v string")
    got = {}
    for r in shifts.segment_rows(df, "s", "d", "v").collect():
        got.setdefault(int(r["key"]), []).append((r["first"], r["last"], r["value"]))
    for s in range(8):
        held = {}
        for _, d, v in (r for r in rows if r[0] == s):
            held.setdefault(d, set()).add(v)
        assert sorted(got[s]) == _plain_segments(held)


def test_shift_tests_equal_plain_python(spark, sf):
    import zlib

    from loomspark import queries

    def groups(pairs):
        held = {}
        for d, v in pairs:
            held.setdefault(d, set()).add(v)
        sets = [held[d] for d in sorted(held)]
        return sum(map(len, sets)) - sum(bool(a & b) for a, b in zip(sets, sets[1:]))

    events = spark.read.parquet(f"{sf}/events.parquet").selectExpr("cast(user_id % 2 as string) plant", "datediff(to_date(ts), date'1970-01-01') d", "cast(cast(datediff(to_date(ts), date'2024-01-01') / 5 as int) as string) lot", "event_type kind").collect()
    for r in queries.shift_tests(spark, sf).collect():
        pairs = sorted((e["d"], e[r["column"]]) for e in events if e["plant"] == r["plant"])
        assert (r["values"], r["days"], r["groups"]) == (len(pairs), len({d for d, _ in pairs}), groups(pairs))
        names = sorted({v for _, v in pairs})
        code, rng, hits = np.array([names.index(v) for _, v in pairs]), np.random.default_rng(zlib.crc32(f"{r['plant']}\0{r['column']}".encode())), 0
        if r["days"] / r["groups"] >= 2:
            for _ in range(200):
                hits += groups(zip((d for d, _ in pairs), rng.permutation(code).tolist())) <= r["groups"]
            assert r["p"] == pytest.approx((1 + hits) / 201, abs=1e-6)
        else:
            assert r["p"] == 1.0
        assert r["kept"] == (r["p"] <= 0.01)


def test_adjusted_by_ranges_as_in_memory(spark):
    rng = np.random.default_rng(3)
    p = [*np.round(rng.random(3000) ** 2, 3).tolist(), math.nan, None]
    got = {r["i"]: r["q"] for r in correlation.adjusted(spark.createDataFrame(list(enumerate(p)), "i int, p double").repartition(5), "p", "q").collect()}
    want = stats.benjamini_hochberg([math.nan if x is None else x for x in p])
    assert len(got) == len(p) and got[3000] is None and got[3001] is None
    assert [got[i] for i in range(3000)] == pytest.approx(want[:3000].tolist(), abs=1e-12)


def test_count_groups_of_many_rows():
    rng = np.random.default_rng(5)
    for _ in range(50):
        day, code = rng.integers(0, 9, 40), rng.integers(0, 6, 40)
        held = {d: set(code[day == d].tolist()) for d in sorted(set(day.tolist()))}
        sets = list(held.values())
        assert shifts.count_groups(day, code) == sum(map(len, sets)) - sum(bool(a & b) for a, b in zip(sets, sets[1:]))


# --- beyond any bound ----------------------------------------------------------------------------------------------


def test_category_differences_are_all_told(spark):
    a = spark.range(3000).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("k"), F.lit("x").alias("only"))
    b = a.where("k <> 'v5'").where("length(k) < 5").select("k").union(spark.createDataFrame([("new",), (None,)], "k string"))
    out = clean.category_differences({"A": a, "B": b}, ["k", "only"])
    rows = values(out, "column", "value", "only_at", "not_at")
    assert len(rows) == 2000 + 2 and ("k", "v5", "A", "B") in rows and ("k", "new", "B", "A") in rows
    assert clean.category_differences({"A": a, "B": b}, ["only"]) is None


def test_explainers_pool_their_tail_and_need_values(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, None).otherwise(1).alias("x"), F.when(F.col("id") % 3 == 0, None).otherwise(F.lit("a")).alias("twin"), F.when(F.col("id") % 10 < 8, "big").otherwise(F.concat(F.lit("s"), (F.col("id") % 25).cast("string"))).alias("tail"), F.when(F.col("id") % 5 == 0, "rare").alias("seldom"), F.when(F.col("id") % 3 == 0, "p").otherwise(F.when(F.col("id") % 2 == 0, "q")).alias("own"))
    found = {r["column"]: r for r in missingness.explained(df, ["x"], ["twin", "tail", "seldom", "own"], missingness.Bounds(categories=(2, 50)))}
    assert set(found) == {"tail", "own"}  # one value; too seldom there
    assert found["own"]["self_correlated"] and not found["tail"]["self_correlated"] and found["own"]["category"] == "p"
    many = spark.range(60_000).select(F.when(F.col("id") % 2 == 0, 1).alias("x"), F.when(F.col("id") < 10_000, "c0").otherwise((F.col("id") / 2).cast("int").cast("string")).alias("k"))
    best = missingness.explained(many, ["x"], ["k"], missingness.Bounds(categories=(2, 40_000), rows_per_category=1))[0]
    assert best["category"] == "other" and best["covers"] == pytest.approx(25_000 / 30_000)


def test_phi():
    assert stats.phi(10, 5, 5, 5) == 1.0 and stats.phi(10, 5, 5, 0) == -1.0 and stats.phi(10, 0, 5, 0) == 0.0


def test_folds_of_many_groups_are_even(spark):
    df = spark.range(40_000).select(F.when(F.col("id") < 12_000, 0).otherwise((F.col("id") % 13_000) + 1).cast("string").alias("g"), "id")
    rows = encode.folds(df, 5, groups="g").groupBy("_fold").agg(F.count(F.lit(1)).alias("n"), F.max((F.col("g") == "0").cast("int")).alias("hot")).collect()
    sizes = sorted(r["n"] for r in rows)
    assert sizes[-1] == 12_000 and sum(sizes) == 40_000 and max(sizes[:4]) - min(sizes[:4]) < 40
    assert encode.folds(df, 5, groups="g").groupBy("g").agg(F.count_distinct("_fold").alias("k")).where("k > 1").count() == 0


def test_routing_by_the_declared_bounds(spark):
    df = spark.range(96).select(F.concat(F.lit("c"), (F.col("id") % 24).cast("string")).alias("four"), F.concat(F.lit("d"), (F.col("id") % 16).cast("string")).alias("six"), F.when(F.col("id") % 2 == 0, "done").otherwise("open").alias("state"))
    assert {c: e for c, (e, _) in encode.route(df, df.columns).items()} == {"four": "one_hot", "six": "target", "state": "binary"}
    assert encode.route(df, ["six"], encode.Knobs(target_encoding=False, one_hot=False))["six"][0] == "skip"
    assert encode.route(df, ["four"], encode.Knobs(least_rows=50))["four"][0] == "hash"
    assert encode.fit_binary(df, "state", set())["positive"] == "open"
    signed, plain = (encode.fit_hashed(df, "six", set(), encode.Knobs(hashing_signed=k)) for k in (True, False))
    low = lambda s: df.select(F.least(*encode.applied(s).values()).alias("x")).agg(F.min("x")).first()[0]
    assert low(signed) == -1 and low(plain) == 0
    with pytest.raises(ValueError, match="over 10 categories"):
        encode.fit_target(df.withColumn("y", F.lit(1.0)), "four", "y", set(), encode.Knobs(most_means=10))


def test_usable_representative():
    g = correlation.RankGroup("C1", "a", [{"parameter": "a", "score": 0.9}, {"parameter": "b", "score": 0.8}], 0.9, 10)
    assert [correlation.usable_representative(g, x) for x in ((), ("a",), ("a", "b"))] == ["= suggested", "b", ""]


def test_groups_of_parameters(spark):
    df = spark.createDataFrame([("p", "g2"), ("p", "g1"), ("q", "g1"), ("p", "g1")], "parameter string, group string")
    assert sorted(values(enrich.groups_of(df), "parameter", "groups")) == [("p", "g1; g2"), ("q", "g1")]
