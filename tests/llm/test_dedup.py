import random

import brute
import pytest
from cases import ODD
from oracle import expected, got
from pyspark.sql import functions as F

from loomspark.llm import exact_dedup, line_dedup, queries, simhash, suffix_dedup
from loomspark.operators import components


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_sql(spark, sf, name):
    assert got(queries.QUERIES[name](spark, sf)) == expected(queries.ORACLE_SQL[name], sf)


# --- exact ---------------------------------------------------------------------------------------------------------


def test_exact_odd_rows(odd, empty):
    rows = exact_dedup.exact_dedup(odd).collect()
    assert len(rows) == len(ODD) and exact_dedup.exact_dedup(empty).count() == 0
    by = {(r["doc_id"], r["keep_id"], r["group_size"]) for r in rows}
    assert {(1, 3, 3), (2, 3, 3), (3, 3, 3), (4, 5, 4), (None, 5, 4), (5, 5, 4), (6, 6, 1)} <= by
    assert sum(r["kept"] for r in rows) == 6
    kept = exact_dedup.without_copies(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 5, 6, 7, 8, 9]


def test_exact_of_repeated_rows_one_stays(docs):
    rows = exact_dedup.exact_dedup(docs([(1, "a b"), (1, "a b"), (1, "ab"), (None, "z"), (None, "z")])).collect()
    assert sum(r["kept"] for r in rows) == 2 and {r["group_size"] for r in rows} == {2, 3}


def test_bitmap_steps_do_not_change_the_answer(docs):
    rows = [(i, f"{'ab' * (i % 5)} text {i % 11}") for i in range(200)]
    want = sorted(exact_dedup.exact_dedup(docs(rows)).collect())
    assert sorted(exact_dedup.exact_dedup(docs(rows), prefix_chars=1, bitmap_bits=64).collect()) == want


# --- lines ---------------------------------------------------------------------------------------------------------


def test_lines(docs, spark, empty):
    df = docs([(i, f"head\nown {i}\n foot \n\nhead") for i in range(9)] + [(10, None), (11, "foot")]).withColumn("source", F.when(F.col("doc_id") == 11, F.lit(None)).otherwise((F.col("doc_id") % 4).cast("string")))
    out = {r["doc_id"]: r for r in line_dedup.line_dedup(df, least_sites=4).collect()}
    assert (out[0]["text"], out[0]["n_removed"], out[0]["n_lines"]) == ("own 0\n", 3, 5)
    assert out[11]["text"] == "" and out[10]["n_lines"] == 1
    assert {r["n_removed"] for r in line_dedup.line_dedup(df, least_sites=5).collect()} == {0}
    assert line_dedup.line_dedup(empty).count() == 0


def test_lines_odd_rows(odd):
    assert line_dedup.line_dedup(odd, least_sites=2).count() == len(ODD)


# --- near copies ---------------------------------------------------------------------------------------------------


def test_simhash_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    fps = {i: brute.fingerprint(t) for i, t in texts.items()}
    groups = brute.groups(fps)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op9_simhash(spark, sf).collect()} == {i: (f"{fps[i]:016x}", groups[i]) for i in fps}


def test_links_reach_every_pair_within_three_bits(spark):
    rng = random.Random(1)
    fps = [rng.getrandbits(64) for _ in range(40)]
    for f in list(fps):
        for _ in range(6):
            for _ in range(rng.randint(1, 4)):
                f ^= 1 << rng.randrange(64)
            fps.append(f)
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"))
    root = {r["node"]: r["root"] for r in components.components(links).collect()}
    want = brute.groups(dict(zip(signed, fps)))
    assert {f: root.get(f, f) for f in signed} == want


def test_simhash_odd_rows(odd, empty):
    rows = simhash.simhash_groups(odd).collect()
    assert len(rows) == len(ODD) and simhash.simhash_groups(empty).count() == 0
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["fingerprint"] == "0" * 16 and by[3]["component_id"] == by[2]["component_id"] == 1 and by[None]["component_id"] == 4
    kept = simhash.without_near_copies(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted({r["component_id"] for r in rows})


LICENCE = "This software is given as it is, without a promise of any kind, and nobody answers for what it does. "


# --- passages ------------------------------------------------------------------------------------------------------


def _checked(df):
    rows = df.select("doc_id", "text").collect()
    want = brute.suffix([(r.doc_id if r.doc_id is not None else 1 << 62, (r.text or "").encode()) for r in rows])
    out = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.suffix_dedup(df).collect()))
    assert out == sorted((r.doc_id is None, r.doc_id or 0, *want[k]) for k, r in enumerate(rows))


def test_passages_of_shared_and_repeated_text(docs):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcé ") for _ in range(rng.randint(1, 7)))
    passages = [" ".join(word() for _ in range(rng.randint(8, 40))) for _ in range(12)] + ["a" * 120, "ab" * 45, "\n" * 70]
    rows = [(i, "".join(rng.choice(passages)[rng.randint(0, 9) :] + word() for _ in range(rng.randint(1, 6)))) for i in range(120)]
    _checked(docs(rows + rows[:7], partitions=5))


def test_passages_query(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    _checked(df)
    assert queries.op6_suffix_dedup(spark, sf).columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_passages_odd_rows(odd, empty):
    _checked(odd)
    assert suffix_dedup.suffix_dedup(empty).count() == 0


@pytest.mark.parametrize("bits", [4, 12])
def test_passages_when_hashes_collide(docs, monkeypatch, bits):
    """With polynomial hashes of few bits many strings collide; what is removed stays the same."""
    real = suffix_dedup.Hashed.of
    monkeypatch.setattr(suffix_dedup.Hashed, "of", lambda self, a, b: real(self, a, b) & suffix_dedup.np.uint64((1 << bits) - 1))
    rng = random.Random(6)
    passages = ["".join(rng.choice("ab c") for _ in range(rng.randint(40, 160))) for _ in range(6)]
    texts = [(i, "".join(rng.choice(passages)[rng.randint(0, 60) :] for _ in range(4)).encode()) for i in range(12)]
    out = []
    data = suffix_dedup.np.frombuffer(b"".join(t for _, t in texts), dtype="u1")
    edges = suffix_dedup.np.concatenate([[0], suffix_dedup.np.cumsum([len(t) for _, t in texts])])
    found = suffix_dedup.cells(data, edges)
    contents = [data[a : b + 50].tobytes() for a, b in zip(found["a"], found["b"])]
    shared = suffix_dedup.shared_windows(found["key"].astype("i8"), found["doc"].astype("i8"), (found["p"] - found["a"]).astype("i8"), contents)
    gone = {i: bytearray(len(t)) for i, t in texts}
    for c, o in zip(*suffix_dedup.np.nonzero(shared)):
        at = int(found["p"][c]) - int(o) - int(edges[found["doc"][c]])
        gone[int(found["doc"][c])][at : at + 50] = b"\1" * 50
    want = brute.suffix(texts)
    assert {i: sum(g) for i, g in gone.items()} == {k: w[1] for k, w in want.items()}
    assert len(set(contents)) == len({(int(x), int(y)) for x, y in zip(found["d0"], found["d1"])})


def test_large_places_and_small_batches(docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "LARGE_GROUP", 6)
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcde ") for _ in range(rng.randint(20, 70)))
    tail = word()
    tables, written = {}, suffix_dedup.written
    monkeypatch.setattr(suffix_dedup, "written", lambda df, label: tables.setdefault(label, written(df, label)))
    _checked(docs([(i, word() + LICENCE + (tail if i % 3 else word())) for i in range(60)]))
    assert tables["suffix-firsts"].count() and tables["suffix-contents"].where("h is null").count()


def test_cells_are_compared_place_by_place(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(suffix_dedup, "CELLS_AT_ONCE", 3)
    seen = []
    monkeypatch.setattr(suffix_dedup, "_removed", lambda t: seen.append(t.column("place").to_pylist()) or t)
    batches = [pa.RecordBatch.from_arrays([pa.array(p, pa.int64())], ["place"]) for p in ([1, 1], [1, 1], [2, 2, 2, 3], [], [3, 3, 3], [4, 4, 4])]
    list(suffix_dedup._compared_cells(iter(batches)))
    assert sum(seen, []) == [1] * 4 + [2] * 3 + [3] * 4 + [4] * 3 and all(set(a).isdisjoint(b) for a, b in zip(seen, seen[1:]))


def test_passages_need_whole_number_ids(docs):
    with pytest.raises(TypeError, match="doc_id is string"):
        suffix_dedup.suffix_dedup(docs([(1, "a")]).withColumn("doc_id", F.lit("x")))


def test_long_texts_are_sampled_in_parts(docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "AT_ONCE", 1000)
    data = suffix_dedup.np.frombuffer(b"abc" * 500, dtype="u1")
    found = suffix_dedup.cells(data, suffix_dedup.np.array([0, 700, 1500]))
    assert (found["a"] <= found["b"]).all() and (found["p"] >= found["b"]).all()
    windows = sum((found["b"] - found["a"] + 1).tolist())
    assert windows == (700 - 49) + (800 - 49)


def test_suffixes_are_sorted_with_common_prefixes():
    rng = random.Random(5)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 40))) for _ in range(200)]
    order, lcp = suffix_dedup.sorted_suffixes([suffix_dedup.Suffix(t, i) for i, t in enumerate(texts)])
    assert [s.data for s in order] == sorted(texts)
    for x, y, n in zip(order, order[1:], lcp[1:]):
        assert x.data[:n] == y.data[:n] and (x.data[n : n + 1] != y.data[n : n + 1] or n == min(len(x.data), len(y.data)))
