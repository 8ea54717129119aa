"""run() against a brute-force version of its stages."""

import brute
from cases import ODD
from pyspark.sql import functions as F
from test_text import _check_packing

import corpus_pipeline
from loomspark.llm import bpe, quality, secrets


def test_run_equals_the_stages_by_hand(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r["doc_id"] for r in quality.quality_rules(docs).where("kept").collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id in kept)
    bare = {}
    for i, t in rows:
        bare.setdefault("".join(brute.WORDS.findall(t)), []).append((-len(t), i))
    stay = {min(g)[1] for g in bare.values()}
    rows = [(i, t) for i, t in rows if i in stay]
    groups = brute.groups({i: brute.fingerprint(t) for i, t in rows})
    rows = [(i, t) for i, t in rows if groups[i] == i]
    scan, coder = secrets.scanner(), bpe.Bpe(bpe.default_vocabulary())
    texts = {i: secrets.redacted(t, scan.spans(t.encode())) for i, t in rows}
    lengths = {i: len(coder.encode([t])[0]) // 4 + 1 for i, t in texts.items()}
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in got} == set(lengths)
    used, least = _check_packing(got, lengths)
    assert used <= least + 1


def test_stages_keep_columns_and_survive_odd_rows(spark, docs, empty, tmp_path):
    for k, start in enumerate((docs(ODD), empty)):
        df = start.withColumn("_key", F.lit(1))
        for j, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, df, "")
            if j < 4:
                assert out.columns == df.columns
                out.write.parquet(str(tmp_path / f"{k}-{j}"))
                df = spark.read.parquet(str(tmp_path / f"{k}-{j}"))
        assert out.count() >= 0
