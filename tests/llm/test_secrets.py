import random

import brute
from hypothesis import given, settings
from hypothesis import strategies as st

from loomspark.llm import queries, secrets
from loomspark.llm.automaton import compile_rules

PARTS = ["password", "passwd", "SeCret", "token", "api_key", "apikey", "=", ":", " ", '"', "'", "abc", "abcdef12", "AKIA", "ABCDEFGHIJ0123456789", "0123456789abcdef", "é", "\n", "/", ".", "x", "ghp_", "eyJ", "xoxb-"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14))
def test_base_spans_are_those_of_regular_expressions(parts):
    text = "".join(parts)
    assert [s for s in secrets.scanner().spans(text.encode()) if s[1] < 3] == brute.secrets(text)


def test_minimal_automaton_reads_what_its_pattern_does():
    import re

    rng = random.Random(3)
    for pattern in ("a(b|c)*d", "(?i:ab)+c?", "[a-c]{2,4}d", "a{3}|b{2,}"):
        d = compile_rules([pattern], anchored=True)
        for _ in range(2000):
            text = "".join(rng.choice("abcdAB") for _ in range(rng.randrange(7)))
            s = d.start
            for b in text.encode():
                s = d.table[s + b]
            assert (s in d.accepts) == bool(re.fullmatch(pattern, text))
    assert len(compile_rules(["(a|b)(a|b)", "aa|ab|ba|bb"], anchored=True).table) // 256 == 4


def test_other_kinds():
    text = "é ghp_" + "a1" * 20 + " eyJhbGci.eyJzdWIi.c2ln -----BEGIN RSA PRIVATE KEY----- xoxb-1234567890abcdef"
    kinds = [secrets.RULES[k].kind for _, k, _ in secrets.scanner().spans(text.encode()) if k > 2]
    assert kinds == ["hub", "jwt", "private", "chat"]


def test_query_over_whole_table(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op1_secret_scan(spark, sf).collect():
        found = brute.secrets(texts[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == j for _, k, _ in found) for j in range(3))
        assert r.base_sha256 == brute.sha(",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in found))


def test_odd_rows(odd, empty):
    got = secrets.secret_scan(odd)
    assert got.count() == odd.count() and secrets.secret_scan(empty).count() == 0
    spans = {r["doc_id"]: r["spans"] for r in got.collect()}
    assert spans[1] == spans[2] == "" and spans[7] == "assign:7:28"


def test_masking(odd, spark):
    out = secrets.without_secrets(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    text = {r["doc_id"]: r["text"] for r in out.collect()}
    assert text[7] == "é日本 👍🏽 [assign]' end" and text[1] is None and text[2] == ""
