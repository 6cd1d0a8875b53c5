import hashlib

import numpy as np
import pytest

import corpus_pipeline as C
from cases import docs, near_components, no_docs, odd_docs, table
from ledgerline.llm import line_rules as L
from ledgerline.llm.common import materialise
from test_bpe_transducer import LIB
from test_pfair_mix import simulate
from test_secret_scan import brute


def redact(text):
    out, at = "", 0
    for s, e, _ in brute(text):
        if s >= at:
            out += text[at:s] + "[redacted]"
        at = max(at, e)
    return out + text[at:]


def test_run_against_brute_force(spark):
    """Rows of the whole pipeline; the line rules, which have SQL of their own, are taken from their operator."""
    d = table(spark, "documents")
    kept = {r["doc_id"]: r for r in L.cleaned(d).collect()}
    of = near_components([(i, r["text"]) for i, r in kept.items()])
    want = {}
    for i, r in kept.items():
        if of[i] == i:
            text = redact(r["text"])
            ids = LIB.encode_ordinary(text)
            want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256(text.encode()).hexdigest(), ids)
    got = {r["doc_id"]: tuple(r)[1:] for r in C.run(spark, "/root/testdata/sf0.001").collect()}
    assert got == want


def test_stages_return_the_columns_of_documents(spark):
    for d in (odd_docs(spark, clashes=False), odd_docs(spark), no_docs(spark)):
        now = d
        for name, stage in C.STAGES[:-1]:
            now = materialise(stage(spark, now, ""), "test-stage")
            assert now.columns == d.columns, name
        C.STAGES[-1][1](spark, now, "").collect()


def test_the_mixture_is_in_the_files(spark):
    d = table(spark, "documents")
    hashes = {r["doc_id"]: r["h"] % 2**64 for r in d.selectExpr("doc_id", "xxhash64(doc_id) h").collect()}
    want = simulate([(r["source"], hashes[r["doc_id"]], r["doc_id"]) for r in d.select("source", "doc_id").collect()], {}, 64)
    out = dict(C.STAGES)["mixture"](spark, d, "")
    parts = out.rdd.glom().collect()
    assert [r["doc_id"] for p in parts for r in p] == want


@pytest.mark.parametrize("text, stays", [("too short", False), ("word " * 100, False)])
def test_rejected_documents_go(spark, text, stays):
    assert bool(dict(C.STAGES)["quality rules"](spark, docs(spark, {1: text}), "").collect()) == stays
