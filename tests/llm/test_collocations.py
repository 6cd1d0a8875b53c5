import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import SCHEMA, docs, lower, no_docs, odd_docs, odd_rows, table
from ledgerline.llm import collocations as C

TEXT = st.lists(st.sampled_from(["a", "B", "b", "é", "日本", " ", "  ", "\t", "\n", ".", ",", "!", "\x0b", "\r", "\x00", "word", "\x1c"]),
                max_size=40).map("".join)


def pieces_of(text):
    return [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text or ""))]


def counts_of(rows, longest):
    """Brute force: (lang, words) and its number, and the number of all words of a language."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for w in pieces_of(text):
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    return f, n


def brute(rows, least, longest, top, share):
    f, n = counts_of(rows, longest)
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    out = []
    for (lang, w), a in cand.items():
        cuts = [(Fraction(1000000 * a * a, f[lang, w[:k]] * f[lang, w[k:]]).__floor__(), k, f[lang, w[:k]], f[lang, w[k:]])
                for k in range(1, len(w))]
        score, _, left, right = min(cuts)
        inside = any(v == lang and len(x) > len(w) and 100 * b >= share * a
                     and any(x[i:i + len(w)] == w for i in range(len(x) - len(w) + 1)) for (v, x), b in cand.items())
        if not inside:
            out.append((lang, -score, -a, " ".join(w).encode(), left, right))
    found = []
    for lang in {x[0] for x in out}:
        first = sorted(x for x in out if x[0] == lang)[:top]
        found += [(lang, k, p.decode(), -a, left, right, n[lang], -s) for k, (_, s, a, p, left, right) in enumerate(first, 1)]
    return sorted(found)


@pytest.mark.parametrize("least, longest, top, share", [(10, 3, 2000, 50), (2, 3, 7, 50), (2, 4, 50, 80), (3, 2, 2000, 50)])
def test_small_texts_against_brute_force(spark, least, longest, top, share):
    r = random.Random(least * longest)
    rows = [(" ".join(r.choice(["the", "The", "old", "mill", "a b", "x.", "y,", "é", "日本"]) for _ in range(r.randint(0, 30))),
             r.choice(["en", "de", None, "und"])) for _ in range(60)]
    rows += [(None, "en"), ("", None), ("so so so so so so", "fr")] * 3
    d = spark.createDataFrame([(k, t, v, None, None) for k, (t, v) in enumerate(rows)], SCHEMA).repartition(4)
    got = sorted(tuple(x) for x in C.collocations(d, least, longest, top, share).collect())
    assert got == brute(rows, least, longest, top, share)


def test_odd_cases(spark):
    rows = [(r[1], r[2]) for r in odd_rows()]
    assert sorted(tuple(x) for x in C.collocations(odd_docs(spark), 2).collect()) == brute(rows, 2, 3, 2000, 50)
    assert C.collocations(no_docs(spark)).collect() == []
    assert C.collocations(docs(spark, {1: None, 2: "", 3: "a b c"})).collect() == []


def test_more_buckets_and_a_full_bit_set_change_nothing(spark, monkeypatch):
    d = table(spark, "documents")
    want = sorted(tuple(x) for x in C.collocations(d).collect())
    monkeypatch.setattr(C, "BUCKET_BYTES", 4000)
    monkeypatch.setattr(C, "MOST_BITS", 10)
    assert sorted(tuple(x) for x in C.collocations(d).collect()) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=5), st.integers(1, 4))
def test_words_and_pieces(texts, block):
    old, C.BLOCK = C.BLOCK, block
    try:
        w = C.Words(texts)
    finally:
        C.BLOCK = old
    want = [(x.encode(), k) for k, t in enumerate(texts) for p in pieces_of(t) for x in p]
    assert [(w.word(k), int(w.text[k])) for k in range(len(w.hash))] == want
    number, first = w.distinct()
    assert [w.word(int(first[n])) for n in number] == [x for x, _ in want]
    bounds = [len(p) for t in texts for p in pieces_of(t) if p]
    assert np.diff(np.flatnonzero(np.concatenate([[True], w.piece[1:] != w.piece[:-1], [True]])) if len(w.hash) else []).tolist() == bounds


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXT, max_size=6), st.booleans())
def test_equal_hashes_are_told_apart(texts, all_equal):
    langs = [(None, "en", "und", "")[k % 4] for k in range(len(texts))]
    f, n = counts_of(zip(texts, langs), 3)
    plain = C.Words.hashed
    if all_equal:  # every word's first hash is the same
        C.Words.hashed = lambda self, salt: plain(self, salt) * np.uint64(salt > 0)
    try:
        got = Counter()
        for b in C.counted(texts, langs, np.full(128, 255, np.uint8), 10, 3):
            for lang, p, words, count in zip(*(c.to_pylist() for c in b.columns)):
                got[lang, tuple(p.split(" ")) if words else ()] += count
    finally:
        C.Words.hashed = plain
    want = Counter({**f, **{(v, ()): c for v, c in n.items()}})
    assert +got == +want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=60), max_size=8), st.integers(1, 9))
def test_no_frequent_key_is_lost(parts, least):
    true = Counter(x for p in parts for x in p)
    s = C.Summary(sum(true.values()) // least + 1)
    for p in parts:
        keys, counts = np.unique(np.array(p, np.uint64), return_counts=True)
        s.add(keys, counts)
        s.merge()  # as often as can be
        assert len(s.keys) <= s.capacity
    found = s.survivors(least)
    assert s.error < least and {x for x, c in true.items() if c >= least} <= set(found.tolist())
    counter = dict(zip(s.keys.tolist(), s.counts.tolist()))
    assert all(counter.get(x, 0) <= c <= counter.get(x, 0) + s.error for x, c in true.items())


def test_long_words_and_pieces():
    long = "x" * 300_000
    texts = [f"{long} y {long}", "y " * 200_000, None]
    f, n = counts_of([(t, "en") for t in texts], 3)
    got = Counter()
    for b in C.counted(texts, ["en"] * 3, np.full(128, 255, np.uint8), 10, 3):
        for p, words, count in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
            got[tuple(p.split(" ")) if words else ()] += count
    assert got == Counter({**{w: c for (_, w), c in f.items()}, (): n["en"]})


def test_products_beyond_64_bits(spark, monkeypatch):
    big = 40_000_000_000
    counts = spark.createDataFrame([("en", "", 0, 3 * big), ("en", "a", 1, big), ("en", "b", 1, big + 7), ("en", "a b", 2, big - 3)],
                                   "lang string, phrase string, words int, f long")
    monkeypatch.setattr(C, "phrase_counts", lambda *a: counts)
    want = 1000000 * (big - 3) ** 2 // (big * (big + 7))
    assert [tuple(r) for r in C.collocations(None).collect()] == [("en", 1, "a b", big - 3, big, big + 7, 3 * big, want)]
