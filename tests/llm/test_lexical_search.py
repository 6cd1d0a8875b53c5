import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from cases import CLASHES, docs, lower, no_docs, odd_docs, odd_rows
from ledgerline.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, items, k=50):
    held = [(i, Counter(TERM.findall(lower(t or "")))) for i, t in rows]
    held = [(i, c) for i, c in held if c]
    total, mass = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall(lower(t or "")))
    out = []
    for item, terms in asked.items():
        found = []
        for i, c in held:
            m = 100 - 50 + (50 * sum(c.values()) * total) // mass
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m))
                    for t in terms if t in c)
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def found(spark, d, items, k=50):
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", *[f"{v} AS {n}" for n, v in CLASHES.items()])
    return sorted((tuple(r) for r in L.search(d, i, k).collect()), key=str)


@pytest.mark.parametrize("k, shard, step", [(50, 1 << 20, 64), (3, 40, 1), (1, 1, 1)])
def test_small_tables_against_brute_force(spark, monkeypatch, k, shard, step):
    monkeypatch.setattr(L, "SHARD", shard)
    monkeypatch.setattr(L, "FIRST_STEP", step)
    r = random.Random(k)
    words = ["mill", "Mill", "river", "éa", "日本", "x9", "the", "the", "the", "old-door", "\x00n"]
    texts = {n: " ".join(r.choices(words, k=r.randint(0, 25))) for n in range(150)} | {200 + n: "the old mill" for n in range(60)} | {300: None, 301: ""}
    items = [(1, "the mill"), (2, "RIVER éa 日本 x9 none"), (3, None), (4, ""), (5, "nowhere"), (None, "old door"), (None, "n"),
             (7, "mill"), (7, "river"), (8, " ".join(words))]
    assert found(spark, docs(spark, texts).repartition(3), items, k) == brute(list(texts.items()), items, k)


def test_odd_cases(spark):
    items = [(1, "The river ran past the old mill"), (2, "word é x " + "x" * 70_000), (3, "no end")]
    assert found(spark, odd_docs(spark), items) == brute([(r[0], r[1]) for r in odd_rows()], items)
    assert found(spark, no_docs(spark), items) == []
    assert found(spark, odd_docs(spark), []) == []
    assert L.search(odd_docs(spark), odd_docs(spark).selectExpr("doc_id item_id", "text").limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_CHARS", 12)
    texts = {n: f"a{n % 3} b{n % 5} c{n % 7}" for n in range(40)}
    items = [(1, "a1 b1 c1"), (1, "a2"), (2, "b2 c3"), (3, "c5 and a long text of many words"), (None, "a0")]
    assert found(spark, docs(spark, texts), items, 5) == brute(list(texts.items()), items, 5)


def test_best_positions_read_less_than_all():
    """A document that tops one list and lies deep in the other is looked up at once; the lists' tails stay unread."""
    r, n = np.random.default_rng(1), 20_000
    impact = np.sort(r.integers(1, 1_000_000, (n, 2)), axis=0)[::-1].copy()
    impact[:, 1] = np.roll(impact[:, 1], 7)
    shard = L.Shard(np.arange(0, 2 * n + 1, 2), np.tile(np.array([0, 1], np.int32), n), impact.ravel(), 2)
    docs_, scores = shard.search(np.array([0, 1]), 50, 0)
    first = np.lexsort((docs_, -scores))[:50]
    want = np.lexsort((np.arange(n), -impact.sum(axis=1)))[:50]
    assert docs_[first].tolist() == want.tolist()
    assert (shard.met == shard.search_no).sum() < n // 10


@pytest.mark.parametrize("seed", range(30))
def test_a_shard_finds_the_best_and_all_ties(seed):
    r = np.random.default_rng(seed)
    n, terms = int(r.integers(1, 200)), int(r.integers(1, 9))
    rows = [np.flatnonzero(r.random(terms) < 0.5) for _ in range(n)]
    ends = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    term = np.concatenate(rows).astype(np.int32)
    impact = r.integers(1, 6, len(term))
    shard = L.Shard(ends, term, impact, terms)
    for asked in (np.arange(terms), np.arange(0, terms, 2)):
        scores = np.array([impact[a:b][np.isin(term[a:b], asked)].sum() for a, b in zip(ends[:-1], ends[1:])])
        for k, floor in ((1, 0), (5, 0), (5, 7), (1000, 0)):
            d, s = shard.search(asked, k, floor)
            assert (scores[d] == s).all() and len(set(d.tolist())) == len(d)
            top = sorted((-x, i) for i, x in enumerate(scores) if x > 0 and x >= floor)[:k]
            assert {i for _, i in top} <= set(d.tolist())


def test_lengths_beyond_64_bits():
    n = np.array([3, 4_000_000_000], np.int64)
    assert L._length_part(n, 10**11, 10**13).tolist() == [50 * int(x) * 10**11 // 10**13 for x in n]
