import random
from collections import Counter

import numpy as np
import pytest

from cases import no_docs, odd_docs, odd_rows, table
from ledgerline.llm import pfair_mix as M
from ledgerline.llm import queries as Q


@pytest.mark.parametrize("seed", range(20))
def test_every_source_stays_within_a_block_of_its_share(seed):
    r = random.Random(seed)
    w = [r.randint(1, 40) for _ in range(r.randint(1, 9))]
    order, total = M.period(w), sum(w)
    ran = np.stack([np.cumsum(order == s) for s in range(len(w))])
    assert (np.abs(ran * total - np.outer(w, np.arange(1, total + 1))) < total).all()


@pytest.mark.parametrize("seed", range(20))
def test_phases_use_each_slot_once_and_keep_the_bound(seed):
    r = random.Random(seed)
    w = [r.randint(1, 12) for _ in range(r.randint(1, 6))]
    blocks = [r.randint(0, 60) for _ in w]
    slots = {}
    for p in M.phases(blocks, w):
        for b in range(p.first_block, p.end_block):
            i = b - p.first_block
            slot = p.first_slot + i // p.weight * p.period + p.slots[i % p.weight]
            assert slot not in slots
            slots[slot] = (p.source, b)
    assert sorted(slots) == list(range(sum(blocks)))
    assert Counter(s for s, _ in slots.values()) == {s: n for s, n in enumerate(blocks) if n}
    done = [0] * len(w)
    for slot in sorted(slots):
        s, b = slots[slot]
        assert b == done[s]
        done[s] += 1


def simulate(rows, weights, block_rows):
    """The schedule slot by slot: of the released blocks the one with the earliest deadline."""
    left = {s: sorted((h, i) for src, h, i in rows if src == s) for s in {r[0] for r in rows}}
    names = sorted(left, key=lambda s: "" if s is None else "=" + s)
    done, out = dict.fromkeys(names, 0), []
    while any(done[s] * block_rows < len(left[s]) for s in names):
        live = [s for s in names if done[s] * block_rows < len(left[s])]
        total, ran, slot = sum(weights.get(s, 1) for s in live), dict.fromkeys(live, 0), 0
        while True:
            ready = [(-(-(ran[s] + 1) * total // weights.get(s, 1)), k, s) for k, s in enumerate(live)
                     if ran[s] * total // weights.get(s, 1) <= slot]
            _, _, s = min(ready)
            if done[s] * block_rows >= len(left[s]):
                break
            out += [i for _, i in left[s][done[s] * block_rows:(done[s] + 1) * block_rows]]
            done[s] += 1
            ran[s] += 1
            slot += 1
    return out


def test_table_against_a_simulation(spark):
    d = table(spark, "documents")
    weights = {"src0": 5, "src3": 2}
    rows = [tuple(r) for r in d.selectExpr("source", "xxhash64(doc_id) h", "doc_id").collect()]
    # unsigned order of hashes
    want = simulate([(s, h % 2**64, i) for s, h, i in rows], weights, 4)
    got = sorted((r["position"], r["doc_id"]) for r in M.mix(d, weights, block_rows=4).collect())
    assert [p for p, _ in got] == list(range(len(rows))) and [i for _, i in got] == want


def test_odd_cases(spark):
    d = odd_docs(spark)
    got = M.mix(d, {"s0": 3}, block_rows=2).collect()
    assert sorted(r["position"] for r in got) == list(range(len(odd_rows())))
    assert sorted((str(r["doc_id"]), str(r["source"])) for r in got) == sorted((str(r[0]), str(r[3])) for r in odd_rows())
    out = M.mixed(d, block_rows=2)
    assert out.columns == d.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, d.collect()))
    assert M.mix(no_docs(spark)).collect() == [] and M.mixed(no_docs(spark)).collect() == []


def test_a_hot_source_and_one_source(spark):
    d = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, concat('s', id % 7), 'hot') AS source")
    got = sorted((r["position"], r["source"]) for r in M.mix(d, block_rows=16).collect())
    assert [p for p, _ in got] == list(range(3000))
    # while all have blocks, eight sources share alike
    first = Counter(s for _, s in got[:8 * 16 * 5])
    assert set(first.values()) == {16 * 5}
    assert [s for _, s in got[-100:]] == ["hot"] * 100
    assert M.mix(d.where("source = 'hot'")).count() == 2000


def test_weights_are_checked():
    for w in ([], [0, 1], [M.MOST_SLOTS, 1]):
        with pytest.raises(ValueError):
            M.period(w)


def test_registered_weights_follow_the_sources_texts(spark):
    rows = [tuple(r) for r in table(spark, "documents").selectExpr("source", "xxhash64(doc_id) h", "doc_id", "text").collect()]
    chars = Counter()
    for s, _, _, text in rows:
        chars[s] += len(text or "")
    weights = {s: max(1, round(100 * (n / max(chars.values())) ** 0.5)) for s, n in chars.items()}
    assert len(set(weights.values())) > 1
    want = simulate([(s, h % 2**64, i) for s, h, i, _ in rows], weights, 64)
    got = sorted((r["position"], r["doc_id"]) for r in Q.op4_pfair_mix(spark, "/root/testdata/sf0.001").collect())
    assert [i for _, i in got] == want


def test_target_weights(spark):
    d = spark.createDataFrame([("a", "x" * 400), ("a", None), ("b", "x" * 60), ("b", "x" * 40), ("c", None), (None, "x" * 36)],
                              "source string, text string")
    assert M.target_weights(d, 20) == {"a": 20, "b": 10, "c": 1, None: 6}
    assert M.target_weights(d.where("text IS NULL")) == {"a": 1, "c": 1}
    assert M.target_weights(no_docs(spark)) == {}


def test_the_plan_of_slots_needs_no_python_workers(spark):
    plan = M.placed(table(spark, "documents"))[0]._jdf.queryExecution().analyzed().toString()
    assert "LocalRelation" in plan and "LogicalRDD" not in plan  # an RDD of Python rows is turned by workers of its own kind
