import math

import numpy as np
import pytest

from cases import smallest_reachable, table
from ledgerline.llm import vector_links as V
from ledgerline.llm.common import prepare

SCHEMA = "vec_id long, embedding array<float>, label int, extra string, id long, n long, x string"


def brute(rows, threshold=0.93):
    """vec_id to (n_links, component_id), over distinct rows."""
    good = []
    for i, v, lab in rows:
        if i is None or lab is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        a = np.array(v, np.float32).astype(np.float64)
        if (i, lab, tuple(a)) not in {g[:3] for g in good}:
            good.append((i, lab, tuple(a), a / np.linalg.norm(a)))
    n, links = {i: 0 for i, *_ in rows}, []
    for k, (i, lab, raw, a) in enumerate(good):
        for j, lab2, raw2, b in good[:k]:
            if lab == lab2 and len(a) == len(b) and i != j and a @ b >= threshold:
                n[i] += 1
                n[j] += 1
                links.append((i, j))
    return n, smallest_reachable({i for i, *_ in rows if i is not None}, links)


def check(df, rows):
    n, of = brute(rows)
    want = sorted(((i, n[i] if i is not None else 0, of.get(i), i is not None and of[i] == i) for i, *_ in rows), key=str)
    got = sorted((tuple(r) for r in V.vector_links(df).select("vec_id", "n_links", "component_id", "kept").collect()), key=str)
    assert got == want


def near(r, v, cos):
    u = r.normal(size=len(v))
    v = v / np.linalg.norm(v)
    u -= (u @ v) * v
    return cos * v + math.sqrt(1 - cos * cos) * u / np.linalg.norm(u)


def make(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(i, v, lab, "e", 1, 2, "y") for i, v, lab in rows], SCHEMA)


def test_whole_table(spark):
    d = table(spark, "embeddings")
    check(d, [(r["vec_id"], r["embedding"], r["label"]) for r in d.collect()])


@pytest.mark.parametrize("block", [1024, 7])
def test_planted_groups_hot_bucket_and_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(V, "BLOCK", block)
    r = np.random.default_rng(8)
    rows = [(k, r.normal(size=64).tolist(), k % 3) for k in range(100)]
    hot = r.normal(size=64)
    rows += [(200 + k, near(r, hot, 0.985).tolist(), 1) for k in range(60)]
    rows += [(300 + k, near(r, hot, 0.985).tolist(), 2) for k in range(5)]
    same = r.normal(size=64).tolist()
    rows += [(400 + k, same, 0) for k in range(20)] + [(430, [2 * x for x in same], 0), (431, same, None)]
    v = r.normal(size=64)
    for k in range(12):  # a chain, at both sides of the threshold
        rows.append((500 + k, v.tolist(), 5))
        v = near(r, v, 0.94 if k % 2 else 0.92)
    rows += [(600, None, 0), (601, [], 0), (602, [0.0] * 64, 0), (603, [1.0, None], 0), (604, [math.nan, 1.0], 0),
             (605, [math.inf, 1.0], 0), (606, [1.0, 2.0, 3.0], 0), (607, [1.0, 2.0, 3.01], 0), (608, [1.0], 0),
             (609, [5.0], 0), (610, [1e-30, 2e-30, 3e-30], 0), (611, [1e30, 2e30, 3e30], 0), (400, same, 0)]
    rows = [(i, None if x is None else [None if y is None else float(np.float32(y)) for y in x], lab) for i, x, lab in rows]
    check(make(spark, [*rows, (None, same, 0)]).repartition(4), [*rows, (None, same, 0)])


def test_empty_table(spark):
    assert V.vector_links(make(spark, [])).collect() == []


def test_hadamard_keeps_lengths_and_angles():
    x = np.random.default_rng(0).normal(size=(9, 32))
    assert np.allclose(V.hadamard(x) @ V.hadamard(x).T, x @ x.T)


def test_recall_at_the_threshold():
    r = np.random.default_rng(1)
    a = r.normal(size=(3000, 64))
    b = np.array([near(r, x, 0.93) for x in a])
    ca, cb = V.bucket_codes(V._units(a), V.Hashing()), V.bucket_codes(V._units(b), V.Hashing())
    met = (ca[:, :, :, None] == cb[:, :, None, :]).any(axis=(1, 2, 3))
    assert met.mean() > 0.999
