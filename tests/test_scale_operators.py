"""Operators for unbounded inputs against plain brute force: intervals, unbounded NOT IN, global ranks, names, fingerprints."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.analytics import IDENTIFIER, names_census, rename_names
from ledgerline.operators.intervals import broadcast_if_small, estimated_bytes, interval_bins, interval_join
from ledgerline.operators.joins import not_in_rows
from ledgerline.operators.ranks import global_rank
from ledgerline.operators.recon import differing_rows, reconcile

DAY = lambda n: dt.date(2000, 1, 1) + dt.timedelta(days=n)
AT = lambda us: dt.datetime(2000, 1, 1) + dt.timedelta(microseconds=us)
NEVER = dt.date(9999, 12, 31)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("days", [True, False])
def test_bins_cover_an_interval_exactly_and_few(spark, days):
    r = random.Random(2)
    low, high = (-719162, 2932896) if days else (-62135596800 * 10**6, 253402300800 * 10**6 - 1)
    data = [(low, high), (0, 0), (5, 4), (-1, 1), (-8, 7), (7, 8), (low, low), (high, high), (None, 3), (3, None)]
    data += [tuple(sorted(r.choice([r.randint(low, high), r.randint(-700, 700)]) for _ in range(2))) for _ in range(300)]
    df = spark.createDataFrame([(k, *x) for k, x in enumerate(data)], "i int, s bigint, e bigint")
    for row in df.select("i", interval_bins(F.col("s"), F.col("e"), days).alias("b")).collect():
        s, e = data[row.i]
        if s is None or e is None:
            assert row.b is None
            continue
        spans = sorted((b.bin << 3 * b.level, (b.bin + 1) << 3 * b.level) for b in row.b)
        if s > e:
            assert not spans
            continue
        assert spans[0][0] == s and spans[-1][1] == e + 1 and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
        assert len(spans) <= 14 * (9 if days else 21)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_intervals_of_days(spark, how):
    r = random.Random(5)
    iv = [(k, r.choice(["x", "y", None]), DAY(r.randint(0, 900)), None) for k in range(60)]
    iv = [(k, g, s, r.choice([s, s + dt.timedelta(days=r.randint(-3, 400)), NEVER, None])) for k, g, s, _ in iv] * 2 + [(99, "x", None, DAY(3))]
    pts = [(k, r.choice(["x", "y", "z", None]), r.choice([None, DAY(r.randint(-5, 1500)), DAY(400)])) for k in range(200)]
    left = spark.createDataFrame(pts, "p int, g string, d date")
    right = spark.createDataFrame(iv, "i int, g string, s date, e date")
    for on in ([], ["g"]):
        for open_end in (False, True):
            want = []
            for p, g, d in pts:
                hit = [i for i, h, s, e in iv if d and s and s <= d and (e or (NEVER if open_end else dt.date(1, 1, 1))) >= d
                       and (e or open_end) and (not on or (g and g == h))]
                want += [(p, g, d, i) for i in hit] or ([(p, g, d, None)] if how == "left" else [])
            got = interval_join(left, right, "d", "s", "e", on, how, keep=["i"], open_end=open_end)
            assert got.columns == ["p", "g", "d", "i"] and rows(got) == sorted(want, key=str)


def test_intervals_of_time_stamps_and_mixed_kinds(spark):
    edge = [(1, AT(0), AT(0)), (2, AT(0), AT(1)), (3, AT(-1), AT(10**12)), (4, AT(999_999), AT(1_000_000))]
    pts = [(k, AT(x)) for k, x in enumerate([-2, -1, 0, 1, 2, 999_998, 999_999, 1_000_000, 1_000_001, 10**12, 10**12 + 1, 86_400_000_000])]
    left = spark.createDataFrame(pts, "p int, t timestamp_ntz")
    right = spark.createDataFrame(edge, "i int, s timestamp_ntz, e timestamp_ntz")
    want = [(p, i) for p, t in pts for i, s, e in edge if s <= t <= e]
    assert rows(interval_join(left, right, "t", "s", "e", keep=["i"]).select("p", "i")) == sorted(want, key=str)
    days = spark.createDataFrame([(1, DAY(0), DAY(1)), (2, DAY(-1), DAY(0))], "i int, s date, e date")  # a date is its midnight
    want = [(p, i) for p, t in pts for i, s, e in ((1, AT(0), AT(86_400_000_000)), (2, AT(-86_400_000_000), AT(0))) if s <= t <= e]
    assert rows(interval_join(left, days, "t", "s", "e", keep=["i"]).select("p", "i")) == sorted(want, key=str)


def test_only_what_is_estimated_small_is_broadcast(spark):
    small, large = spark.range(10), spark.range(10**9)
    plan = lambda df: spark.range(10).join(df, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(broadcast_if_small(small)) and "broadcast" not in plan(broadcast_if_small(large))
    assert "broadcast" not in plan(broadcast_if_small(small, 10**9))


@pytest.mark.parametrize("values", [[1, 2, 2], [1, None], [None], [], [5]])
def test_not_in_follows_nulls_on_both_sides(spark, values):
    left = spark.createDataFrame([(k, v) for k, v in enumerate([1, 2, 3, None, 3, None])], "k int, v int")
    right = spark.createDataFrame([(v,) for v in values], "col int")
    left.createOrReplaceTempView("nin_left")
    right.createOrReplaceTempView("nin_right")
    want = rows(spark.sql("SELECT * FROM nin_left WHERE v NOT IN (SELECT col FROM nin_right)"))
    out = not_in_rows(left, F.col("v"), right)
    assert rows(out) == want
    assert "BroadcastNestedLoop" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed, ranges", [(0, 512), (1, 4), (2, 2)])
def test_global_rank_is_rank(spark, seed, ranges):
    r = random.Random(seed)
    data = [(k, r.choice([None, float(r.randint(0, 40)), 7.0, r.random()])) for k in range(300)]
    df = spark.createDataFrame(data, "k int, v double").repartition(5)
    got = {x.k: x["rank"] for x in global_rank(df, "v", ranges=ranges).collect()}
    known = [v for _, v in data if v is not None]
    assert got == {k: 1 + (len(known) if v is None else sum(x > v for x in known)) for k, v in data}
    assert global_rank(df.limit(0), "v").count() == 0
    assert [x["rank"] for x in global_rank(df.limit(3).withColumn("v", F.lit(None).cast("double")), "v").collect()] == [1, 1, 1]


TEXTS = [(1, "a b_1 A a.b, x9"), (2, None), (3, ""), (4, "über a1 a"), (5, "..."), (6, "a"), (7, "select [a].[b_1]\n a\x00a"), (None, "a a")]


def test_names_are_counted_in_one_pass(spark):
    texts = spark.createDataFrame(TEXTS, "id int, t string")
    names = spark.createDataFrame([("a",), ("b_1",), ("nowhere",), (None,), ("a",), ("ber",), ("x",)], "n string")
    found = {k: re.findall(IDENTIFIER, t or "") for k, (_, t) in enumerate(TEXTS)}
    want = [(n, sum(n in f for f in found.values()), sum(f.count(n) for f in found.values()),
             sum(n in f for f in found.values()) / len(TEXTS)) for n in ("a", "b_1", "nowhere", "ber", "x")]
    assert rows(names_census(texts, "t", names, "n")) == sorted(want, key=str)
    assert names_census(texts, "t", names.limit(0), "n").count() == 0
    assert [tuple(r)[1:] for r in names_census(texts.limit(0), "t", names.limit(1), "n").collect()] == [(0, 0, None)]


def test_names_are_replaced_once_each(spark):
    texts = spark.createDataFrame(TEXTS, "id int, t string")
    book = {"a": "b_1", "b_1": "[srv].[x]", "ber": "$1\\", **{f"n{k}": "z" for k in range(3000)}}
    names = spark.createDataFrame([*book.items(), ("a", "B"), (None, "q"), ("x9", None)], "o string, n string")
    want = []
    for i, t in TEXTS:
        n = sum(w in book for w in re.findall(IDENTIFIER, t or ""))
        want.append((i, n, None if t is None else re.sub(IDENTIFIER, lambda m: book.get(m.group(), m.group()), t)))
    assert rows(rename_names(texts, "id", "t", names, "o", "n")) == sorted(want, key=str)


def test_only_buckets_that_differ_are_compared(spark):
    r = random.Random(9)
    base = [(r.choice([None, k % 50]), r.choice(["x", None]), float(k % 7)) for k in range(400)]
    a = spark.createDataFrame(base, "k int, s string, v double")
    assert differing_rows(a, a.repartition(3)).count() == 0
    assert tuple(reconcile(a, a).first()) == (400, 400, 0, 0, True)
    for change in (base[1:], base + base[:1], base[:-1] + [(77, "new", 0.0)], [(s and 1, "x" if k is None else None, v) for k, s, v in base], []):
        b = spark.createDataFrame(change, "k int, s string, v double")
        more, less = list(change), []
        for x in base:
            more.remove(x) if x in more else less.append(x)
        assert tuple(reconcile(a, b).first()) == (400, len(change), len(less), len(more), len(change) == 400)
        assert tuple(reconcile(a, b, buckets=1).first()) == (400, len(change), len(less), len(more), len(change) == 400)
    one = spark.createDataFrame(base[:-1] + [(77, "new", 0.0)], "k int, s string, v double")
    assert differing_rows(a, one).count() < 40
    # NULLs in other columns make other rows
    x, y = (spark.createDataFrame([v], "k string, s string") for v in ((None, "q"), ("q", None)))
    assert tuple(reconcile(x, y).first()) == (1, 1, 1, 1, True)


def _interval_plan(spark, tmp_path, n, kind):
    """The first plan of an interval join over files whose estimate is under the broadcast threshold, their bins over it."""
    at = F.timestamp_seconds(F.lit(10**9) + F.col("id") * 977 % 10**7).cast(kind)
    spark.range(n).select(at.alias("s"), (at + F.expr("INTERVAL 40 DAYS")).cast(kind).alias("e"), at.alias("t"), (F.col("id") % 7).alias("g")) \
        .coalesce(1).write.parquet(f"{tmp_path}/x")
    x = spark.read.parquet(f"{tmp_path}/x")
    key, old = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, str(2 * estimated_bytes(x)))
    try:
        out = interval_join(x.select("t", "g"), x.select("s", "e", "g"), "t", "s", "e", on=["g"], keep=["s"])
        return out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, old)


def test_the_bins_of_small_files_of_days_are_not_broadcast(spark, tmp_path):
    plan = _interval_plan(spark, tmp_path, 3000, "date")
    assert not re.search(r"BroadcastHashJoin \[[^]]*level", plan) and re.search(r"SortMergeJoin \[[^]]*level", plan)


def test_the_bins_of_small_files_of_time_stamps_are_not_broadcast(spark, tmp_path):
    plan = _interval_plan(spark, tmp_path, 3000, "timestamp_ntz")
    assert not re.search(r"BroadcastHashJoin \[[^]]*level", plan) and re.search(r"SortMergeJoin \[[^]]*level", plan)
