"""Hand-made rows for the semantic traps of the source jobs (FIXTURES.md part C)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerline.config import KanbanConfig
from ledgerline.functions.exprs import blank_to_null, live_or_null, live_strict, text_plus, unit_qty
from ledgerline.functions.timefilters import financial_day, since_months
from ledgerline.operators.joins import latest_effective, left_on_true, not_in_list, prev_period, sum_by_either
from ledgerline.operators.params import split_param
from ledgerline.operators.sets import union_distinct
from ledgerline.plans.daily_load import load_measures
from ledgerline.streaming.incremental import latest_per_key, sync_increment

T = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


def test_or_key_lookup(spark):
    rows = spark.createDataFrame([(1, 1, 2), (2, 1, 1), (3, 9, 9), (4, None, 3)], "rid int, a int, b int")
    fact = spark.createDataFrame([(1, 10), (1, 5), (2, 7), (3, 1)], "k int, m int")
    out = sum_by_either(rows, "a", "b", fact, "k", F.col("m"), "s")
    got = {r.rid: r.s for r in out.collect()}
    assert got == {1: 22, 2: 15, 3: None, 4: 1}


def test_latest_effective_basic_and_null_value(spark):
    maps = spark.createDataFrame([(1, "x", T(1), 10), (2, "x", T(9), 20)], "id int, k string, eff timestamp_ntz, v int")
    probes = spark.createDataFrame([(1, "x", T(5)), (2, "x", T(10)), (3, "x", T(0)), (4, None, T(10))],
                                   "pid int, k string, ts timestamp_ntz")
    out = latest_effective(probes, maps, [F.col("k")], [F.col("k")], "ts", "eff", "id", "v", "v")
    assert {r.pid: r.v for r in out.collect()} == {1: 10, 2: 20, 3: None, 4: None}
    maps2 = spark.createDataFrame([(1, "x", T(1), 10), (2, "x", T(9), None)], "id int, k string, eff timestamp_ntz, v int")
    out2 = latest_effective(probes.filter("pid = 2"), maps2, [F.col("k")], [F.col("k")], "ts", "eff", "id", "v", "v")
    assert [r.v for r in out2.collect()] == [None]


def test_latest_effective_greatest_id_not_latest_time(spark):
    maps = spark.createDataFrame([(5, "x", T(1), 50), (4, "x", T(3), 40)], "id int, k string, eff timestamp_ntz, v int")
    probes = spark.createDataFrame([(1, "x", T(4)), (2, "x", T(2))], "pid int, k string, ts timestamp_ntz")
    out = latest_effective(probes, maps, [F.col("k")], [F.col("k")], "ts", "eff", "id", "v", "v")
    assert {r.pid: r.v for r in out.collect()} == {1: 50, 2: 50}


def test_latest_effective_hot_key_against_brute_force(spark):
    rnd = random.Random(7)
    maps = [(i, rnd.choice(["a", "a", "a", "b", None]), T(rnd.randint(0, 24 * 10)), rnd.randint(0, 99))
            for i in range(400)]
    probes = [(j, rnd.choice(["a", "a", "b", "c", None]), T(rnd.randint(0, 24 * 10))) for j in range(400)]
    mdf = spark.createDataFrame(maps, "id int, k string, eff timestamp_ntz, v int")
    pdf = spark.createDataFrame(probes, "pid int, k string, ts timestamp_ntz")
    out = latest_effective(pdf, mdf, [F.coalesce(F.col("k"), F.lit(""))], [F.coalesce(F.col("k"), F.lit(""))],
                           "ts", "eff", "id", "v", "v", bucket="day")
    got = {r.pid: r.v for r in out.collect()}
    want = {}
    for pid, k, ts in probes:
        cand = [(i, v) for i, mk, eff, v in maps if (mk or "") == (k or "") and eff <= ts]
        want[pid] = max(cand)[1] if cand else None
    assert got == want


def test_left_on_true_keeps_rows_when_right_empty(spark):
    left = spark.createDataFrame([(1,), (2,)], "a int")
    empty = spark.createDataFrame([], "t string")
    out = left_on_true(left, empty).collect()
    assert sorted((r.a, r.t) for r in out) == [(1, None), (2, None)]
    dup = spark.createDataFrame([("x",), ("x",)], "t string")
    assert left_on_true(left, dup).count() == 4
    many = spark.range(10_001).withColumnRenamed("id", dup.columns[0])
    assert left_on_true(left, many).count() == left.count() * 10_001


def test_not_in_with_null_in_list(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    with_null = spark.createDataFrame([(1,), (None,)], "col int")
    assert not_in_list(df, F.col("v"), with_null).count() == 0
    plain = spark.createDataFrame([(1,)], "col int")
    assert sorted(r.v for r in not_in_list(df, F.col("v"), plain).collect()) == [2]
    empty = spark.createDataFrame([], "col int")
    assert not_in_list(df, F.col("v"), empty).count() == 3


def test_split_param_keeps_empty_parts_untrimmed(spark):
    params = spark.createDataFrame([("P", "a, b,,c")], "ParaName string, ParaValue string")
    assert [r.col for r in split_param(params, "P").collect()] == ["a", " b", "", "c"]
    assert split_param(params, "missing").count() == 0


def test_prev_period_gap_gives_no_match(spark):
    sales = spark.createDataFrame([("d", 1, 0), ("d", 2, 5), ("d", 4, 3)], "k string, PeriodID int, q int")
    last = sales.select("k", "PeriodID", F.col("q").alias("last_q"))
    out = prev_period(sales, last, ["k"])
    assert {r.PeriodID: r.last_q for r in out.collect()} == {1: None, 2: 0, 4: None}


def test_liveness_tests_differ_on_null(spark):
    df = spark.createDataFrame([(0,), (1,), (None,)], "d int")
    assert df.filter(live_strict("d")).count() == 1
    assert df.filter(live_or_null("d")).count() == 2


def test_load_measures_units_and_signed(spark):
    rows = [("T", 5, 5, 0, 1, 1, 2), ("other", 5, 5, None, 1, 1, 3), ("M3", 5, 5, None, None, 1, 1),
            ("T", 6, 5, 4, 1, 1, 2)]
    df = spark.createDataFrame(rows, "u string, act int, face int, signed int, tin int, tout int, reason int")
    df = df.select("u", *[F.col(c).cast("decimal(18,2)").alias(c) for c in ["act", "face", "signed", "tin", "tout"]],
                   "reason")
    m = load_measures(F.col("u"), 2.4, "T", "M3", F.col("act"), F.col("face"), F.col("signed"), F.col("tin"),
                      F.col("tout"), F.col("reason"))
    out = df.select(*[c.alias(n) for n, c in m.items()]).collect()
    r0, r1, r2, r3 = out
    assert r0.SignedQty_T is None and r0.FinalQty_T is None          # signed 0 -> NULL
    assert r1.FinalQty_M3 is None and r1.FinalQty_T is None          # unit neither tonnes nor m3
    assert float(r1.SignedQty_M3) == 5.0                             # signed NULL -> face
    assert r2.ActualSupplyQty_M3 is None                             # NULL transfer -> NULL supply
    assert float(r3.ProductionQty_M3) == 6 / 2.4 and float(r3.ScaleDiff) == 1.0
    assert float(r1.LossQty) == 0.0


def test_grade_fallback_and_blank(spark):
    df = spark.createDataFrame([(None, None, "S"), (None, "I", "S"), ("", "I", "S")], "g string, i string, s string")
    out = df.select(F.coalesce(F.col("g"), text_plus(F.col("i"), "-", F.col("s"))).alias("x"),
                    blank_to_null("g").alias("b")).collect()
    assert [r.x for r in out] == [None, "I-S", ""]
    assert [r.b for r in out] == [None, None, None]


def test_financial_day_edges(spark):
    d = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5, 59, 59),), (dt.datetime(2024, 1, 1, 6),),
                                (dt.datetime(2024, 1, 2, 6),)], "t timestamp_ntz")
    assert [r.t.hour for r in df.filter(financial_day("t", d, 6)).collect()] == [6]
    assert df.filter(financial_day("t", d, 6)).count() == 1


def test_since_months_clamps_month_end(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 28),), (dt.datetime(2024, 2, 29),), (dt.datetime(2024, 2, 27),)],
                               "t timestamp_ntz")
    # Apr 30 - 2 months = Feb 29 in a leap year
    assert df.filter(since_months("t", dt.date(2024, 4, 30), 2)).count() == 1


def test_union_distinct_drops_exact_duplicates(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "a int, b string")
    b = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    assert union_distinct(a, b).count() == 2


def test_overlapping_copy_windows_keep_one_row(spark):
    src = spark.createDataFrame([(1, "m", 5, dt.datetime(2024, 1, 1, 0, 14))],
                                "ProductionDetailId int, Material string, FactAmt int, ModifyTime timestamp_ntz")
    keys = ["ProductionDetailId", "Material"]
    c1 = sync_increment(src, None, keys, "ModifyTime", dt.datetime(2024, 1, 1, 0, 15), dt.timedelta(minutes=20))
    c2 = sync_increment(src, c1, keys, "ModifyTime", dt.datetime(2024, 1, 1, 0, 30), dt.timedelta(minutes=20))
    assert c2.count() == 1


def test_latest_per_key_hot_key(spark):
    rows = [(1, i % 7, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i)) for i in range(3000)] + [(2, 0, T(0))]
    df = spark.createDataFrame(rows, "k int, v int, ts timestamp_ntz")
    out = {r.k: r.v for r in latest_per_key(df, ["k"], ["ts"]).collect()}
    assert out == {1: 2999 % 7, 2: 0}


def test_unit_qty_null_to_zero(spark):
    df = spark.createDataFrame([("T", None, 3), ("M3", 2, None), (None, 1, 4)], "u string, t int, m int")
    out = [r.q for r in df.select(unit_qty("u", "t", "m", "T").alias("q")).collect()]
    assert [float(x) for x in out] == [0.0, 0.0, 4.0]


def test_clock_split_on_first_of_month_and_year():
    cfg = KanbanConfig(as_of=dt.datetime(2001, 1, 1, 8))
    assert cfg.yday == dt.date(2000, 12, 31)      # boards and periods use last year
    assert cfg.as_of.month == 1                   # opportunities use the new month


def test_name_key_follows_source_collation(spark):
    from ledgerline.functions.exprs import name_key
    a = spark.createDataFrame([("Alice ",), ("BOB",), ("carol",)], "n string")
    b = spark.createDataFrame([("alice",), ("Bob",), ("Carol  x",)], "m string")
    got = a.join(b, name_key("n") == name_key("m")).count()
    assert got == 2
    assert a.join(b, name_key("n", ci=False) == name_key("m", ci=False)).count() == 0


def test_distinct_keys_groups_null_keys(spark):
    from ledgerline.operators.sets import distinct_keys
    a = spark.createDataFrame([(None, "u", 1), ("d", "u", 2)], "d string, u string, q int")
    b = spark.createDataFrame([(None, "u", 5), ("d", "v", 1)], "d string, u string, q int")
    assert distinct_keys(a, b, keys=["d", "u"]).count() == 3


def test_keyed_measures_null_key_keeps_null_measures(spark):
    from ledgerline.operators.sets import keyed_measures
    a = spark.createDataFrame([(None, "u", 3), ("x", "u", 4)], "d string, u string, qa bigint")
    b = spark.createDataFrame([("x", "u", 7), ("y", None, 1)], "d string, u string, qb bigint")
    rows = {(r.d, r.u): (r.qa, r.qb) for r in keyed_measures([(a, ["qa"]), (b, ["qb"])], ["d", "u"]).collect()}
    assert rows == {(None, "u"): (None, None), ("x", "u"): (4, 7), ("y", None): (None, None)}


def test_latest_effective_bulk_instants_and_buckets_against_brute_force(spark):
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    instants = [base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 3)) for _ in range(40)]
    maps = [(i, "hot" if rnd.random() < 0.6 else "cold", rnd.choice(instants), rnd.randint(0, 9)) for i in range(500)]
    probes = [(j, "hot" if rnd.random() < 0.6 else "cold", rnd.choice(instants)) for j in range(300)]
    mdf = spark.createDataFrame(maps, "id int, k string, eff timestamp_ntz, v int")
    pdf = spark.createDataFrame(probes, "pid int, k string, ts timestamp_ntz")
    for bucket in ("hour", "day", "minute"):
        out = latest_effective(pdf, mdf, [F.col("k")], [F.col("k")], "ts", "eff", "id", "v", "v", bucket=bucket)
        got = {r.pid: r.v for r in out.collect()}
        want = {}
        for pid, k, ts in probes:
            cand = [(i, v) for i, mk, eff, v in maps if mk == k and eff <= ts]
            want[pid] = max(cand)[1] if cand else None
        assert got == want, bucket


def test_latest_effective_burst_within_an_hour(spark):
    """A third of all probes in one hour, many of them at one instant; mappings at the same instants; microseconds count."""
    rnd = random.Random(11)
    at = lambda: T(5) + dt.timedelta(microseconds=rnd.choice([0, 1, 999_999, 1_000_000, rnd.randint(0, 5_000_000)]))
    maps = [(i, "a", at(), rnd.choice([None, i])) for i in range(60)] + [(100 + i, "b", T(i), i) for i in range(20)]
    probes = [(j, "a", at()) for j in range(300)] + [(300 + j, rnd.choice(["a", "b", "c"]), T(rnd.randint(0, 30))) for j in range(300)]
    probes += [(600, "a", None), (601, None, T(5)), (602, "a", T(5)), (602, "a", T(5))]
    mdf = spark.createDataFrame(maps + [(900, None, T(0), 1), (None, "a", T(0), 2), (901, "a", None, 3)],
                                "id int, k string, eff timestamp_ntz, v int")
    pdf = spark.createDataFrame(probes, "pid int, k string, ts timestamp_ntz")
    for bucket in ("hour", "day", "second"):
        out = latest_effective(pdf, mdf, [F.col("k")], [F.col("k")], "ts", "eff", "id", "v", "found", bucket=bucket)
        assert out.columns == ["pid", "k", "ts", "found"]
        want = []
        for pid, k, ts in probes:
            cand = [(i, v) for i, mk, eff, v in maps if mk == k and ts is not None and eff <= ts]
            want.append((pid, k, ts, max(cand, key=lambda c: c[0])[1] if cand else None))
        assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
