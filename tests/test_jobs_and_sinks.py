"""Whole jobs, sinks, the registry and the streaming copy, on the smallest driver tables."""

import datetime as dt
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.analytics import pattern_census
from ledgerline.operators.params import split_param
from ledgerline.plans import driver_queries as dq
from ledgerline.plans import kanban
from ledgerline.plans.enrich import enrich_extract
from ledgerline.sources import sinks
from ledgerline.sources.registry import SourceRegistry
from ledgerline.sources.schemas import DRIVER
from ledgerline.sources.standins import StandIns
from ledgerline.streaming.incremental import batch_merger, latest_per_key

SF = "/root/testdata/sf0.001"


def scratch():
    return tempfile.mkdtemp(prefix="ledgerline-test-", dir="/tmp")


def test_run_kanban_refresh_and_read_back(spark):
    src, cfg = StandIns.of(spark, SF), dq.kanban_config()
    outs = kanban.run_kanban(src, cfg, persist=True)
    root = scratch()
    run_ts = dt.datetime(2000, 6, 15, 9, 30)
    sinks.refresh_all(spark, outs, root, run_ts)
    for name, df in outs.items():
        back = sinks.read_current(spark, root, name)
        assert back.count() == df.count()
        assert back.columns[:2] == ["FGC_CreateDate", "FGC_LastModifyDate"]
    # a second run writes a new version and switches the pointer; the old version stays readable
    sinks.refresh_all(spark, outs, root, run_ts + dt.timedelta(days=1))
    assert len([d for d in os.listdir(os.path.join(root, "WorkbenchKanbanSales")) if d.startswith("v")]) == 2


def test_load_partition_rerun_replaces_the_day(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "v int, ReportDate date")
    target = os.path.join(scratch(), "details")
    sinks.load_partition(df, target)
    sinks.load_partition(df.filter("v = 1"), target)
    assert spark.read.parquet(target).count() == 2


def test_csv_export_round_trip_through_registry(spark):
    docs = StandIns.of(spark, SF).raw("documents").select("doc_id", "text")
    path = os.path.join(scratch(), "log")
    sinks.export_csv(docs, path)
    reg = SourceRegistry(spark).csv("log", path, docs.schema)
    back = reg("log")
    assert back.count() == docs.count()
    a = {r.pattern: r.n_docs for r in pattern_census(docs, "text").collect()}
    b = {r.pattern: r.n_docs for r in pattern_census(back, "text").collect()}
    assert a == b


def test_registry_parquet_with_schema(spark):
    reg = SourceRegistry(spark).parquet("orders", f"{SF}/orders.parquet", DRIVER["orders"])
    assert "orders" in reg and reg("orders").count() > 0


def test_split_param_more_than_one_row_fails(spark):
    params = spark.createDataFrame([("P", "a"), ("P", "b")], "ParaName string, ParaValue string")
    with pytest.raises(Exception):
        split_param(params, "P").collect()


def test_enrich_limit_is_ordered(spark):
    src = StandIns.of(spark, SF)
    args = (src.details(), src.reports(), src.projects(), src.foreign_view(), src.periods(), src.pricing_sets(),
            src.payment_types(), dt.date(1995, 1, 1), dt.date(2001, 12, 31))
    full = enrich_extract(*args)
    top = enrich_extract(*args, limit=10).collect()
    assert len(top) == 10
    assert [r.ID for r in top] == sorted(r.ID for r in full.collect())[:10]


def test_streaming_copy_with_foreach_batch(spark):
    src = StandIns.of(spark, SF).fact_source()
    inbox, target, ckpt = scratch(), scratch(), scratch()
    keys = ["ProductionDetailId", "Material"]
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    src.filter(F.col("ModifyTime") < cut).write.mode("append").parquet(os.path.join(inbox, "b1"))
    stream = spark.readStream.schema(src.schema).option("recursiveFileLookup", "true").parquet(inbox)
    q = stream.writeStream.foreachBatch(batch_merger(target, keys, "ModifyTime")) \
        .option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination(120)
    src.filter(F.col("ModifyTime") >= cut).write.mode("append").parquet(os.path.join(inbox, "b2"))
    q = stream.writeStream.foreachBatch(batch_merger(target, keys, "ModifyTime")) \
        .option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination(120)
    last = max(int(d.split("=")[1]) for d in os.listdir(target) if d.startswith("v="))
    got = spark.read.parquet(os.path.join(target, f"v={last}"))
    want = latest_per_key(src, keys, ["ModifyTime"])
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_no_period_holds_yesterday_gives_no_time_type_1(spark):
    # stand-in periods end in August 2001: yesterday in September has no period, this year has
    src = StandIns.of(spark, SF)
    cfg = dq.kanban_config(dt.datetime(2001, 9, 15, 8))
    sales = kanban.board_sales(src, cfg)
    returns = kanban.board_returns(src, cfg)
    assert sales.count() > 0 and returns.count() > 0
    assert sales.filter("TimeType = 1").count() == 0 and returns.filter("TimeType = 1").count() == 0


def test_daily_load_backfill_equals_single_days(spark):
    from ledgerline.plans.daily_load import daily_load
    src = StandIns.of(spark, SF)
    cfg = dq.load_config()
    run_ts = dt.datetime(2000, 6, 15, 1)
    full = daily_load(src, cfg, None, run_ts, date_col="ReportDate").persist()
    days = [r.ReportDate for r in full.select("ReportDate").distinct().orderBy("ReportDate").limit(3).collect()]
    days.append(dt.date(1995, 1, 1))
    for d in days:
        one = daily_load(src, cfg, d, run_ts, date_col="ReportDate")
        part = full.filter(F.col("ReportDate") == F.lit(d))
        assert one.exceptAll(part).count() == 0 and part.exceptAll(one).count() == 0, d
    full.unpersist()


class Replaced:
    """A source with some frames of its own."""

    def __init__(self, src, **frames):
        self.src, self.frames = src, frames

    def __call__(self, name):
        return self.frames[name] if name in self.frames else self.src(name)


def test_daily_load_keeps_one_of_equal_rows_whose_report_id_repeats(spark):
    from ledgerline.plans.daily_load import daily_load
    src, cfg, run_ts = StandIns.of(spark, SF), dq.load_config(), dt.datetime(2000, 6, 15, 1)
    records, reports = src("production_records"), src("station_reports")
    # each record twice, on two days; the days' reports have one id, so both make the same row
    twice = records.unionByName(records.withColumn("SiteDate", F.col("SiteDate") + F.expr("INTERVAL 1 DAY")))
    days = reports.select("StationID", "isDeleted", F.explode(F.array("ReportDate", F.date_add("ReportDate", 1))).alias("ReportDate"))
    for number in (F.lit(7).cast("bigint"), F.lit(None).cast("bigint")):
        one = days.withColumn("ID", number)
        got = daily_load(Replaced(src, production_records=twice, station_reports=one), cfg, None, run_ts).persist()
        known = daily_load(src, cfg, None, run_ts).withColumn("DailyReportID", number).distinct()
        assert got.count() == got.distinct().count() and known.count() > 0
        assert known.exceptAll(got).count() == 0
        got.unpersist()


def test_daily_load_is_made_distinct_where_the_reports_join_left_its_rows(spark, capsys):
    from ledgerline.plans.daily_load import daily_load
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10k")  # the categories only
    try:
        df = daily_load(StandIns.of(spark, SF), dq.load_config(), None, dt.datetime(2000, 6, 15, 1))
        assert df.collect()
        df.explain()  # as it ran
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    above = capsys.readouterr().out.split("SortMergeJoin")[0]
    assert "HashAggregate" in above or "SortAggregate" in above
    assert "Exchange" not in above


def test_daily_load_carries_rows_narrow_and_shuffles_the_reports_once(spark, capsys):
    from ledgerline.plans.daily_load import daily_load
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10k")
    try:
        daily_load(StandIns.of(spark, SF), dq.load_config(), None, dt.datetime(2000, 6, 15, 1)).explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    plan = capsys.readouterr().out
    widths = [int(n) for n in re.findall(r"^\(\d+\) Exchange\nInput \[(\d+)\]", plan, re.M)]
    # only the two DISTINCTs, of rows not alone with their ticket and of rows whose report id comes again, hold the target's columns
    assert sum(n > 40 for n in widths) <= 2 and len(widths) > 10
    # no sort holds the target's columns
    assert max(int(n) for n in re.findall(r"^\(\d+\) Sort\nInput \[(\d+)\]", plan, re.M)) <= 40


def test_daily_load_of_plain_sources_equals_that_of_late_ones(spark):
    from ledgerline.plans.daily_load import daily_load
    src, cfg, run_ts = StandIns.of(spark, SF), dq.load_config(), dt.datetime(2000, 6, 15, 1)
    late = sorted(map(str, daily_load(src, cfg, None, run_ts).collect()))
    assert late and sorted(map(str, daily_load(Replaced(src), cfg, None, run_ts).collect())) == late


def test_weighings_of_unknown_user_plans_have_no_columns_of_plans(spark):
    from ledgerline.plans.daily_load import daily_load
    src, cfg, run_ts = StandIns.of(spark, SF), dq.load_config(), dt.datetime(2000, 6, 15, 1)
    few = Replaced(src, user_plans=src("user_plans").filter("id % 3 > 0"))
    rows = [r for r in daily_load(few, cfg, None, run_ts).collect() if r.ShipmentCount is None]
    unknown = [r for r in rows if r.PlanType is None]
    assert len(rows) > len(unknown) > 0
    assert {(r.Distance, r.ProductionPlanNumber, r.PlatformCustomerPhone, r.ProductCategory) for r in unknown} == {
        (None, None, None, cfg.default_weighbridge_category)}


def test_daily_load_is_distinct_among_rows_of_one_ticket(spark):
    from ledgerline.plans.daily_load import daily_load
    src, cfg, run_ts = StandIns.of(spark, SF), dq.load_config(), dt.datetime(2000, 6, 15, 1)
    records = src("production_records").filter("SiteId < 7").withColumn("Id", F.when(F.col("TerminalNo").isNotNull(), F.col("Id")))
    other = records.withColumn("Remark", F.lit("other"))
    plans = src("user_plans").unionByName(src("user_plans").withColumn("Creator", F.lit("other")))
    once = daily_load(Replaced(src, production_records=records.unionByName(other), user_plans=plans), cfg, None, run_ts)
    want = once.distinct().persist()
    twice = Replaced(src, production_records=records.unionByName(other).unionByName(records), user_plans=plans.unionByName(plans),
                     shipping=src("shipping").unionByName(src("shipping")))
    got = daily_load(twice, cfg, None, run_ts).persist()
    assert want.count() == got.count() == once.count() > 0
    assert got.exceptAll(want).count() == 0 and got.filter("OriginalID IS NULL").count() > 0
    want.unpersist()
    got.unpersist()


def test_reports_whose_id_comes_again_are_apart(spark):
    from ledgerline.plans.daily_load import _by_place
    rows = [(i, i, dt.date(2020, 1, 1)) for i in range(400)] + [(5, 7, dt.date(2020, 1, 2)), (None, 1, dt.date(2020, 1, 3)), (None, 2, None)]
    reports = spark.createDataFrame(rows, "__rid bigint, __rstation bigint, __rdate date")
    once, more = _by_place(reports)
    again = {r["__rid"] for r in more.collect()}
    assert {5, None} <= again and len(again) < 20
    assert not again & {r["__rid"] for r in once.collect()}
    assert sorted(map(str, once.collect() + more.collect())) == sorted(str(r) for r in reports.collect())
    one, none = _by_place(reports.filter("__rid > 5"))
    assert one.count() == 394 and none.count() == 0
    assert all(x.count() == 0 for x in _by_place(reports.filter("__rid > 500")))


def test_late_columns_are_null_where_an_outer_join_found_no_row(spark):
    from ledgerline.sources.late import Late
    source = Late(spark.createDataFrame([(1, "a"), (1, None)], "k int, v string"),
                  {"id": F.col("k"), "kind": F.lit("x"), "v": F.coalesce("v", F.lit("none"))})
    x = spark.createDataFrame([(1,), (2,)], "id int").join(source.carried("__l_", __id=source.columns["id"]), F.col("id") == F.col("__id"), "left")
    got = source.worked_out(x, "__l_", "l_", "__id").select("id", "l_id", "l_kind", "l_v").collect()
    assert sorted(map(tuple, got), key=str) == [(1, 1, "x", "a"), (1, 1, "x", "none"), (2, None, None, None)]
    assert [tuple(r) for r in source.frame().collect()] == [(1, "x", "a"), (1, "x", "none")]


def test_writes_use_runtime_filters_and_put_the_settings_back(spark):
    from ledgerline.session import RUNTIME_FILTERS, runtime_filters
    was = {k: spark.conf.get(k, None) for k in RUNTIME_FILTERS}
    with pytest.raises(ZeroDivisionError), runtime_filters(spark):
        assert {k: spark.conf.get(k) for k in RUNTIME_FILTERS} == RUNTIME_FILTERS
        raise ZeroDivisionError
    assert {k: spark.conf.get(k, None) for k in RUNTIME_FILTERS} == was


def test_a_day_of_the_load_filters_the_shipments_before_they_are_shuffled(spark, monkeypatch, capsys):
    from ledgerline import session
    from ledgerline.plans.daily_load import daily_load
    monkeypatch.setitem(session.RUNTIME_FILTERS, "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
    monkeypatch.setitem(session.RUNTIME_FILTERS, "spark.sql.autoBroadcastJoinThreshold", "-1")
    with session.runtime_filters(spark):
        daily_load(StandIns.of(spark, SF), dq.load_config(), dt.date(1995, 6, 17), dt.datetime(2000, 6, 15, 1)).explain()
    assert "might_contain" in capsys.readouterr().out


def test_facts_of_other_years_are_dropped_below_their_joins(spark, capsys):
    src, cfg = StandIns.of(spark, SF), dq.kanban_config()
    periods = kanban.query_periods(src, cfg)
    kept = kanban._in_periods(src("payments"), "PeriodID", periods)
    kept.explain()
    below = capsys.readouterr().out.split("Join", 1)[1].split("Subquery", 1)
    assert "array_contains" in below[0] + below[1].split("Exchange", 1)[0]
    ids = {r.ID for r in periods.collect()}
    want = [r for r in src("payments").collect() if r.PeriodID in ids]
    assert want and sorted(map(str, kept.collect())) == sorted(map(str, want))
    none = spark.createDataFrame([(1, None), (2, 5), (3, 6)], "k int, PeriodID bigint")
    some = spark.createDataFrame([(5,), (5,), (None,)], "ID bigint")
    assert [r.k for r in kanban._in_periods(none, "PeriodID", some).collect()] == [2]
    assert kanban._in_periods(none, "PeriodID", some.filter("ID > 9")).count() == 0


def test_run_kanban_with_checkpointed_stages_matches_cached(spark):
    src, cfg = StandIns.of(spark, SF), dq.kanban_config()
    cached = kanban.run_kanban(src, cfg, persist="persist")
    ckpt = kanban.run_kanban(src, cfg, persist="checkpoint")
    for name in cached:
        a = cached[name].drop("FGC_CreateDate", "FGC_LastModifyDate")
        b = ckpt[name].drop("FGC_CreateDate", "FGC_LastModifyDate")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


KEYS = ["k"]


def _at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def test_a_late_run_loses_no_rows(spark):
    from ledgerline.streaming.incremental import sync_increment
    rows = [(1, _at(10)), (2, _at(25)), (3, _at(50)), (1, _at(55))]
    src = spark.createDataFrame(rows, "k int, ts timestamp_ntz")
    copy = sync_increment(src, None, KEYS, "ts", _at(15), dt.timedelta(minutes=5))
    assert [r.k for r in copy.collect()] == [1]
    late = sync_increment(src, copy, KEYS, "ts", _at(60), dt.timedelta(minutes=5))
    assert sorted((r.k, r.ts) for r in late.collect()) == [(1, _at(55)), (2, _at(25)), (3, _at(50))]
    empty = sync_increment(src, copy.limit(0), KEYS, "ts", _at(60), dt.timedelta(minutes=5))
    assert empty.count() == 3


def test_a_missing_version_fails_and_old_ones_go(spark):
    target = scratch()
    merge = batch_merger(target, KEYS, "ts")
    batches = [spark.createDataFrame([(k, _at(k))], "k int, ts timestamp_ntz") for k in range(4)]
    for epoch, b in enumerate(batches[:3]):
        merge(b, epoch)
    merge(batches[2], 2)  # a replayed epoch
    assert spark.read.parquet(f"{target}/v=2").count() == 3
    assert sorted(d for d in os.listdir(target) if d.startswith("v=")) == ["v=1", "v=2"]
    with pytest.raises(Exception):
        merge(batches[3], 5)
    assert not os.path.exists(f"{target}/v=5")


def test_a_failed_repeated_run_leaves_the_current_version(spark):
    root, ts = scratch(), dt.datetime(2024, 1, 1)
    good = spark.range(3).withColumnRenamed("id", "v")
    bad = good.select(F.when(F.col("v") > 1, F.raise_error(F.lit("no")).cast("long")).otherwise(F.col("v")).alias("v"))
    sinks.refresh_all(spark, {"t": good}, root, ts)
    with pytest.raises(Exception):
        sinks.refresh_all(spark, {"t": bad}, root, ts)
    assert sinks.read_current(spark, root, "t").count() == 3
    sinks.refresh_all(spark, {"t": good.limit(2)}, root, ts, keep=1)
    assert sinks.read_current(spark, root, "t").count() == 2
    assert len(sinks.versions(spark, os.path.join(root, "t"))) == 1


def test_a_lost_pointer_is_no_first_run(spark):
    root = scratch()
    sinks.refresh(spark, spark.range(3), os.path.join(root, "t"), dt.datetime(2024, 1, 1))
    assert sinks.read_current(spark, root, "t").count() == 3
    os.remove(os.path.join(root, "t", sinks.POINTER))
    assert sinks.versions(spark, os.path.join(root, "t"))
    with pytest.raises(FileNotFoundError):
        sinks.read_current(spark, root, "t")


def test_a_cluster_must_name_its_checkpoint_folder():
    from types import SimpleNamespace

    from ledgerline.session import checkpoint_dir
    sc = SimpleNamespace(master="local-cluster[2,1,1024]", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError):
        checkpoint_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None), sparkContext=sc))


def test_reconcile_counts_multisets(spark):
    from ledgerline.operators.recon import reconcile
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "z"), (3, "y"), (3, "y")], "k int, v string")
    assert tuple(reconcile(a, b).first()) == (4, 4, 2, 2, True)
    assert tuple(reconcile(a.limit(0), b.limit(0)).first()) == (0, 0, 0, 0, True)


def test_without_the_corpus_operators_everything_else_imports():
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    to = scratch()
    for name in ("__spark_entry__.py", "ledgerline"):
        src = os.path.join(root, name)
        if os.path.isdir(src):
            shutil.copytree(src, os.path.join(to, name), ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(src, to)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) >= 36 and not any(n.startswith('op') and n[2].isdigit() for n in q); assert set(e.oracle_sql()) <= set(q)"
    assert subprocess.run([sys.executable, "-c", code], cwd=to, env={**os.environ, "PYTHONPATH": to}).returncode == 0
