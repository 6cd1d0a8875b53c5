"""Driver queries: each source operator exercised on the driver tables through the stand-ins.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame whose column names match the
DuckDB oracle in ``ledgerline.plans.oracle_sql``. Money columns are exact decimals inside the job
and cast to DOUBLE only at the end.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.config import KanbanConfig
from ledgerline.plans import kanban
from ledgerline.sources import standins as si
from ledgerline.sources.standins import StandIns

AS_OF = dt.datetime(2000, 6, 15, 9, 30, 0)


def kanban_config(as_of: dt.datetime = AS_OF) -> KanbanConfig:
    return KanbanConfig(
        as_of=as_of, target_type_group="MonthlyTargetCategory", target_type_exclude="NEWMAT",
        refund_service_type="EXPENSE", prospect_source="PROSPECT",
        category_groups=si.CATEGORY_GROUPS, six_categories=tuple(si.SIX_CATEGORIES),
        payment_keep=tuple(si.PAYMENT_KEEP), payment_else=si.PAYMENT_ELSE, unit_tonne=si.UNIT_TONNE, name_collation=None)


def _d(c: str) -> "F.Column":
    return F.col(c).cast("double").alias(c)


def period_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales by department, user, period, category group and payment type (P3, J-01, J-02, J-10,
    J-13, A4): the production stage of the kanban."""
    src, cfg = StandIns.of(spark, sf_dir), kanban_config()
    periods = kanban.query_periods(src, cfg)
    proj = kanban.base_projects(src, cfg)
    out = kanban.stage_production(src, cfg, periods, proj)
    return out.select("SalesDepartment", "UserName", "PeriodID", "ProductCategory", "AccountingPaymentType",
                      _d("FinalQty"), _d("SalesAmt"))


QUERIES = {
    "period_sales": period_sales,
}


def _kanban(spark: SparkSession, sf_dir: str):
    return StandIns.of(spark, sf_dir), kanban_config()


def wait_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prospects without assignment (J-14 anti join, J-02, A1)."""
    return kanban.leads_wait_assign(*_kanban(spark, sf_dir))


def wait_follow_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prospect x assignment follow-up count (J-06, J-03, J-20, A2, P18)."""
    return kanban.leads_wait_follow_up(*_kanban(spark, sf_dir))


def clue_wait_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kanban.clues_wait_assign(*_kanban(spark, sf_dir))


def clue_wait_follow_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kanban.clues_wait_follow_up(*_kanban(spark, sf_dir))


def key_union_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Board 1: UNION of four key sets, org lookups, counts joined back with 0 default (U1, J-04,
    J-03, P6; a NULL user keeps zeros)."""
    return kanban.board_leads(*_kanban(spark, sf_dir))


def category_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opportunities reported this month by category group."""
    out = kanban.oppo_reported(*_kanban(spark, sf_dir))
    return out.select("Username", "DeptName", "ProductCategory", "OppoReportedQty", _d("OppoEstimatedSupplyQty"))


def or_key_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Won opportunities with the year's production of either approved project (J-16, J-20)."""
    out = kanban.oppo_won(*_kanban(spark, sf_dir))
    return out.select("Username", "DeptName", "ProductCategory", "MonthWinOppoQty", _d("MonthWinOppoSupplyQty"))


def board_oppo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Board 2: opportunities (U1 over three key sets, A11, three left joins)."""
    out = kanban.board_oppo(*_kanban(spark, sf_dir))
    return out.select("RegionID", "SalesDepartment", "UserName", "TypeName", "OppoReportedQty",
                      _d("OppoEstimatedSupplyQty"), "MonthWinOppoQty", _d("MonthWinOppoSupplyQty"), "SalesmanID",
                      "OppoEffectiveQty")


def param_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail types kept by the split parameter list (X13, F1, A12, J-13): no trimming, so ' R'
    does not match 'R'; the empty part matches nothing."""
    from ledgerline.operators.params import in_param_list
    src = StandIns.of(spark, sf_dir)
    d = in_param_list(src.details(), "Type", src.parameters(), "ProjectSalesTypeFilter")
    return d.groupBy("Type").agg(F.count(F.lit(1)).alias("n"), F.sum("SalesTotalAmt1").cast("double").alias("amt"))


def param_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projects whose contract company is not in the excluded list (J-15, NULL-aware NOT IN)."""
    from ledgerline.operators.joins import not_in_list
    from ledgerline.operators.params import split_param
    src = StandIns.of(spark, sf_dir)
    p = src.projects().join(src.companies().withColumnRenamed("ID", "__co"),
                            F.col("SignCompanyID_PartyA") == F.col("__co"), "left")
    p = not_in_list(p, F.coalesce(F.col("CompanyName"), F.lit("")),
                    split_param(src.parameters(), "NotCalcReturnCompanies"))
    return p.groupBy("SalesDepartment").agg(F.count(F.lit(1)).alias("n"))


def prev_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each production group with the previous period's quantity among this year's production
    (J-11: equi join on id - 1; the first period and gaps get 0)."""
    from ledgerline.operators.joins import prev_period as prev
    src, cfg = _kanban(spark, sf_dir)
    prod = kanban.build_stages(src, cfg)["prod"]  # persisted: read twice by the self join
    keys = ["SalesDepartment", "UserName", "ProductCategory", "AccountingPaymentType"]
    last = prod.select(*keys, "PeriodID", F.col("FinalQty").alias("LastFinalQty"))
    out = prev(prod, last, keys)
    return out.select(*keys, "PeriodID", F.col("FinalQty").cast("double").alias("FinalQty"),
                      F.coalesce(F.col("LastFinalQty"), F.lit(0)).cast("double").alias("LastFinalQty"))


def board_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Board 3 (1e): J-03, J-08, J-11, A9, A10, P12, P25, U3."""
    out = kanban.board_sales(*_kanban(spark, sf_dir))
    money = ["TargetFinalQty", "FinalQty", "TargetSalesAmt", "SalesAmt", "ProfitTargetAmt", "ProfitAmt", "LastFinalQty"]
    return out.select(*[_d(c) if c in money else F.col(c) for c in out.columns])


def board_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Board 4 (1f): A5, A6, A7, A8, J-09, J-12, J-19."""
    out = kanban.board_returns(*_kanban(spark, sf_dir))
    money = ["TargetReturnAmt", "PlanReturnAmt", "ReturnAmt"]
    return out.select(*[_d(c) if c in money else F.col(c) for c in out.columns])


QUERIES.update({
    "wait_assign": wait_assign,
    "wait_follow_up": wait_follow_up,
    "clue_wait_assign": clue_wait_assign,
    "clue_wait_follow_up": clue_wait_follow_up,
    "key_union_backfill": key_union_backfill,
    "category_rollup": category_rollup,
    "or_key_supply": or_key_supply,
    "board_oppo": board_oppo,
    "param_in": param_in,
    "param_not_in": param_not_in,
    "prev_period": prev_period,
    "board_sales": board_sales,
    "board_returns": board_returns,
})


def load_config():
    from ledgerline.config import LoadConfig
    return LoadConfig(creator="loader", tenant_id=1, default_department="UNASSIGNED", default_payment_type="ADVANCE",
                      default_category="STANDARD", default_unit="M3", default_weighbridge_unit="T",
                      default_weighbridge_category="DRY_MORTAR", pro_coeff=2.4, financial_hours=6,
                      unfilled_salesman="UNFILLED", default_type="OWN", unit_tonne="T", unit_m3="M3",
                      remark_labels=("log:", ";remark:", ";ticket:"), name_collation=None)


LOAD_RUN = dt.datetime(2000, 6, 15, 1, 0, 0)


def daily_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 over every business day at once, all 73 columns."""
    from ledgerline.plans import daily_load as dl
    return dl.daily_load(StandIns.of(spark, sf_dir), load_config(), None, LOAD_RUN)


def daily_load_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 for one report date, 1995-06-17, as the source runs it (P13, P14): all 73 columns."""
    from ledgerline.plans import daily_load as dl
    return dl.daily_load(StandIns.of(spark, sf_dir), load_config(), dt.date(1995, 6, 17), LOAD_RUN)


def financial_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighbridge tonnage per station and financial day (P14, X7, A4): the day starts 6 hours
    after midnight, so a weighing at 05:59 belongs to the previous day."""
    src = StandIns.of(spark, sf_dir)
    d = src.delivering().filter(F.col("isDeleted") == 0)
    s = src.shipping().filter(F.col("isDeleted") == 0).select("DeliveringID", "StationID")
    j = s.join(d, F.col("DeliveringID") == F.col("ID"))
    day = F.to_date(F.col("GrossTime") - F.make_interval(hours=F.lit(6)))
    return j.groupBy("StationID", day.alias("FinancialDay")).agg(
        F.count(F.lit(1)).alias("n"), (F.sum("Net").cast("double") / 1000.0).alias("tonnes"))


QUERIES.update({"daily_load": daily_load, "daily_load_day": daily_load_day, "financial_day": financial_day})


def asof_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest-effective mapping per production amount row (J-17, T2): greatest mapping id among
    live mappings of the same material (NULL-safe) and station effective at or before the row."""
    from ledgerline.operators.joins import latest_effective
    src = StandIns.of(spark, sf_dir)
    probes = src.fact_amounts().select("ProductionDetailId", "Material", "StationID", "SiteProdTime")
    maps = src.mappings().filter(F.col("isDeleted") == 0)
    return latest_effective(probes, maps,
                            [F.coalesce(F.col("Material"), F.lit("")), F.col("StationID")],
                            [F.coalesce(F.col("RecipeMtrName"), F.lit("")), F.col("StationID")],
                            "SiteProdTime", "EffectiveTime", "ID", "CSEMtrID", "CSEMtrID")


def enrich_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 over June 2000 without row cap (J-02, J-10 left, J-19, J-20, P19)."""
    from ledgerline.plans.enrich import enrich_extract as run
    src = StandIns.of(spark, sf_dir)
    return run(src.details(), src.reports(), src.projects(), src.foreign_view(), src.periods(), src.pricing_sets(),
               src.payment_types(), dt.date(2000, 6, 1), dt.date(2000, 6, 30))


def enrich_top1000(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 over June 2000, the first 1,000 rows by detail id."""
    from ledgerline.plans.enrich import enrich_extract as run
    src = StandIns.of(spark, sf_dir)
    return run(src.details(), src.reports(), src.projects(), src.foreign_view(), src.periods(), src.pricing_sets(),
               src.payment_types(), dt.date(2000, 6, 1), dt.date(2000, 6, 30), limit=1000)


def stale_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New version of the whole weighing table (S9, J-14, P15)."""
    from ledgerline.plans.reset import stale_reset as run
    src = StandIns.of(spark, sf_dir)
    return run(src.wb_ins(), src.receiving_reports(), src.receiving_details(), 1, dt.date(2000, 6, 15), 2)


COPY_T0 = dt.datetime(2024, 1, 20, 0, 0, 0)


def incremental_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 + W1: the copy as of T0 (newest per key) merged with the next run 15 minutes later, which reads from the
    copy's newest row less 5 minutes; the overlap does not duplicate rows."""
    from ledgerline.functions.timefilters import ts_lit
    from ledgerline.streaming.incremental import latest_per_key, sync_increment
    src = StandIns.of(spark, sf_dir).fact_source()
    keys = ["ProductionDetailId", "Material"]
    copy0 = latest_per_key(src.filter(F.col("ModifyTime") < ts_lit(COPY_T0)), keys, ["ModifyTime"])
    out = sync_increment(src, copy0, keys, "ModifyTime", COPY_T0 + dt.timedelta(minutes=15), dt.timedelta(minutes=5))
    return out.select(*keys, F.col("FactAmt").cast("double").alias("FactAmt"), "ModifyTime")


def summary_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum and row count per (detail, material)."""
    from ledgerline.streaming.incremental import summary
    out = summary(StandIns.of(spark, sf_dir).fact_lines(), ["ProductionDetailId", "Material"], "FactAmt")
    return out.select("ProductionDetailId", "Material", F.col("TotalFactAmt").cast("double").alias("TotalFactAmt"),
                      "RowCount")


QUERIES.update({"asof_mapping": asof_mapping, "enrich_extract": enrich_extract, "enrich_top1000": enrich_top1000, "stale_reset": stale_reset,
                "incremental_copy": incremental_copy, "summary_table": summary_table})


def log_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 over the logged statements and whole document texts: matches per pattern and share of texts."""
    from ledgerline.operators.analytics import pattern_census
    return pattern_census(StandIns.of(spark, sf_dir).logged_statements(), "text")


RENAME_MAP = [(r"\[?\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(,\d+)?\]?", "LOCAL_COPY"), (r"\bthe\b", "THE_TABLE")]


def rename_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remote server references in whole texts rewritten to the local copy's name, and a common name."""
    from ledgerline.operators.analytics import rename_refs as run
    return run(StandIns.of(spark, sf_dir).raw("documents"), "doc_id", "text", RENAME_MAP)


def cost_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 20 statements by total CPU with per-call averages."""
    from ledgerline.operators.analytics import cost_topk as run
    return run(StandIns.of(spark, sf_dir).query_stats(), 20)


def wait_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wait shares without benign waits."""
    from ledgerline.operators.analytics import wait_share as run
    return run(StandIns.of(spark, sf_dir).wait_stats())


def candidate_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: index candidates over a three-table equi join, threshold 1000, generated text."""
    from ledgerline.operators.analytics import candidate_rank as run
    src = StandIns.of(spark, sf_dir)
    out = run(src.index_groups(), src.index_group_stats(), src.index_details())
    return out.withColumn("index_advantage", F.col("index_advantage").cast("double"))


def frag_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: fragmentation labels."""
    from ledgerline.operators.analytics import frag_class as run
    out = run(StandIns.of(spark, sf_dir).index_physical())
    return out.withColumn("avg_fragmentation_in_percent", F.col("avg_fragmentation_in_percent").cast("double"))


def block_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: blocked/blocking pairs with the wait."""
    from ledgerline.operators.analytics import block_pairs as run
    src = StandIns.of(spark, sf_dir)
    out = run(src.requests(), src.waiting_tasks())
    return out.withColumn("wait_duration_ms", F.col("wait_duration_ms").cast("double"))


def size_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Database sizes, share, rank, bucket, top 5."""
    from ledgerline.operators.analytics import size_rollup as run
    out = run(StandIns.of(spark, sf_dir).db_files())
    return out.withColumn("size_mb", F.col("size_mb").cast("double"))


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs by status (threshold 100 s)."""
    from ledgerline.operators.analytics import run_summary as run
    return run(StandIns.of(spark, sf_dir).runs(), 100.0)


def compare_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First half of the month against the second half, per event type."""
    from ledgerline.functions.timefilters import ts_lit
    from ledgerline.operators.analytics import compare_runs as run
    r = StandIns.of(spark, sf_dir).runs()
    cut = ts_lit(dt.datetime(2024, 1, 16))
    return run(r.filter(F.col("ts") < cut), r.filter(F.col("ts") >= cut), "name")


def recon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: the incremental copy against a full recompute one hour later (two-way exceptAll)."""
    from ledgerline.functions.timefilters import ts_lit
    from ledgerline.operators.recon import reconcile
    from ledgerline.streaming.incremental import latest_per_key, sync_increment
    src = StandIns.of(spark, sf_dir).fact_source()
    keys = ["ProductionDetailId", "Material"]
    copy0 = latest_per_key(src.filter(F.col("ModifyTime") < ts_lit(COPY_T0)), keys, ["ModifyTime"])
    t1 = COPY_T0 + dt.timedelta(minutes=15)
    a = sync_increment(src, copy0, keys, "ModifyTime", t1, dt.timedelta(minutes=5))
    b = latest_per_key(src.filter(F.col("ModifyTime") <= ts_lit(t1 + dt.timedelta(hours=1))), keys, ["ModifyTime"])
    return reconcile(a, b)


def match_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: share of all detail rows with a foreign-view row."""
    from ledgerline.operators.recon import match_rate as run
    src = StandIns.of(spark, sf_dir)
    return run(src.details(), "OriginalID", src.foreign_view(), "Id")


QUERIES.update({"log_census": log_census, "rename_refs": rename_refs, "cost_topk": cost_topk,
                "wait_share": wait_share, "candidate_rank": candidate_rank, "frag_class": frag_class,
                "block_pairs": block_pairs, "size_rollup": size_rollup, "run_summary": run_summary,
                "compare_runs": compare_runs, "recon": recon, "match_rate": match_rate})


def label_match_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9 over the partial-match dimension: share of all documents that have a label row."""
    from ledgerline.operators.recon import match_rate as run
    src = StandIns.of(spark, sf_dir)
    return run(src.raw("documents").select("doc_id"), "doc_id", src.raw("labels"), "doc_id")


QUERIES["label_match_rate"] = label_match_rate


def inventory_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: sizes and database counts by group and by recovery mode, with shares."""
    from ledgerline.operators.analytics import inventory_rollup as run
    from ledgerline.operators.analytics import size_rollup
    return run(size_rollup(StandIns.of(spark, sf_dir).db_files()))


QUERIES["inventory_rollup"] = inventory_rollup


def names_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 over every identifier of the benchmark texts as a name: occurrences in whole document texts."""
    from ledgerline.operators.analytics import names_census as run
    src = StandIns.of(spark, sf_dir)
    return run(src.raw("documents"), "text", src.known_names(), "old_name")


def rename_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K10 by a dictionary of many names: whole document texts with every known name replaced."""
    from ledgerline.operators.analytics import rename_names as run
    src = StandIns.of(spark, sf_dir)
    return run(src.raw("documents"), "doc_id", "text", src.known_names(), "old_name", "new_name")


def not_in_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-15 with an unbounded list: customers by segment whose key isn't among the open orders' customers, with NULL keys
    on the left, against the list as it is, with a NULL in it, and empty."""
    from ledgerline.operators.joins import not_in_rows as run
    src = StandIns.of(spark, sf_dir)
    c = src.raw("customer").withColumn("k", F.when(F.col("c_custkey") % 50 != 0, F.col("c_custkey")))
    o = src.raw("orders").filter(F.col("o_orderstatus") == "O")
    lists = {"rows": o.select(F.col("o_custkey").alias("k")), "null": o.select(F.nullif("o_custkey", F.lit(7)).alias("k")).unionByName(
        o.limit(1).select(F.lit(None).cast("bigint").alias("k"))), "empty": o.filter("o_custkey < 0").select(F.col("o_custkey").alias("k"))}
    out = None
    for name, values in lists.items():
        part = run(c, F.col("k"), values, "k").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.count("k").alias("known")) \
            .withColumn("list", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def open_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-10 for intervals of any length: per order date and brand, that day's orders times the parts on offer; offers last some days, a
    tenth never end (9999-12-31), some have a NULL end (open) or end before they start, and they overlap."""
    from ledgerline.operators.intervals import interval_join
    src = StandIns.of(spark, sf_dir)
    start = F.date_add(F.lit("1992-01-01").cast("date"), (F.col("p_partkey") * 37 % 2400).cast("int"))
    days = (F.col("p_partkey") % 61 - 5).cast("int")
    offers = src.raw("part").select("p_brand", "p_size", start.alias("from_day"),
                                    F.when(F.col("p_partkey") % 10 == 0, F.lit("9999-12-31").cast("date"))
                                    .when(F.col("p_partkey") % 17 != 0, F.date_add(start, days)).alias("to_day"))
    orders = src.raw("orders").groupBy(F.col("o_orderdate").cast("date").alias("o_orderdate")).agg(F.count(F.lit(1)).alias("orders"))
    out = interval_join(orders, offers, "o_orderdate", "from_day", "to_day", keep=["p_brand", "p_size"], open_end=True)
    return out.groupBy("o_orderdate", "p_brand").agg(F.sum("orders").alias("n"), F.sum(F.col("orders") * F.col("p_size")).alias("size"))


def session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-10 with time stamps to the microsecond, by user: events and the error windows that they fall into (each error opens
    one of some minutes), events outside of all windows once."""
    from ledgerline.operators.intervals import interval_join
    e = StandIns.of(spark, sf_dir).raw("events")
    opened = e.filter(F.col("event_type") == "error").select(
        "user_id", F.col("event_id").alias("window_id"), F.col("ts").alias("opens"),
        (F.col("ts") + F.make_dt_interval(mins=(F.col("event_id") % 4000).cast("int"))).alias("closes"))
    events = e.select("event_id", "user_id", "ts")
    return interval_join(events, opened, "ts", "opens", "closes", on=["user_id"], how="left", keep=["window_id"]) \
        .select("event_id", "window_id")


QUERIES.update({"names_census": names_census, "rename_names": rename_names, "not_in_rows": not_in_rows,
                "open_periods": open_periods, "session_windows": session_windows})


DETAILS_OF_DAYS = """
SELECT r.ReportDate, d.Type, COUNT(*) AS n, CAST(SUM(d.SalesTotalAmt1) AS DOUBLE) AS amt
FROM {details} d JOIN {reports} r ON d.DailyReportID = r.ID
WHERE r.isDeleted = 0 AND r.ReportDate BETWEEN :first AND :last AND d.Type <> :without
GROUP BY r.ReportDate, d.Type"""


def details_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P24 as SQL text with named parameters: values are bound as typed literals, never pasted into the text."""
    src = StandIns.of(spark, sf_dir)
    return spark.sql(DETAILS_OF_DAYS, {"first": dt.date(2000, 6, 1), "last": dt.date(2000, 6, 30), "without": "A' OR '1' = '1"},
                     details=src.details(), reports=src.reports())


QUERIES["details_of_days"] = details_of_days
