"""Driver queries of the jobs that write: each runs its sink in the shared checkpoint folder and reads back what it
wrote (S7, S8, S9, S10, P21, F2). Unlike the queries of ``driver_queries`` they start jobs while they are built."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.plans import driver_queries as dq
from ledgerline.session import checkpoint_dir
from ledgerline.sources import sinks
from ledgerline.sources.keyed_table import KeyedTable, by_hash, reset_links, sync
from ledgerline.sources.standins import StandIns


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


BOARD_KEYS = ["SalesDepartment", "UserName", "TypeName", "TimeType", "SalesmanID", "AccountingPaymentType"]
BOARD_AUDIT = ["FGC_CreateDate", "FGC_LastModifyDate"]


def _long(name: str, df: DataFrame) -> DataFrame:
    """A board's rows, a row per measure."""
    keys = [F.col(k).cast("string").alias(k) if k in df.columns else F.lit(None).cast("string").alias(k) for k in BOARD_KEYS]
    measures = [c for c in df.columns if c not in (*BOARD_KEYS, *BOARD_AUDIT, "RegionID")]
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).cast("double").alias("v")) for m in measures]))
    return df.select(F.lit(name).alias("output"), *keys, "FGC_CreateDate", pairs.alias("p")) \
        .select("output", *BOARD_KEYS, F.col("p.m").alias("measure"), F.col("p.v").alias("value"), "FGC_CreateDate")


def refresh_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole kanban job refreshes its four tables by one commit, over an earlier run's versions; all rows
    read back from that commit, a row per measure, with their creation time."""
    from ledgerline.plans.kanban import run_kanban
    root = _folder(spark, "kanban")
    outs = run_kanban(StandIns.of(spark, sf_dir), dq.kanban_config())
    sinks.refresh_all(spark, {n: d.limit(0) for n, d in outs.items()}, root, dq.AS_OF - dt.timedelta(days=1))
    sinks.refresh_all(spark, outs, root, dq.AS_OF, keep=1)
    back = [_long(n, d) for n, d in sorted(sinks.read_commit(spark, root).items())]
    out = back[0]
    for d in back[1:]:
        out = out.unionByName(d)
    return out


def load_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two report dates of the daily load written, one of them again; that day's rows read back, all 73 columns."""
    from ledgerline.plans.daily_load import daily_load
    target = f"{_folder(spark, 'details')}/t"
    src, cfg, day = StandIns.of(spark, sf_dir), dq.load_config(), dt.date(1995, 6, 17)
    for d in (day, dt.date(1995, 6, 18), day):
        sinks.load_partition(daily_load(src, cfg, d, dq.LOAD_RUN, date_col="ReportDate"), target)
    return spark.read.parquet(target).filter(F.col("report_date") == F.lit(day)).drop("report_date", "ReportDate")


def copy_by_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10, 2.9: the local copy by base and deltas: a first copy, four runs of the job 15 minutes apart (one of them
    repeated), a compaction between them; the merged table."""
    src = StandIns.of(spark, sf_dir).fact_source()
    table = KeyedTable(spark, _folder(spark, "copy"), src.schema, ["ProductionDetailId", "Material"], ["ModifyTime", "FactAmt"],
                       by_hash(16))
    for k, minutes in enumerate((-15, 0, 15, 15, 30, 45)):
        sync(table, src, "ModifyTime", dq.COPY_T0 + dt.timedelta(minutes=minutes), dt.timedelta(minutes=5))
        if k == 3:
            table.compact(most_deltas=1)
    return table.read().withColumn("FactAmt", F.col("FactAmt").cast("double"))


def reset_by_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weighing table (its distinct rows) with the stale links reset by a delta of the rows that change."""
    from ledgerline.functions.exprs import live_strict
    from ledgerline.functions.timefilters import since_months
    src = StandIns.of(spark, sf_dir)
    ins = src.wb_ins()
    table = KeyedTable(spark, _folder(spark, "wb-ins"), ins.schema, ["Id", "SiteDate", "TenantId"], bucket=by_hash(16))
    table.append(ins)
    reports = src.receiving_reports().filter(live_strict("isDeleted")).select(F.col("ID").alias("__r"))
    keep = src.receiving_details().join(reports, F.col("DailyReportID") == F.col("__r")).select("OriginalID")
    scope = (F.col("TenantId") == F.lit(1)) & since_months("SiteDate", dt.date(2000, 6, 15), 2)
    reset_links(table, keep, "Id", "OriginalID", "ReceivingDailyReportID", scope)
    return table.read()


QUERIES = {"refresh_outputs": refresh_outputs, "load_partitions": load_partitions, "copy_by_deltas": copy_by_deltas,
           "reset_by_delta": reset_by_delta}
