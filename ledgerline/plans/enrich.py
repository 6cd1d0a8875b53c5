"""The enrichment extract (fact joined to dimensions and a foreign-system view)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.exprs import live_or_null, not_blank
from ledgerline.functions.timefilters import date_lit
from ledgerline.operators.joins import attach_period


def enrich_extract(details: DataFrame, reports: DataFrame, projects: DataFrame, foreign: DataFrame,
                   periods: DataFrame, pricing: DataFrame, payment_types: DataFrame, start: dt.date, end: dt.date,
                   business_type: str = "Project", strict_compat: bool = True, limit: int | None = None) -> DataFrame:
    """Details of live-or-null reports dated in ``[start, end]`` with a project and a non-blank grade,
    enriched with report, project, payment-type and foreign-view columns.

    The report join is a left join turned inner by the WHERE on the report (J-19). Periods and the
    pricing set add no columns but multiply rows (J-20); ``strict_compat=False`` leaves them out.
    ``limit`` keeps the first rows by detail id, then by the other columns (the source's TOP without
    ORDER BY is undefined)."""
    d = details.filter(F.col("ProjectID").isNotNull() & not_blank("StrengthGrade"))
    r = reports.filter(live_or_null("isDeleted") & F.col("ReportDate").between(date_lit(start), date_lit(end))) \
        .select(F.col("ID").alias("__rid"), "StationID", "ReportDate")
    x = d.join(r, F.col("DailyReportID") == F.col("__rid"))
    pj = projects.select(F.col("ID").alias("__pj"), "AccountingPaymentType", "AgentID")
    x = x.join(pj, F.col("ProjectID") == F.col("__pj"), "left")
    fv = foreign.select(F.col("Id").alias("__fid"), "PlanId", "IsLubricatePumpMortar")
    x = x.join(fv, F.col("OriginalID") == F.col("__fid"), "left")
    if strict_compat:
        x = attach_period(x, "ReportDate", periods.filter(live_or_null("isDeleted")), how="left", out_col="__period")
        ps = pricing.filter(F.col("BusinessType") == F.lit(business_type)).select(F.col("BusinessRelationID").alias("__br"))
        x = x.join(ps, F.col("__br") == F.col("ProjectID"), "left")
    pt = F.broadcast(payment_types.select(F.col("PaymentType").alias("__pt"), F.col("Type").alias("ProjectType")))
    x = x.join(pt, F.col("AccountingPaymentType") == F.col("__pt"), "left")
    out = x.select("ID", "ProjectType",
                   F.coalesce(F.col("AccountingPaymentType"), F.lit("")).alias("AccountingPaymentType"),
                   "StationID", "ProjectID", "AgentID", "ReportDate", "PlanId", "IsLubricatePumpMortar")
    if limit is not None:
        out = out.orderBy("ID", *[c for c in out.columns if c != "ID"]).limit(limit)
    return out
