"""Stale-link reset. Parquet tables take no UPDATE, so the job writes a new version of the
table in which the link column is NULL where no live detail refers to the row any more."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.exprs import live_strict
from ledgerline.functions.timefilters import since_months


def reset_unmatched(df: DataFrame, keep_keys: DataFrame, key_col: str, keep_col: str, column: str,
                    scope: Column) -> DataFrame:
    """``UPDATE df SET column = NULL WHERE scope AND NOT EXISTS (keep_keys.keep_col = df.key_col)``.

    Rows outside ``scope`` (NULL scope included) pass through unchanged without touching the
    shuffle; in-scope rows are matched against the de-duplicated keys (a left join on distinct keys,
    pre-aggregated map-side, so a repeated key does not multiply rows)."""
    scoped = F.coalesce(scope, F.lit(False))
    keys = keep_keys.select(F.col(keep_col).alias("__keep")).distinct()
    inside = df.filter(scoped).join(keys, F.col(key_col) == F.col("__keep"), "left")
    ctype = df.schema[column].dataType
    inside = inside.select(*[F.when(F.col("__keep").isNull(), F.lit(None).cast(ctype)).otherwise(F.col(c)).alias(c)
                             if c == column else F.col(c) for c in df.columns])
    return inside.unionByName(df.filter(~scoped))


def stale_reset(ins: DataFrame, reports: DataFrame, details: DataFrame, tenant_id: int, report_date: dt.date,
                months: int = 2) -> DataFrame:
    """Tenant rows of the last ``months`` months lose their receiving-report link when no detail of
    a strict-live receiving report has their id (the inner LEFT JOIN acts as inner)."""
    r = reports.filter(live_strict("isDeleted")).select(F.col("ID").alias("__r"))
    keep = details.join(r, F.col("DailyReportID") == F.col("__r")).select("OriginalID")
    scope = (F.col("TenantId") == F.lit(tenant_id)) & since_months("SiteDate", report_date, months)
    return reset_unmatched(ins, keep, "Id", "OriginalID", "ReceivingDailyReportID", scope)
