"""Time predicates. Every one takes the job's ``as_of``; none reads the clock.

They are written as half-open ranges on the raw column so parquet row-group statistics and
partition pruning apply (``YEAR(ts) = y`` would not be pushed down).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.exprs import col_of

__all__ = ["month_bounds", "in_month", "in_year", "holds_date", "business_day", "financial_day",
           "since_months", "ts_lit", "date_lit"]


def ts_lit(t: dt.datetime) -> Column:
    """A timestamp literal without zone (driver timestamps are TIMESTAMP_NTZ)."""
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def date_lit(d: dt.date) -> Column:
    return F.lit(d.isoformat()).cast("date")


def month_bounds(d: dt.date) -> tuple[dt.datetime, dt.datetime]:
    start = dt.datetime(d.year, d.month, 1)
    end = dt.datetime(d.year + (d.month == 12), d.month % 12 + 1, 1)
    return start, end


def in_month(c, as_of: dt.datetime) -> Column:
    """P10: ``YEAR(c) = YEAR(as_of) AND MONTH(c) = MONTH(as_of)`` as a half-open range."""
    start, end = month_bounds(as_of.date())
    return (col_of(c) >= ts_lit(start)) & (col_of(c) < ts_lit(end))


def in_year(c, year: int) -> Column:
    """``YEAR(c) = year`` as a half-open range."""
    return (col_of(c) >= ts_lit(dt.datetime(year, 1, 1))) & (col_of(c) < ts_lit(dt.datetime(year + 1, 1, 1)))


def holds_date(start, end, d: dt.date) -> Column:
    """``d BETWEEN start AND end``."""
    return date_lit(d).between(col_of(start), col_of(end))


def business_day(c, d: dt.date) -> Column:
    """``c >= d AND c < d + 1 day``."""
    t0 = dt.datetime(d.year, d.month, d.day)
    return (col_of(c) >= ts_lit(t0)) & (col_of(c) < ts_lit(t0 + dt.timedelta(days=1)))


def financial_day(c, d: dt.date, hours: int) -> Column:
    """The business day shifted by ``hours``: ``[d + h, d + 1 day + h)``."""
    t0 = dt.datetime(d.year, d.month, d.day) + dt.timedelta(hours=hours)
    return (col_of(c) >= ts_lit(t0)) & (col_of(c) < ts_lit(t0 + dt.timedelta(days=1)))


def since_months(c, d: dt.date, months: int) -> Column:
    """``c >= DATEADD(MONTH, -n, d)``; month ends clamp as in T-SQL (Apr 30 -> Feb 28)."""
    return col_of(c) >= F.add_months(date_lit(d), -months).cast("timestamp_ntz")
