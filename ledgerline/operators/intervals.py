"""Joins of points with intervals (J-10) as equi joins, for intervals of any length.

An interval of whole numbers (days, or microseconds) is cut into bins of a hierarchy whose widths grow by FAN: the
fewest that cover it exactly, so a month is a handful of bins and a period that ends in the year 9999 some tens. A
point has one bin per width. Bins of an interval don't overlap, so a point meets an interval it lies in exactly once,
and none other: no residual condition, and overlapping intervals keep their multiplicity.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["interval_bins", "interval_join", "estimated_bytes", "broadcast_if_small"]

FAN_BITS = 3  # bins of a width are cut into 8 of the next smaller one
DAY_US = 86_400_000_000
_DAY_BITS, _US_BITS = 23, 59  # what the years 1 to 9999 need; the widest bins stay below 64 bits


def _micros(c: Column) -> Column:
    """Microseconds of a time stamp's (or a date's midnight's) fields since 1970, whatever the session's time zone."""
    t = c.cast("timestamp_ntz")
    clock = (F.hour(t) * 3600 + F.minute(t) * 60).cast("long") * 1_000_000
    return F.unix_date(t.cast("date")).cast("long") * DAY_US + clock + (F.date_part(F.lit("SECONDS"), t) * 1_000_000).cast("long")


def _widths(days: bool) -> range:
    return range(0, -(-(_DAY_BITS if days else _US_BITS) // FAN_BITS) + 1)


def _bin(level: int) -> Callable[[Column], Column]:
    return lambda x: F.struct(F.lit(level).alias("level"), x.alias("bin"))


def _runs(start: Column, end: Column, days: bool) -> list[tuple[int, Column, Column]]:
    """(level, a, b): the bins from a up to, but without, b that cover [start, end] with the others; none if a >= b."""
    parts = []
    for k in _widths(days):
        # whole bins of this width inside the interval, without those that the next width's bins cover
        shift, up = k * FAN_BITS, (k + 1) * FAN_BITS
        low = -F.shiftright(-start, shift)
        high = F.shiftright(end + 1, shift)
        inner_low = F.shiftleft(-F.shiftright(-start, up), FAN_BITS)
        inner_high = F.shiftleft(F.shiftright(end + 1, up), FAN_BITS)
        covered = inner_low < inner_high
        parts += [(k, low, F.when(covered, inner_low).otherwise(high)), (k, F.when(covered, inner_high).otherwise(high), high)]
    return parts


def interval_bins(start: Column, end: Column, days: bool) -> Column:
    """An array of (level, bin) that covers [start, end] (whole numbers); empty if start > end, NULL if one is NULL."""
    parts = [F.when(a < b, F.transform(F.sequence(a, F.greatest(a, b - 1)), _bin(k))) for k, a, b in _runs(start, end, days)]
    empty = F.array().cast("array<struct<level:int,bin:bigint>>")
    return F.when(start.isNotNull() & end.isNotNull(), F.flatten(F.array(*[F.coalesce(x, empty) for x in parts])))


def _point_bins(point: Column, days: bool) -> Column:
    return F.array(*[_bin(k)(F.shiftright(point, k * FAN_BITS)) for k in _widths(days)])


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's upper estimate of a frame's size, from file sizes and row widths; nothing runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_if_small(df: DataFrame, factor: int = 1, otherwise: str | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its estimate times ``factor`` is within the session's broadcast threshold; else with the
    hint ``otherwise``, or as it is, for the planner to decide by its own estimate."""
    limit = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    bound = int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)) if not limit.startswith("-") else -1
    if estimated_bytes(df) * factor <= bound:
        return F.broadcast(df)
    return df.hint(otherwise) if otherwise else df


def interval_join(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str, on: list[str] = (),
                  how: str = "inner", keep: list[str] = (), open_end: bool = False) -> DataFrame:
    """``points JOIN intervals ON point BETWEEN start AND end`` (and equal ``on`` columns), with columns ``keep`` of the
    intervals; ``how``: inner or left.

    Bounds and points are dates, or time stamps to the microsecond; where both kinds meet, a date is its midnight. A NULL point
    or bound matches nothing; with ``open_end`` a NULL end means that the interval doesn't end. An interval that ends before it
    starts is empty. Overlapping and repeated intervals give a row each; a point in no interval is dropped (inner) or keeps
    one row with NULLs (left).

    The distinct points (and ``on`` values) are narrow and few where the points are days; they meet the bins in an equi
    join, and the rows then meet their point's intervals in another. The planner's estimates don't know how many bins a row
    becomes, so it may not choose a broadcast of them: bins are broadcast if the most that they can be is small, else
    both sides are shuffled and merged. A point that a third of all rows share is a skewed join key that is split at run
    time.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    kinds = [df.schema[c].dataType for df, c in ((points, point), (intervals, start), (intervals, end))]
    days = all(isinstance(t, T.DateType) for t in kinds)
    number = (lambda c: F.unix_date(c).cast("long")) if days else _micros
    names = {c: f"__i{k}" for k, c in enumerate(dict.fromkeys([*on, *keep]))}
    last = number(F.col(end))
    if open_end:
        far = number(F.lit("9999-12-31").cast("date")) + (0 if days else DAY_US - 1)
        last = F.coalesce(last, far)
    # the bins of ``interval_bins``, exploded in two steps: bounds are worked out once, and no array holds all bins
    bounds = intervals.select(*[F.col(c).alias(n) for c, n in names.items()], number(F.col(start)).alias("__from"), last.alias("__to"))
    runs = [F.struct(F.lit(k).alias("level"), a.alias("a"), b.alias("b")) for k, a, b in _runs(F.col("__from"), F.col("__to"), days)]
    runs = bounds.select(*names.values(), F.explode(F.array(*runs)).alias("__r")).filter("__r.a < __r.b")
    bins = runs.select(*names.values(), F.col("__r.level").alias("__level"),
                       F.explode(F.sequence(F.col("__r.a"), F.col("__r.b") - 1)).alias("__bin"))
    keys = [F.col(c).alias(f"__o{k}") for k, c in enumerate(on)]
    mine = points.withColumns({f"__o{k}": F.col(c) for k, c in enumerate(on)} | {"__p": number(F.col(point))})
    asked = mine.select(*[f"__o{k}" for k in range(len(keys))], "__p").filter(F.col("__p").isNotNull()).distinct()
    asked = asked.withColumn("__b", F.explode(_point_bins(F.col("__p"), days)))
    same = [F.col(f"__o{k}") == F.col(names[c]) for k, c in enumerate(on)]
    here = reduce(lambda a, b: a & b, [F.col("__b.level") == F.col("__level"), F.col("__b.bin") == F.col("__bin"), *same])
    most = 2 * ((1 << FAN_BITS) - 1) * len(_widths(days))  # bins of an interval
    found = asked.join(broadcast_if_small(bins, most, otherwise="merge"), here) \
        .select(*[F.col(f"__o{k}").alias(f"__f{k}") for k in range(len(on))], F.col("__p").alias("__q"), *[names[c] for c in keep])
    match = reduce(lambda a, b: a & b, [F.col("__p") == F.col("__q"), *[F.col(f"__o{k}") == F.col(f"__f{k}") for k in range(len(on))]])
    out = mine.join(found, match, how)
    return out.select(*[mine[c] for c in points.columns], *[F.col(names[c]).alias(c) for c in keep])
