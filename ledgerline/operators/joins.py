"""Joins whose SQL semantics need care on Spark.

Every operator here is an equi join, a semi/anti join, an aggregate or a window; none emits all
pairs of a group. Calendars and parameter lists, which don't grow with the data, are the only broadcast sides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.exprs import as_text_of

__all__ = [
    "left_on_true", "period_days",
    "attach_period", "prev_period", "not_in_list", "not_in_rows", "sum_by_either", "latest_effective",
]


def left_on_true(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left LEFT JOIN right ON 1 = 1`` (J-08) for a dictionary-like ``right``.

    The right rows become one array, a scalar subquery that runs with the job, and every left row explodes it with
    ``explode_outer``: a left row stays once with NULLs when ``right`` is empty, and duplicates in ``right`` keep
    their multiplicity. Nothing runs while the frame is built, and no row count changes the plan.
    """
    rows = right.agg(F.collect_list(F.struct(*[F.col(c) for c in right.columns]))).scalar()
    out = left.withColumn("__r", F.explode_outer(rows))
    return out.select(*[F.col(c) for c in left.columns], *[F.col("__r")[c].alias(c) for c in right.columns])


MOST_DAYS = 3660  # days of a period that are written out


def period_days(periods: DataFrame, id_col: str = "ID", start: str = "StartDate", end: str = "EndDate",
                day_col: str = "__day") -> DataFrame:
    """One row per (period, day in [start, end]). A period of more than ten years fails: ``intervals.interval_join`` takes
    those."""
    first, last = F.col(start).cast("date"), F.col(end).cast("date")
    days = F.when(F.datediff(last, first) >= MOST_DAYS, F.raise_error(F.lit(f"a period of over {MOST_DAYS} days: use interval_join"))
                  .cast("array<date>")).when(first <= last, F.sequence(first, last))
    return periods.select(F.col(id_col).alias("__pid"), F.explode(days).alias(day_col), *[F.col(c) for c in periods.columns if c != id_col])


def attach_period(df: DataFrame, date_col: str, periods: DataFrame, how: str = "inner",
                  id_col: str = "ID", start: str = "StartDate", end: str = "EndDate",
                  out_col: str = "PeriodID", keep: tuple = ()) -> DataFrame:
    """``df JOIN periods ON df.date BETWEEN start AND end`` (J-10) for a calendar of periods, as an equi join on the day.

    Periods are written out as days, so the join is a hash join on a date instead of a nested loop; overlapping periods
    keep BETWEEN's multiplicity. ``periods`` is a calendar (months of some years): its day table has a row per day and
    period, whatever the facts hold, and is broadcast. Long or open-ended periods, time stamps, and tables of periods that
    grow with the data are ``intervals.interval_join``'s.
    """
    days = period_days(periods.select(id_col, start, end, *keep), id_col, start, end)
    days = days.select(F.col("__pid").alias(out_col), "__day", *keep)
    return df.join(F.broadcast(days), F.col(date_col).cast("date") == F.col("__day"), how).drop("__day")


def prev_period(left: DataFrame, right: DataFrame, keys: list[str], period_col: str = "PeriodID",
                how: str = "left", offset: int = 1) -> DataFrame:
    """Join ``right`` rows of period ``id - offset`` (J-11). Gaps in ids give no match: this is an
    equi join on the shifted id, not ``lag``. Right-side keys are renamed, so ``left`` and ``right``
    may come from the same frame (a self join)."""
    rk = {k: f"__pk_{k}" for k in keys}
    r = right.select(*[F.col(k).alias(rk[k]) for k in keys], F.col(period_col).alias("__prev_pid"),
                     *[F.col(c) for c in right.columns if c not in keys and c != period_col])
    cond = [F.col(k) == F.col(rk[k]) for k in keys] + [(F.col(period_col) - F.lit(offset)) == F.col("__prev_pid")]
    return left.join(r, reduce(lambda a, b: a & b, cond), how).drop(*rk.values(), "__prev_pid")


def not_in_list(df: DataFrame, value: Column, values: DataFrame, list_col: str = "col") -> DataFrame:
    """``value NOT IN (SELECT col FROM values)`` with SQL's NULL rules (J-15).

    A NULL in the list removes every row; a NULL ``value`` is removed when the list is non-empty.
    Spark plans this as a null-aware anti join, which is a hash join only when the list is
    broadcast: use it for bounded lists (parameter values), and ``not_in_rows`` for a list that is an unbounded table.
    """
    v, c = "__nin_v", "__nin_c"
    left = df.withColumn(v, value)
    right = values.select(as_text_of(left, v, F.col(list_col)).alias(c))
    # null-aware: a row goes if it equals a list value or the comparison is unknown
    return left.join(F.broadcast(right), (F.col(v) == F.col(c)) | (F.col(v) == F.col(c)).isNull(), "left_anti").drop(v)


def not_in_rows(df: DataFrame, value: Column, values: DataFrame, list_col: str = "col") -> DataFrame:
    """``value NOT IN (SELECT col FROM values)`` with SQL's NULL rules (J-15), for a list of any size.

    Whether the list is empty and whether it holds a NULL are two figures of one aggregate: an empty list keeps every row,
    one with a NULL none, and any other those whose value isn't NULL and isn't in it. The last is a ``left_anti`` equi join on the
    list's distinct values, so nothing needs to be broadcast, and a value that a third of all rows share is split like
    any skewed join key."""
    v, c = "__nin_v", "__nin_c"
    size = values.agg(F.struct(F.count(F.lit(1)).alias("rows"), F.count(F.col(list_col)).alias("known"))).scalar()
    may = (size["rows"] == 0) | ((size["rows"] == size["known"]) & F.col(v).isNotNull())
    left = df.withColumn(v, value)
    right = values.select(as_text_of(left, v, F.col(list_col)).alias(c)).filter(F.col(c).isNotNull()).distinct()
    return left.filter(may).join(right, F.col(v) == F.col(c), "left_anti").drop(v)


def sum_by_either(df: DataFrame, a: str, b: str, fact: DataFrame, key: str, measure: Column,
                  out_col: str) -> DataFrame:
    """Per row of ``df``: ``SUM(measure)`` over fact rows whose ``key`` equals ``a`` OR ``b`` (J-16).

    The fact is pre-summed by key once (partial aggregation before the shuffle, so a hot key costs
    one row per partition), then joined twice by equality. The second join is skipped where
    ``a <=> b`` so a fact row matching both keys counts once; a NULL key matches nothing. The result
    is NULL when no fact row matches, as an empty SUM.
    """
    sums = fact.groupBy(F.col(key).alias("__k")).agg(F.sum(measure).alias("__s"))
    sa = sums.select(F.col("__k").alias("__ka"), F.col("__s").alias("__sa"))
    sb = sums.select(F.col("__k").alias("__kb"), F.col("__s").alias("__sb"))
    out = df.join(sa, F.col(a) == F.col("__ka"), "left")
    out = out.join(sb, (F.col(b) == F.col("__kb")) & ~F.col(a).eqNullSafe(F.col(b)), "left")
    total = F.when(F.col("__sa").isNull() & F.col("__sb").isNull(), F.lit(None)).otherwise(
        F.coalesce(F.col("__sa"), F.lit(0)) + F.coalesce(F.col("__sb"), F.lit(0)))
    return out.withColumn(out_col, total).drop("__ka", "__sa", "__kb", "__sb")


def latest_effective(probes: DataFrame, maps: DataFrame, probe_keys: list[Column], map_keys: list[Column],
                     probe_ts: str, map_eff: str, map_id: str, map_value: str, out_col: str,
                     bucket: str = "hour") -> DataFrame:
    """Per probe: the value of the mapping with the greatest id among those with the same keys and
    ``eff <= ts`` (J-17; ``OUTER APPLY (SELECT TOP 1 ... ORDER BY id DESC)``). NULL if none.

    Keys compare with ``=``: pass ``coalesce(x, '')`` for keys the source compares null-safely.
    A probe or mapping with a NULL key matches nothing; every probe row is returned once.

    No pairs are formed, and every window's group is bounded by the clock instead of by the rows. Mappings and probes are
    first reduced to one row per key and instant (partial aggregation, so neither a bulk load with one time nor a
    burst of probes grows a group). Time is cut into buckets (an hour by default), these into seconds, and the best
    mapping is carried downwards: over all buckets before (a row per bucket of a key), over the bucket's seconds before (at
    most a bucket's seconds), over the second's instants up to the probe's (at most a million). The greatest by id wins.
    Probe rows then find their instant's result by an equi join whose right side is unique, so a key, or an instant,
    that a third of all probes share is split like any skewed join key.
    """
    kn = [f"__k{i}" for i in range(len(probe_keys))]
    known = lambda cols: reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in cols])
    m = maps.select(*[c.alias(n) for c, n in zip(map_keys, kn)], F.col(map_eff).alias("__t"),
                    F.struct(F.col(map_id).alias("id"), F.col(map_value).alias("v")).alias("__s"))
    m = m.filter(known([*kn, "__t", "__s.id"]))
    vtype = m.schema["__s"].dataType
    p = probes.select("*", *[c.alias(n) for c, n in zip(probe_keys, kn)], F.col(probe_ts).alias("__t"))
    asked = p.filter(known([*kn, "__t"])).select(*kn, "__t", F.lit(None).cast(vtype).alias("__s"), F.lit(True).alias("__asked"))

    # one row per key and instant: its best mapping, and whether a probe asks for it
    at = asked.unionByName(m.withColumn("__asked", F.lit(False)))
    at = at.groupBy(*kn, "__t").agg(F.max("__s").alias("__s"), F.max("__asked").alias("__asked"))
    second, coarse = F.date_trunc("second", F.col("__t")), F.date_trunc(bucket, F.col("__t"))
    seconds = at.groupBy(*kn, coarse.alias("__b"), second.alias("__sec")).agg(F.max("__s").alias("__s"))
    buckets = seconds.groupBy(*kn, "__b").agg(F.max("__s").alias("__s"))

    def before(parts: list[str], order: str, last: int) -> Column:
        w = Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, last)
        return F.max("__s").over(w)

    earlier = buckets.select(*kn, "__b", before(kn, "__b", -1).alias("__e"))
    sooner = seconds.select(*kn, "__b", "__sec", before([*kn, "__b"], "__sec", -1).alias("__f"))
    carried = sooner.join(earlier, [*kn, "__b"]).select(*kn, "__sec", F.greatest("__e", "__f").alias("__e"))
    here = at.withColumn("__sec", second)
    here = here.withColumn("__f", before([*kn, "__sec"], "__t", Window.currentRow)).filter("__asked")
    found = here.join(carried, [*kn, "__sec"]).select(*kn, "__t", F.greatest("__e", "__f")["v"].alias(out_col))
    return p.join(found, [*kn, "__t"], "left").select(*[p[c] for c in probes.columns], out_col)
