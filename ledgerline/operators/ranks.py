"""Global ranks without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGES = 512


def global_rank(df: DataFrame, col: str, out: str = "rank", ranges: int = RANGES) -> DataFrame:
    """``rank() OVER (ORDER BY col DESC)`` over a whole frame: rows with equal values share a rank, the next one follows by
    their number; NULLs come last and share theirs.

    Values are counted first (partial aggregation). Their range is cut at approximate quantiles of the distinct values, at
    most ``ranges`` of them; a value's rank is one, plus the counts of the ranges above its own (an array of at most
    ``ranges`` numbers, a scalar subquery), plus those of the greater values inside its range (a window per range). Rows
    find their value's rank by an equi join. NaN ranks above all numbers, as in the window function."""
    cut = [k / ranges for k in range(1, ranges)]
    values = df.groupBy(F.col(col).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    bounds = values.agg(F.array_distinct(F.percentile_approx("__v", cut, 10 * ranges))).scalar()
    # the number of bounds that a value is above; NULL below all of them
    at = F.when(F.col("__v").isNull() | F.col("__b").isNull(), F.lit(-1)).otherwise(F.size(F.filter("__b", lambda b: b < F.col("__v"))))
    placed = values.withColumn("__b", bounds).select("__v", "__n", at.alias("__r"))
    totals = placed.groupBy("__r").agg(F.sum("__n").alias("__n"))
    totals = totals.agg(F.collect_list(F.struct("__r", "__n"))).scalar()
    above = F.aggregate(F.filter("__t", lambda t: t["__r"] > F.col("__r")), F.lit(0).cast("bigint"), lambda s, t: s + t["__n"])
    inside = Window.partitionBy("__r").orderBy(F.desc_nulls_last("__v")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("__t", totals).select("__v", (F.lit(1) + above + F.coalesce(F.sum("__n").over(inside), F.lit(0))).cast("int").alias(out))
    return df.join(ranked, F.col(col).eqNullSafe(F.col("__v"))).drop("__v")
