"""Reconciliation of two versions (K8) and match rate of a join (K9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def _hashes(cols: list[str]) -> tuple[Column, Column]:
    """Two hashes of a row; which columns are NULL counts, too."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
    return F.xxhash64(nulls, *cols), F.xxhash64(F.lit(1), *reversed(cols), nulls)


def _sides(a: DataFrame, b: DataFrame) -> DataFrame:
    cols = a.columns
    return a.withColumn("__side", F.lit(0)).unionByName(b.select(*cols).withColumn("__side", F.lit(1)))


def _counts() -> list[Column]:
    return [F.sum(F.when(F.col("__side") == s, 1).otherwise(0)).alias(n) for s, n in ((0, "__a"), (1, "__b"))]


def bucket_marks(a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Per bucket of row hashes: rows of both versions, and whether they hold the same rows, by count and by the difference
    of two order-free sums of 64-bit hashes. Summed per task first, so ``buckets`` narrow rows a task are shuffled."""
    h, g = _hashes(a.columns)
    signed = lambda c: F.sum(F.when(F.col("__side") == 0, c).otherwise(-c)) == 0
    both = _sides(a, b).select("__side", h.alias("__h"), g.alias("__g"))
    marks = both.groupBy(F.pmod(F.col("__h"), F.lit(buckets)).alias("__bucket")).agg(
        *_counts(), signed(F.col("__h").cast("decimal(20,0)")).alias("__h0"), signed(F.col("__g").cast("decimal(20,0)")).alias("__g0"))
    return marks.select("__bucket", "__a", "__b", ((F.col("__a") == F.col("__b")) & F.col("__h0") & F.col("__g0")).alias("__same"))


def differing_rows(a: DataFrame, b: DataFrame, buckets: int = BUCKETS, marks: DataFrame | None = None) -> DataFrame:
    """The distinct rows of the buckets that differ, with how often each version holds them (``__a``, ``__b``): only these
    rows are shuffled, none if the versions are equal. The list of buckets is at most ``buckets`` rows and broadcast."""
    marks = bucket_marks(a, b, buckets) if marks is None else marks
    differ = F.broadcast(marks.filter(~F.col("__same")).select("__bucket"))
    rows = _sides(a, b).withColumn("__bucket", F.pmod(_hashes(a.columns)[0], F.lit(buckets)))
    return rows.join(differ, "__bucket", "left_semi").groupBy(*a.columns).agg(*_counts())


def reconcile(a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """K8: row counts of both versions, whether they are equal, and the multiset differences both
    ways, so equal counts with different rows are caught too. One output row.

    Fingerprints of buckets of rows are compared first; only buckets that differ are compared row by row. Two versions pass
    for equal if in each bucket the counts and two sums of independent 64-bit row hashes agree."""
    marks = bucket_marks(a, b, buckets)
    more = F.col("__a") - F.col("__b")
    same = marks.filter("__same").select("__a", "__b", F.lit(0).cast("bigint").alias("__x"), F.lit(0).cast("bigint").alias("__y"))
    rows = differing_rows(a, b, buckets, marks).select("__a", "__b", F.greatest(more, F.lit(0)).alias("__x"),
                                                       F.greatest(-more, F.lit(0)).alias("__y"))
    figures = {"rows_a": "__a", "rows_b": "__b", "only_a": "__x", "only_b": "__y"}
    out = same.unionByName(rows).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(n) for n, c in figures.items()])
    return out.withColumn("counts_equal", F.col("rows_a") == F.col("rows_b"))


def match_rate(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """K9: the share of rows of ``df`` with at least one matching row in ``other``, over all rows.
    ``other`` is reduced to distinct keys first, so its duplicates do not multiply rows."""
    keys = other.select(F.col(other_key).alias("__m")).distinct()
    j = df.join(keys, F.col(key) == F.col("__m"), "left")
    return j.agg(F.count(F.lit(1)).alias("rows"), F.count("__m").alias("matched"),
                 F.try_divide(F.count("__m").cast("double"), F.count(F.lit(1)).cast("double")).alias("match_rate"))
