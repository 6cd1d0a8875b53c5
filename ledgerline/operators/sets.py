"""Set operations with SQL's duplicate rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

__all__ = ["distinct_keys", "union_distinct", "union_all", "keyed_measures"]


def distinct_keys(*dfs: DataFrame, keys: list[str]) -> DataFrame:
    """``SELECT keys FROM a UNION SELECT keys FROM b UNION ...`` (U1): duplicates removed, NULL keys
    grouped together. Each input is de-duplicated map-side before the union's shuffle."""
    parts = [d.select(*keys) for d in dfs]
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """``UNION`` of two aligned branches (U2): exact duplicate rows go, also within one branch."""
    return a.unionByName(b).distinct()


def union_all(*dfs: DataFrame) -> DataFrame:
    """``UNION ALL``."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def keyed_measures(frames: list[tuple[DataFrame, list[str]]], keys: list[str]) -> DataFrame:
    """``UNION`` of the key sets of several per-key frames, each key row carrying every frame's
    measures as a ``LEFT JOIN`` back on all keys would (U1 + J-03), computed in one pass.

    Each frame is unique per key (it is a GROUP BY result). The frames are stacked with NULL padding
    and grouped by the keys; a measure attaches only when every key part is non-NULL, because an
    equality join never matches NULL (such key rows keep NULL measures, to be defaulted by the
    caller). Each input is read once, instead of once for the key set and once per join."""
    from pyspark.sql import functions as F
    measures = [m for _, ms in frames for m in ms]
    types = {m: df.schema[m].dataType for df, ms in frames for m in ms}
    parts = [df.select(*keys, *[(F.col(m) if m in ms else F.lit(None)).cast(types[m]).alias(m) for m in measures])
             for df, ms in frames]
    stacked = reduce(lambda a, b: a.unionByName(b), parts)
    all_keys = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return stacked.groupBy(*keys).agg(*[F.sum(F.when(all_keys, F.col(m))).alias(m) for m in measures])
