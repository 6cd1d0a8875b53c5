"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node id reachable over ``edges`` (u, v long, any direction).

    Only nodes with an edge to another node appear; null ends and loops link nothing. Each round's
    edges are written to the shared folder. Minima are aggregated before the shuffle and edges meet
    them in a join, so a hub's edges are never gathered in one group. No edges give no rows.
    """
    e = (edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"),
                      (F.col("u").isNull() | F.col("v").isNull()).alias("no"))
         .where("NOT no AND u <> v").select("u", "v").distinct())
    e = materialise(e, "edges")
    seen = None
    for _ in range(max_rounds):
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = state
        if state[0] == 0:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        e = materialise(_small_star(_large_star(e)).where("u <> v").distinct(), "edges")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
