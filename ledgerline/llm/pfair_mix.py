"""Mixing sources to target weights by a Pfair schedule of blocks.

Each source's documents, in an order given by a hash of their ids, make blocks of ``block_rows``. With integer
weights w of sum W a source's block i (from 0) is released at slot floor(i * W / w) and due before slot
ceil((i + 1) * W / w); in each slot the released block with the earliest deadline runs. On one processor these
deadlines all hold, so after any number t of slots a source has run less than one block more or less
than its share t * w / W. The schedule repeats after W slots; only that one period is worked out on the driver, and
every block's slot follows from it by arithmetic.

No document is left out or repeated: when a source has no block left, a new phase starts in which the
others share the slots by their weights. Phases are as many as sources at most.

Places within a source come from counts in two levels of hash ranges, so no window holds a whole source.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import fresh

BLOCK_ROWS = 64
RANGE_BITS = 8  # of each of the two levels: 65,536 hash ranges a source
MOST_WEIGHT = 100
MOST_SLOTS = 1_000_000  # sum of weights: the period that the driver works out


def period(weights: list[int]) -> np.ndarray:
    """Which source runs in each slot of one period (the sum of the weights)."""
    total = sum(weights)
    if not weights or min(weights) < 1:
        raise ValueError("weights are positive integers")
    if total > MOST_SLOTS:
        raise ValueError(f"the weights' sum is over {MOST_SLOTS}")
    waiting = [(0, s, 0) for s in range(len(weights))]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []  # deadline, source, block
    out = np.empty(total, np.int64)
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * total // weights[s]), s, i))
        _, s, i = heapq.heappop(ready)
        out[slot] = s
        if i + 1 < weights[s]:
            heapq.heappush(waiting, ((i + 1) * total // weights[s], s, i + 1))
    return out


def target_weights(docs: DataFrame, most: int = MOST_WEIGHT) -> dict[str | None, int]:
    """Weights of all sources of docs (source, text), by their name: the square root of a source's characters over all
    rows, so that a large source gets more slots but not in proportion, as integers from 1 to ``most`` for the
    largest (less if the period would pass MOST_SLOTS). A null source has the key None; null texts have no characters.
    """
    sizes = {r["source"]: r["n"] or 0 for r in docs.groupBy(F.col("source").cast("string").alias("source")).agg(
        F.sum(F.length(F.col("text").cast("string"))).alias("n")).collect()}  # one row a source
    top = max(sizes.values(), default=0)
    most = max(1, min(most, MOST_SLOTS // max(1, len(sizes))))
    return {s: max(1, round(most * math.sqrt(n / top))) if top else 1 for s, n in sizes.items()}


@dataclass(frozen=True)
class Phase:
    """A source's part of a phase: its blocks first_block <= b < end_block run in the slots
    first_slot + (i // weight) * period + slots[i % weight], i counting from first_block."""

    source: int
    first_block: int
    end_block: int
    first_slot: int
    weight: int
    period: int
    slots: list[int]


def phases(blocks: list[int], weights: list[int]) -> list[Phase]:
    """The whole schedule of sources with so many blocks each."""
    done, slot, out = [0] * len(blocks), 0, []
    while True:
        live = [s for s in range(len(blocks)) if done[s] < blocks[s]]
        if not live:
            return out
        w = [weights[s] for s in live]
        order, total = period(w), sum(w)
        slots = [np.flatnonzero(order == k) for k in range(len(live))]
        # the phase ends with the first slot whose source has nothing left
        left = [blocks[s] - done[s] for s in live]
        length = min((n // w[k]) * total + int(slots[k][n % w[k]]) for k, n in enumerate(left))
        for k, s in enumerate(live):
            n = length // total * w[k] + int(np.searchsorted(slots[k], length % total))
            if n:
                out.append(Phase(s, done[s], done[s] + n, slot, w[k], total, slots[k].tolist()))
            done[s] += n
        slot += length


def placed(docs: DataFrame, weights: Mapping[str, int] | None = None, default_weight: int = 1,
           block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns for place in source, block, slot and position, and their names by these four keys.

    position numbers all rows from 0 without gaps; place, block and slot count from 0. A null source is a source
    of its own. Order within a source: xxhash64 of doc_id, then doc_id; rows that share a doc_id (or have none)
    take neighbouring places in no fixed order. Sources that ``weights`` doesn't name have ``default_weight``.
    """
    spark = docs.sparkSession
    hashed, high, low, low_n, ahead, names = *fresh(docs, "mix_hash", "mix_high", "mix_low", "mix_low_n", "mix_ahead"), {}
    for k in ("place", "block", "slot", "position"):
        names[k], = fresh(docs, k)
    src, = fresh(docs, "mix_source")
    h = F.xxhash64("doc_id")
    d = docs.withColumns({
        hashed: h, high: F.shiftrightunsigned(h, 64 - RANGE_BITS).cast("int"),
        low: (F.shiftrightunsigned(h, 64 - 2 * RANGE_BITS) % (1 << RANGE_BITS)).cast("int"),
        # null becomes a name of its own
        src: F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source").cast("string")))})
    counts = d.groupBy(src, high, low).agg(F.count("*").alias(low_n))
    tops = counts.groupBy(src, high).agg(F.sum(low_n).alias("n"))
    sizes = {r[src]: r["n"] for r in tops.groupBy(src).agg(F.sum("n").alias("n")).collect()}  # one row a source
    if not sizes:
        return docs.withColumns({c: F.lit(None).cast("long") for c in names.values()}), names
    wide = Window.partitionBy(src).orderBy(high).rowsBetween(Window.unboundedPreceding, -1)
    near = Window.partitionBy(src, high).orderBy(low).rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select(src, high, F.coalesce(F.sum("n").over(wide), F.lit(0)).alias("top"))
    starts = (counts.select(src, high, low, F.coalesce(F.sum(low_n).over(near), F.lit(0)).alias("lows"))
              .join(tops, [src, high]).select(src, high, low, (F.col("top") + F.col("lows")).alias(ahead)))
    inside = Window.partitionBy(src, high, low).orderBy(hashed, "doc_id")
    d = d.withColumn(names["place"], F.row_number().over(inside).cast("long") - 1)
    d = (d.join(starts, [src, high, low]).withColumn(names["place"], F.col(names["place"]) + F.col(ahead))
         .drop(ahead, hashed, high, low))
    d = d.withColumn(names["block"], F.floor(F.col(names["place"]) / block_rows).cast("long"))

    order = sorted(sizes)
    w = [int((weights or {}).get(s[1:], default_weight)) if s else default_weight for s in order]
    plan = phases([-(-sizes[s] // block_rows) for s in order], w)
    rows = [(order[p.source], p.first_block, p.end_block, p.first_slot, p.weight, p.period, p.slots) for p in plan]
    # as an Arrow table: rows of Python objects would be turned by Python workers of their own kind, which stay beside the others
    kinds = [("b0", pa.int64()), ("b1", pa.int64()), ("s0", pa.int64()), ("w", pa.int64()), ("period", pa.int64()), ("slots", pa.list_(pa.int64()))]
    table = spark.createDataFrame(pa.Table.from_arrays(
        [pa.array(x, t) for x, t in zip(zip(*rows), [pa.string(), *[t for _, t in kinds]])], [f"{src}_", *[k for k, _ in kinds]]))
    b = F.col(names["block"])
    parts = [c for c in d.columns if c != src]
    got = d.join(F.broadcast(table), (F.col(src) == F.col(f"{src}_")) & (b >= F.col("b0")) & (b < F.col("b1")))
    i = b - F.col("b0")
    slot = F.col("s0") + F.floor(i / F.col("w")) * F.col("period") + F.get("slots", (i % F.col("w")).cast("int"))
    got = got.withColumn(names["slot"], slot.cast("long")).select(*parts, names["slot"])
    # a source's last block may be short: positions behind it move up
    short = {}
    for p in plan:
        if p.end_block == -(-sizes[order[p.source]] // block_rows):
            i0 = p.end_block - 1 - p.first_block
            lacks = p.end_block * block_rows - sizes[order[p.source]]
            if lacks:
                short[p.first_slot + i0 // p.weight * p.period + p.slots[i0 % p.weight]] = lacks
    position = F.col(names["slot"]) * block_rows + F.col(names["place"]) % block_rows
    if short:
        gaps = F.array(*[F.struct(F.lit(k).cast("long").alias("slot"), F.lit(v).cast("long").alias("lacks"))
                         for k, v in sorted(short.items())])
        position = position - F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: F.when(
            x["slot"] < F.col(names["slot"]), a + x["lacks"]).otherwise(a))
    return got.withColumn(names["position"], position.cast("long")).select(*docs.columns, *names.values()), names


def mix(docs: DataFrame, weights: Mapping[str, int] | None = None, default_weight: int = 1,
        block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, source, place, block, slot, position per row of docs; other columns are ignored. See ``placed``.

    An empty table gives no rows.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string"))
    return placed(slim, weights, default_weight, block_rows)[0]


def mixed(docs: DataFrame, weights: Mapping[str, int] | None = None, default_weight: int = 1,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """docs in mixed order: partitions are ranges of positions, sorted, so written files hold the mix in order.

    Every row and column is kept; a null source is a source of its own, texts aren't read, so they may be null or of any
    length; repeated rows and rows without doc_id tie within their source; an empty table stays empty."""
    d, names = placed(docs, weights, default_weight, block_rows)
    p = names["position"]
    return d.repartitionByRange(p).sortWithinPartitions(p).select(*docs.columns)
