"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

A document's set holds its distinct five-word shingles (words are runs without ASCII white space,
A-Z lower-cased; a shorter text counts as one shingle, a text without words has the empty set).
Documents link when 100 * |A and B| >= threshold * |A or B|.

1. Corpus counts: every shingle of every document is counted in a table of fixed size (hashed
   counters, added up per task before the shuffle). (counter, hash) is one total order for all
   documents, rare shingles first. Any total order gives the same links; a good one gives few candidates.
2. Prefix: of a set of n shingles the first n - ceil(threshold * n) + 1 in that order are indexed. Two
   sets that link share one of these. A task indexes a set once; later copies in the same task
   link to the first, so a large group of copies shrinks before the shuffle.
3. In each bucket of a shared prefix shingle the number of documents is exact. A document's shared shingles are
   ranked by it; a shingle's slack is the number of shared shingles from there to the most frequent one. A pair needs
   to meet only where its slack can make up the needed overlap (``_near``), besides the length and positional filters.
4. Pivot pairs: each document meets one document, that which is the smallest id in most of its buckets. Then all
   shingles that both prefixes hold, plus what lies behind them, must reach the needed overlap. Only for documents of
   pairs that are left whole sets are made; the suffix filter (sizes of both sets in 16 fixed hash ranges bound
   the overlap) comes before the intersection, and each pair is verified once.
5. Cross pairs: buckets that now hold several components (a large group of near copies is one by now) pair up
   documents of different components, by the same filters. A pair inside one component can't change the result.

Sets are compared by 64-bit shingle hashes. Nothing but the counter table (2**22 16-bit logarithms) and a bit set of
fixed size reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import as_bytes, filter_bits, filter_places, fresh, give_back, key_filter, materialise, slices_of, sum_slices
from ledgerline.llm.graph import components

WORDS = 5
THRESHOLD = 80  # per cent
COUNTER_BITS = 22  # corpus counters: 2**22
SLICES = 256
RANGES = 16  # of the suffix filter
ROWS = 1000  # whose shingles are held at once
CACHED_WORDS = 200_000
HELD = 1 << 19  # shingles that are counted at once

_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class _WordHash(dict):
    """Word to 64-bit hash; a bounded memo, emptied at the end of each task (workers live on)."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = h
        return h


_word_hash = _WordHash()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _C2
    h = (h ^ (h >> np.uint64(27))) * _C3
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes, width: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes (uint64) of a text's word n-grams."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    a = np.fromiter(map(_word_hash.__getitem__, words), np.uint64, len(words))
    w = min(width, len(a))
    h = np.full(len(a) - w + 1, w, np.uint64)
    for k in range(w):
        h = _mix(h * _C1 + a[k:len(a) - w + 1 + k])
    return np.unique(h)


def _corpus_counts(docs: DataFrame, width: int) -> np.ndarray:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTER_BITS, np.int32)
        sets, held = [], 0

        def add() -> None:
            # only the counters that occur: a full histogram of these few shingles would take more than the counters
            place, n = np.unique(np.concatenate(sets), return_counts=True)
            total[place] += n.astype(np.int32)

        for b in batches:
            for t in b.column(0):
                sets.append((shingles(t.as_py(), width) >> np.uint64(64 - COUNTER_BITS)).astype(np.int32))
                held += len(sets[-1])
                if held > HELD:
                    add()
                    sets, held = [], 0
        _word_hash.clear()
        if sets:
            add()
        sets.clear()
        yield from slices_of(total, SLICES)
        del total
        give_back()

    return sum_slices(docs.select("text").mapInArrow(count, "slice int, counts binary"), SLICES, 1 << COUNTER_BITS)


def _index(docs: DataFrame, counts: np.ndarray, width: int, threshold: int) -> DataFrame:
    """Per row of docs: doc_id, n (set size), first (the task's first id with this set), prefix (rare first)."""
    order = docs.sparkSession.sparkContext.broadcast(counts)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        rank = order.value
        for b in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            ids, n, first, prefix = b.column(0).to_pylist(), [], [], []
            for i, text in zip(ids, b.column(1).to_pylist()):
                h = shingles(text, width)
                n.append(len(h))
                one = i if not len(h) or i is None else seen.setdefault(xxhash.xxh3_128_digest(h.tobytes()), i)
                first.append(one)
                if one != i or not len(h) or i is None:
                    prefix.append(None)
                    continue
                keep = len(h) - (threshold * len(h) + 99) // 100 + 1
                r = rank[(h >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]
                prefix.append(h[np.lexsort((h, r))[:keep]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(first, pa.int64()),
                 pa.array(prefix, pa.list_(pa.int64()))], ["doc_id", "n", "first", "prefix"])
        _word_hash.clear()
        seen.clear()
        give_back()

    return docs.mapInArrow(rows, "doc_id long, n long, first long, prefix array<long>")


def _candidate_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, n, hashes, ranges) of the documents in ``ids``; others are skipped by a bit set, then a join."""

    field = key_filter(ids)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bit = filter_bits(field)
        for b in batches:
            b = b.filter(b.column(0).is_valid())
            i = b.column(0).to_numpy(zero_copy_only=False)
            b = b.filter(pa.array(bit[filter_places(i)]))
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                h = [shingles(t, width) for t in part.column(1).to_pylist()]
                ranges = [np.bincount((x >> np.uint64(60)).astype(np.int64), minlength=RANGES) for x in h]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) for x in h], pa.int64()),
                     pa.array([x.view(np.int64) for x in h], pa.list_(pa.int64())),
                     pa.array([x.astype(np.int32) for x in ranges], pa.list_(pa.int32()))],
                    ["id", "n", "hashes", "ranges"])
        _word_hash.clear()
        del bit
        give_back()

    found = docs.mapInArrow(sets, "id long, n long, hashes array<long>, ranges array<int>")
    return found.join(ids, "id", "left_semi")


def _near(threshold: int, a: tuple, b: tuple) -> F.Column:
    """Length, positional and slack filters at one shingle that two prefixes share. a, b: columns with the size of either
    set, the shingle's place in its order (from 0), and its slack, if known.

    A pair that links shares, within both prefixes, at least the needed overlap less what lies behind the
    prefix of either set. The rarest of these shingles, by the number of prefixes with it, has all others
    behind it in either document, so there the slack is as large; elsewhere the pair need not be formed."""
    (na, ia, sa), (nb, ib, sb) = a, b
    sizes = f"100 * least({na}, {nb}) >= {threshold} * greatest({na}, {nb})"
    place = f"(least({ia}, {ib}) + least({na} - {ia}, {nb} - {ib})) * {100 + threshold} >= {threshold} * ({na} + {nb})"
    behind = f"(floor(({threshold} * greatest({na}, {nb}) + 99) / 100) - 1)"
    slack = [f"({s} + {behind}) * {100 + threshold} >= {threshold} * ({na} + {nb})" for s in (sa, sb) if s]
    return F.expr(" AND ".join([sizes, place, *slack]))


def _enough_shared(pairs: DataFrame, shared: DataFrame, threshold: int) -> DataFrame:
    """Distinct pairs (a, b) whose prefixes share enough.

    The prefix that ends first in the common order has every shared shingle up to there; so the overlap is at most
    the shingles that both prefixes hold, and what lies behind the prefix of either set. (n and top: least and largest set of an id that several rows have.)"""
    least = shared.groupBy("id").agg(F.min("n").alias("n"), F.max("n").alias("top"), F.array_distinct(
        F.flatten(F.collect_list(F.transform("hs", lambda x: x["h"])))).alias("hs"))
    for k in "ab":
        pairs = pairs.join(least.select(F.col("id").alias(k), *[F.col(c).alias(f"{c}_{k}")
                                                                for c in ("n", "top", "hs")]), k)
    rest = F.expr(f"floor(({threshold} * greatest(top_a, top_b) + 99) / 100) - 1")
    most = F.expr("size(array_intersect(hs_a, hs_b))") + rest
    return pairs.where(most * (100 + threshold) >= threshold * F.expr("n_a + n_b")).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Of distinct pairs (a, b) those whose whole sets link."""
    sa = sets.select(F.col("id").alias("a"), *[F.col(c).alias(f"{c}_a") for c in ("n", "hashes", "ranges")])
    sb = sets.select(F.col("id").alias("b"), *[F.col(c).alias(f"{c}_b") for c in ("n", "hashes", "ranges")])
    need = f"{threshold} * (n_a + n_b)"
    could = f"{100 + threshold} * aggregate(zip_with(ranges_a, ranges_b, (x, y) -> least(x, y)), 0L, (s, x) -> s + x)"
    does = f"{100 + threshold} * size(array_intersect(hashes_a, hashes_b))"
    return (pairs.join(sb, "b").join(sa, "a")
            .where(F.expr(f"CASE WHEN {could} >= {need} THEN {does} >= {need} ELSE false END"))
            .select("a", "b"))


def jaccard_components(docs: DataFrame, width: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included) per row of docs.

    docs: doc_id long and text; other columns are ignored. Null, empty and blank texts have n_shingles 0
    and link with nothing; rows without doc_id keep a null component_id and link with nothing. Rows that repeat a
    doc_id give a row each with the id's common component; the links of all its texts count. An empty table
    gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes("text").alias("text"))
    index = materialise(_index(docs, _corpus_counts(docs, width), width, threshold), "ngram-index")
    w = Window.partitionBy("h")
    buckets = (index.where("prefix IS NOT NULL")
               .select(F.posexplode("prefix").alias("i", "h"), F.col("doc_id").alias("id"), "n")
               .withColumn("pivot", F.min(F.struct("id", "n", "i")).over(w))
               .withColumn("last", F.max("id").over(w)).withColumn("m", F.count("*").over(w))
               .where("pivot.id < last").drop("last"))
    # of each document the shared shingles, most frequent first: a shingle's place is its slack
    shared = materialise(buckets.groupBy("id", "n").agg(
        F.sort_array(F.collect_list(F.struct("m", "h", "i", "pivot")), asc=False).alias("hs")), "ngram-shared")
    rows = shared.select("id", "n", F.posexplode("hs").alias("slack", "x")).select(
        "id", "n", (F.col("slack") + 1).alias("slack"), "x.h", "x.i", "x.pivot")

    def links(pairs: DataFrame, name: str) -> DataFrame:
        pairs = materialise(_enough_shared(pairs, shared, threshold), f"ngram-{name}-pairs")
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        found = _verified(pairs, _candidate_sets(docs, ids, width), threshold)
        return materialise(found.select(F.col("a").alias("u"), F.col("b").alias("v")), f"ngram-{name}-links")

    pivots = (rows.where("id <> pivot.id")
              .where(_near(threshold, ("n", "i", "slack"), ("pivot.n", "pivot.i", None)))
              .groupBy("id", F.col("pivot.id").alias("a")).agg(F.count("*").alias("m"))
              .groupBy("id").agg(F.max_by("a", F.struct("m", -F.col("a"))).alias("a"))
              .select("a", F.col("id").alias("b")))
    copies = index.where("first <> doc_id").select(F.col("first").alias("u"), F.col("doc_id").alias("v"))
    comps = materialise(components(links(pivots, "pivot").union(copies)), "ngram-components")

    of = comps.select(F.col("node").alias("id"), "component")
    held = rows.join(of, "id", "left").select("h", "i", "id", "n", "slack", F.coalesce("component", "id").alias("c"))
    held = materialise(held, "ngram-rows")
    mixed = (held.groupBy("h", "c").agg(F.count("*").alias("m"))
             .groupBy("h").agg(F.count("*").alias("k"), F.max_by("c", F.struct("m", "c")).alias("most"))
             .where("k > 1").select("h", "most"))
    held = materialise(held.join(mixed, "h"), "ngram-mixed")
    few = held.where("c <> most").select("h", *[F.col(x).alias(f"{x}_x") for x in ("i", "id", "n", "slack", "c")])
    cross = (few.join(held, "h").where("c <> c_x AND (c = most OR c < c_x)")
             .where(_near(threshold, ("n", "i", "slack"), ("n_x", "i_x", "slack_x")))
             .select(F.least("id", "id_x").alias("a"), F.greatest("id", "id_x").alias("b")).distinct())
    more = links(cross, "cross")
    star = comps.where("node <> component").select(F.col("component").alias("u"), F.col("node").alias("v"))
    final = components(star.union(more))
    return (index.select("doc_id", F.col("n").alias("n_shingles"))
            .join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, width: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """docs with one row of each group of linked documents: that of the smallest doc_id.

    Rows that link with nothing stay, also those without text or doc_id. Of rows that repeat a kept doc_id
    the one with the smallest text stays. All columns are kept.
    """
    got = materialise(jaccard_components(docs, width, threshold), "ngram-groups").where("doc_id IS NOT NULL")
    again = got.groupBy("doc_id").agg(F.count("*").alias("rows"), F.min("component_id").alias("component_id"))
    # ids to look at again: those that go and those that occur twice
    marked = materialise(again.where("rows > 1 OR component_id <> doc_id").select(
        F.col("doc_id").alias("id"), (F.col("component_id") != F.col("doc_id")).alias("goes")), "ngram-marked")
    field = key_filter(marked.select("id"))

    @F.arrow_udf("boolean")
    def may_be_marked(ids: pa.Array) -> pa.Array:
        hit = filter_bits(field)[filter_places(ids.fill_null(0).to_numpy(zero_copy_only=False))]
        return pa.array(hit & ids.is_valid().to_numpy(zero_copy_only=False))

    # only documents that a bit set can't clear meet the list of ids, so few texts are shuffled
    n, i, hit = fresh(docs, "place", "marked_id", "may_be_marked")
    marked = marked.withColumnRenamed("id", i)
    looked = docs.withColumn(hit, may_be_marked(F.col("doc_id").cast("long")))
    clear, rest = looked.where(~F.col(hit)).drop(hit), looked.where(hit).drop(hit)
    plain = rest.join(marked, rest["doc_id"].cast("long") == F.col(i), "left_anti")
    twice = rest.join(marked.where("NOT goes").select(i), rest["doc_id"].cast("long") == F.col(i), "left_semi")
    w = Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last())
    first = twice.withColumn(n, F.row_number().over(w)).where(F.col(n) == 1).drop(n)
    return clear.unionByName(plain).unionByName(first)


#: DuckDB SQL for ``jaccard_components`` with the settings above: all pairs that share a shingle.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
      THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS k
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
e AS (SELECT a AS u, b AS v FROM links UNION ALL SELECT b, a FROM links),
r(u, v) AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u),
least_of AS (SELECT u, min(v) AS v FROM r GROUP BY u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(d.doc_id, m.v), d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least_of m ON m.u = d.doc_id
"""
