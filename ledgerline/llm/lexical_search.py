"""Ranked lexical search by the Best Position Algorithm over impact lists.

One pass over the documents keeps, per document, its length and how often it holds the terms that some item asks for.
Corpus figures follow from it by aggregation. Documents are then searched where they lie, a shard of a task's rows at
a time: the shard's postings form one list per term, by descending impact (what the term adds to a score).

An item reads its terms' lists in parallel. Every document met is looked up directly in all of them (its row of
postings), which gives its score and its place in each list. A list's best position is the end of its run of places seen
from the top, by either way of reading, so it lies at or behind the last place read. No unseen document can score more
than the sum of the impacts at the best positions; reading stops once that is strictly below the item's k-th score so
far, also that of the task's earlier shards. Ties with the k-th score are read, so equal scores go by doc_id.
A task's best k documents an item meet the other tasks' in one ranking.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import materialise, prepare

TOP = 50
BLOCK_CHARS = 4 << 20  # characters of items searched for in one pass
SHARD = 1 << 20  # postings of a shard, but for a batch that has more
CUT = 4 << 20  # bytes of a text whose terms are found at once
FIRST_STEP = 64  # places read of each list at first; then twice as many each time

#: Maximal runs of these bytes are terms: ASCII letters and digits, and all of other characters.
TERMS = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
OTHER = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, A-Z lower-cased, in parts of some CUT bytes."""
    data, at = (text or "").encode().lower(), 0
    while len(data) - at > 2 * CUT:
        gap = OTHER.search(data, at + CUT)
        if not gap:
            break
        yield TERMS.findall(data, at, gap.start())
        at = gap.start()
    yield TERMS.findall(data, at)


class Shard:
    """Impact lists of some documents. Postings lie by document (rows) and, in ``lists``, by term and impact."""

    def __init__(self, row_ends: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int) -> None:
        self.begin, self.end = row_ends[:-1], row_ends[1:]
        self.term, self.impact = term, impact
        order = np.lexsort((-impact, term))
        self.list_impact = impact[order]
        self.list_doc = (np.searchsorted(row_ends, order, "right") - 1).astype(np.int32)
        self.place = np.empty(len(order), np.int32)  # of a posting, among all lists
        self.place[order] = np.arange(len(order), dtype=np.int32)
        self.list_at = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.seen = np.zeros(len(order), np.int32)  # by place: the last search that saw it
        self.met = np.zeros(len(self.begin), np.int32)  # by document
        self.asked = np.zeros(n_terms, bool)
        self.search_no = 0

    def search(self, terms: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores; among them all that belong to the k best and whose score is ``floor`` or more."""
        start, end = self.list_at[terms], self.list_at[terms + 1]
        full = end > start
        start, end = start[full], end[full]
        self.search_no += 1
        no, best, depth, step = self.search_no, start.copy(), 0, FIRST_STEP
        docs, scores, kth = np.zeros(0, np.int64), np.zeros(0, np.int64), floor
        self.asked[terms] = True
        while len(start):
            low, high = np.minimum(start + depth, end), np.minimum(start + depth + step, end)
            read = _ranges(low, high)
            new = np.unique(self.list_doc[read])  # sorted access
            new = new[self.met[new] != no]
            if len(new):
                self.met[new] = no
                size = self.end[new] - self.begin[new]  # direct access
                row = _ranges(self.begin[new], self.end[new])
                mine = self.asked[self.term[row]]
                self.seen[self.place[row[mine]]] = no
                sums = np.concatenate([[0], np.cumsum(np.where(mine, self.impact[row], 0))])
                ends = np.cumsum(size)
                docs, scores = np.concatenate([docs, new]), np.concatenate([scores, sums[ends] - sums[ends - size]])
                if len(scores) >= k:
                    kth = max(floor, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
                    near = scores >= kth
                    docs, scores = docs[near], scores[near]
            open_lists = np.flatnonzero(best < end)
            for j in open_lists.tolist():
                best[j] = self._best(int(best[j]), int(end[j]), no)
            left = best < end
            threshold = int(self.list_impact[best[left] - 1].sum())
            if not left.any() or threshold < kth:
                break
            depth += step
            step *= 2
        self.asked[terms] = False
        return docs, scores

    def _best(self, at: int, end: int, no: int) -> int:
        """The first unseen place of a list."""
        width = 64
        while at < end:
            unseen = self.seen[at:min(at + width, end)] != no
            first = int(unseen.argmax())
            if unseen[first]:
                return at + first
            at += len(unseen)
            width *= 4
        return end


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """low[0]..high[0], low[1]..high[1] and so on."""
    size = high - low
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(low - (ends - size), size)


def _blocks(items: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items and their terms, some BLOCK_CHARS characters of them at a time; the driver holds one block."""
    block, size = [], 0
    for r in items.orderBy("item_id").toLocalIterator():
        if block and size + len(r["text"] or "") > BLOCK_CHARS and r["item_id"] != block[-1][0]:
            yield block
            block, size = [], 0
        found = {t for part in terms_of(r["text"]) for t in part}
        if block and block[-1][0] == r["item_id"]:
            block[-1][1].update(found)
        else:
            block.append((r["item_id"], found))
        size += len(r["text"] or "")
    if block:
        yield block


HITS = "doc_id long, n long, terms array<int>, tfs array<int>"
FOUND = T.StructType([T.StructField(n, T.LongType()) for n in ("item_id", "doc_id", "score")])


def _hits(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document with a term: its length in terms, and the vocabulary's terms in it with their counts."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value.get
        for b in batches:
            ids, ns, terms, tfs = [], [], [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n, hits = 0, []
                for part in terms_of(text):
                    n += len(part)
                    hits += [x for x in map(known, part) if x is not None]
                if n:
                    t, f = np.unique(np.array(hits, np.int32), return_counts=True)
                    ids.append(i)
                    ns.append(n)
                    terms.append(t)
                    tfs.append(f.astype(np.int32))
            if ids:
                ends = pa.array(np.cumsum([0, *map(len, terms)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate(terms))),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate(tfs)))], ["doc_id", "n", "terms", "tfs"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialise(d.mapInArrow(rows, HITS), "search-hits")


def _length_part(n: np.ndarray, total: int, mass: int) -> np.ndarray:
    """(50 * n * N) div L, exactly."""
    if int(n.max(initial=0)) * 50 * total < 1 << 63:
        return n * (50 * total) // mass
    return np.array([50 * x * total // mass for x in n.tolist()], np.int64)


def _search(hits: DataFrame, items: list[tuple[int | None, list[int]]], weight: list[int], total: int, mass: int,
            k: int) -> DataFrame:
    """Each task's k best documents an item: item_id, doc_id, score."""
    held = hits.sparkSession.sparkContext.broadcast(
        (np.array(weight, np.int64), [(i, np.array(t, np.int64)) for i, t in items]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, asked = held.value
        best = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in asked]

        def run(parts: list[pa.RecordBatch]) -> None:
            b = pa.Table.from_batches(parts).combine_chunks()
            ids, n = b.column("doc_id"), b.column("n").to_numpy()
            lists = b.column("terms").combine_chunks()
            size = np.diff(lists.offsets.to_numpy().astype(np.int64))
            term = lists.flatten().to_numpy().astype(np.int32)
            tf = b.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
            m = 50 + _length_part(n, total, mass)
            impact = w[term] * (1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(m, size)))
            adds = impact > 0
            rows = np.repeat(np.arange(len(size)), size)[adds]
            ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(size)))])
            shard = Shard(ends, term[adds], impact[adds], len(w))
            null = ids.is_null().to_numpy()
            number = ids.fill_null(0).to_numpy()
            for j, (_, terms) in enumerate(asked):
                i, lacks, s = best[j]
                docs, scores = shard.search(terms, k, int(s[-1]) if len(s) == k else 0)
                if len(docs):
                    i, lacks, s = (np.concatenate(x) for x in ((i, number[docs]), (lacks, null[docs]), (s, scores)))
                    first = np.lexsort((i, lacks, -s))[:k]
                    best[j] = i[first], lacks[first], s[first]

        parts, size = [], 0
        for b in batches:
            parts.append(b)
            size += len(b.column("terms").flatten())
            if size >= SHARD:
                run(parts)
                parts, size = [], 0
        if parts:
            run(parts)
        for (item, _), (i, lacks, s) in zip(asked, best):
            if len(s):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(s), pa.int64()), pa.array(i, pa.int64(), mask=lacks), pa.array(s)],
                    ["item_id", "doc_id", "score"])

    return hits.filter(F.size("terms") > 0).mapInArrow(rows, FOUND)


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k highest-scoring documents with a score above 0, equal scores by
    ascending doc_id (null last).

    docs (doc_id, text), items (item_id, text); other columns are ignored, ids are whole numbers or null. Whole texts of
    any length; a null text has no terms. N documents hold a term, L terms in all; a document with n terms has
    m = 50 + (50 * n * N) div L, a term that df documents hold weighs w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))), and
    the score sums w * ((1000000000 * tf) div (1000 * tf + 20 * m)) over the item's distinct terms. Repeated documents
    rank each by itself; rows that share an item_id (nulls, too) are one item with all their terms. Without items, or
    without a document that holds one of their terms, there are no rows. Items are searched in blocks of bounded size.
    """
    spark = docs.sparkSession
    prepare(spark)
    wanted = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    out = None
    for block in _blocks(wanted):
        vocabulary = {t: j for j, t in enumerate(sorted(set().union(*(found for _, found in block))))}
        hits = _hits(docs, vocabulary)
        found = _block(spark, hits, [(i, sorted(vocabulary[t] for t in found)) for i, found in block], len(vocabulary), k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out


def _block(spark: SparkSession, hits: DataFrame, items: list[tuple[int | None, list[int]]], n_terms: int, k: int) -> DataFrame:
    total, mass = hits.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = dict(map(tuple, hits.select(F.explode("terms").alias("t")).groupBy("t").count().collect()))  # a row a term of the block
    weight = [math.floor(1000 * math.log((2 * total + 2) / (2 * df[j] + 1))) if j in df else 0 for j in range(n_terms)]
    items = [(i, [j for j in terms if weight[j] > 0]) for i, terms in items]
    found = _search(hits, items, weight, total, mass or 1, k)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


#: DuckDB, for the default parameters.
ORACLE = r"""
WITH lists AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents WHERE text IS NOT NULL),
docs AS (SELECT doc_id, t, len(t)::BIGINT AS n FROM lists WHERE len(t) > 0),
total AS (SELECT count(*)::BIGINT AS cn, sum(n)::BIGINT AS cl FROM docs),
tfs AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM docs) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * cn + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, total GROUP BY term, cn),
items AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scores AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * cn) // cl))))::BIGINT AS score
  FROM items JOIN tfs USING (term) JOIN weights USING (term), total GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
