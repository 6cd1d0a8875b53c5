"""Repeated passages by content-defined chunking with a gear rolling hash.

Words are first joined by one space, so that chunks compare what windows compare: other line ends, tabs or double
spaces change no chunk. Chunks end where the gear hash of the last ``GEAR`` bytes is the least of ``REACH``
neighbours (the last of equal ones), and hold those ``GEAR`` bytes before their begin too. An insertion moves chunk
borders near it and no others. Chunks are counted by digest over all documents. Where chunks that occur more than
once follow one another without a gap, a passage may repeat; only there are windows of ``WINDOW`` words compared
exactly (by 64-bit hashes of whole words), and a window that two documents hold is part of a repeated passage.

No window is missed. ``WINDOW`` words have 2 * WINDOW - 1 bytes at least, so GEAR - 1 bytes and two neighbourhoods that
don't meet. The least places of all neighbourhoods inside the window follow from its bytes alone, are two
or more, and no other neighbourhood has its least place between them: the chunks from the first to the last of
them are the same in every copy, all occur more than once, and end less than REACH bytes from both ends of the window.

The digest counts are aggregated before their shuffle; digests that occur again go to tasks as a bit set of fixed
size (``FILTER_BITS``). Its false hits only add windows to compare.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import as_bytes, filter_places, key_filter

WINDOW = 50
GEAR = 16  # bytes that the hash sees
REACH = (2 * WINDOW - GEAR) // 2  # places of a neighbourhood: two and GEAR - 1 bytes are in any window
SHORT, MOST = GEAR + 1, GEAR + REACH  # bytes of a chunk
BLOCK = 1 << 18  # places whose neighbourhoods are compared at once
BATCH_BYTES = 4 << 20
FILTER_BITS = 26
TEXTS = 200  # whose windows are held at once

_GEAR = np.random.default_rng(20_240_503).integers(0, 1 << 16, 256, dtype=np.uint16)


def joined_words(text: bytes) -> bytes:
    """A text's words (runs without ASCII white space) with one space between them. Word numbers stay."""
    return b" ".join(text.split())


def chunk_ends(data: np.ndarray, sizes: np.ndarray | None = None) -> np.ndarray:
    """Where chunks end (exclusive) by content alone, in bytes (uint8) of one text or of texts of these sizes, one
    behind another. A text's first end only begins a chunk."""
    sizes = np.array([len(data)]) if sizes is None else sizes
    h, span = _GEAR[data], 1
    while span < GEAR:  # h[i] sums gear values of the last 2 * span bytes, each shifted by its age
        older = np.zeros_like(h)
        older[span:] = h[:-span] << np.uint16(span)
        h = h + older
        span *= 2
    # neighbourhoods begin where the hash sees no byte of the text before, and end with their text
    count = np.maximum(sizes - (GEAR - 1) - (REACH - 1), 0)
    inside = np.zeros(len(data) + 1, np.int32)
    begin = (np.cumsum(sizes) - sizes + GEAR - 1)[count > 0]
    inside[begin] += 1
    inside[begin + count[count > 0]] -= 1
    inside = np.cumsum(inside[:-1]).astype(bool)
    last, out = np.uint64((1 << 48) - 1), [np.zeros(0, np.int64)]
    for at in range(0, len(data) - REACH + 1, BLOCK):
        part = h[at:at + BLOCK + REACH - 1].astype(np.uint64)
        least = (part << np.uint64(48)) | (last - np.arange(at, at + len(part), dtype=np.uint64))  # of equal ones the last
        span = 1
        while span < REACH:
            step = min(span, REACH - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        place = (last - (least[inside[at:at + len(least)]] & last)).astype(np.int64)
        out.append(place[np.append(True, place[1:] != place[:-1])] if len(place) else place)
    place = np.concatenate(out)
    return place[np.append(True, place[1:] != place[:-1])] + 1 if len(place) else place


def chunks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, start, length and digest (int64) of all chunks, in order. A chunk has the bytes from one end to the
    next and GEAR before them."""
    out: list[list[np.ndarray]] = [[], [], [], []]
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto]) < BATCH_BYTES):
            size += len(texts[upto])
            upto += 1
        joined = b"".join(texts[at:upto])
        sizes = np.array([len(t) for t in texts[at:upto]], np.int64)
        starts = np.cumsum(sizes) - sizes
        ends = chunk_ends(np.frombuffer(joined, np.uint8), sizes)
        doc = np.searchsorted(starts, ends - 1, "right") - 1
        same = doc[1:] == doc[:-1]
        begin, stop, doc = ends[:-1][same] - GEAR, ends[1:][same], doc[1:][same]
        digest = xxhash.xxh3_64_intdigest
        out[0].append(doc + at)
        out[1].append(begin - starts[doc])
        out[2].append(stop - begin)
        out[3].append(np.fromiter((digest(joined[s:e]) for s, e in zip(begin.tolist(), stop.tolist())), np.uint64,
                                  len(begin)).view(np.int64))
        at = upto
    return tuple(np.concatenate(a) if a else np.zeros(0, np.int64) for a in out)


def runs(doc: np.ndarray, start: np.ndarray, length: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text number, start and stop of stretches of chunks that are kept, from a text's chunks in order."""
    new = np.append(True, doc[1:] != doc[:-1])[:len(doc)]
    first = np.flatnonzero(keep & (new | ~np.append(True, keep[:-1])[:len(doc)]))
    last = np.flatnonzero(keep & (np.append(new[1:], True)[:len(doc)] | ~np.append(keep[1:], True)[:len(doc)]))
    return doc[first], start[first], (start + length)[last]


def word_windows(text: bytes, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the WINDOW-word windows that lie in a run (bytes), but for less than REACH bytes at either end: distinct hashes,
    the number of each one's first word where it stands first, how many more times it stands, and the first words'
    numbers there, one hash's after another's."""
    none = (np.zeros(0, np.int64),) * 4
    if not len(start):
        return none
    raw = np.frombuffer(text, np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    first, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    n = len(first) - WINDOW + 1
    if n < 1:
        return none
    a = np.searchsorted(first, start - REACH, "right")
    b = np.searchsorted(ends[WINDOW - 1:], stop + REACH)  # windows a <= k < b
    a, b = a[a < b], b[a < b]
    mark = np.zeros(n + 1, np.int64)
    np.add.at(mark, a, 1)
    np.add.at(mark, b, -1)
    want = np.cumsum(mark[:n]) > 0
    at = np.flatnonzero(want)
    if not len(at):
        return none
    lo, hi = int(at[0]), int(at[-1]) + WINDOW
    w = np.fromiter((xxhash.xxh3_64_intdigest(text[s:e]) for s, e in zip(first[lo:hi].tolist(), ends[lo:hi].tolist())),
                    np.uint64, hi - lo)
    h, mul = np.zeros(len(at), np.uint64), np.uint64(0x9E3779B97F4A7C15)
    for j in range(WINDOW):
        h = (h * mul) ^ (w[at - lo + j] + (h >> np.uint64(29)))
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    order = np.argsort(h, kind="stable")
    h, at = h[order], at[order]
    new = np.append(True, h[1:] != h[:-1])
    first = np.flatnonzero(new)
    return h[first].view(np.int64), at[first], np.diff(np.append(first, len(h))) - 1, at[~new]


def repeated_passages(docs: DataFrame) -> DataFrame:
    """One row per passage of a document that another document holds too: doc_id, first_word (its number in the
    text, from 0), n_words, first_doc_id (the smallest doc_id with the passage's first window), repeats
    (doc_id <> first_doc_id: a deduplication would drop it here).

    Passages have at least WINDOW words (runs without ASCII white space), equal but for white space; overlapping and
    adjoining windows make one passage. docs: doc_id, text; other columns are ignored. Texts that are null or shorter
    have none; rows without doc_id are left out; rows that repeat a doc_id are one document to each other, so a
    passage that only they share doesn't count. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes("text").alias("text")).where(
        "doc_id IS NOT NULL")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(chunks([joined_words(t) for t in b.column(0).to_pylist()])[3])], ["digest"])

    counts = docs.select("text").mapInArrow(digests, "digest long").groupBy("digest").agg(F.count("*").alias("n"))
    known = key_filter(counts.where("n > 1").select("digest"), FILTER_BITS)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(known.value, np.uint8)  # packed: one bit a key
        for b in (b.slice(at, TEXTS) for b in batches for at in range(0, b.num_rows, TEXTS)):
            texts = [joined_words(t) for t in b.column(1).to_pylist()]
            doc, start, length, digest = chunks(texts)
            at = filter_places(digest, FILTER_BITS)
            keep = (bits[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)
            doc, start, stop = runs(doc, start, length, keep)
            cut = np.searchsorted(doc, np.arange(len(texts) + 1))
            got = [word_windows(t, start[a:z], stop[a:z]) for t, a, z in zip(texts, cut[:-1], cut[1:])]
            ids = np.repeat(b.column(0).to_numpy(), [len(g[0]) for g in got])
            h, first, times, others = (np.concatenate(c) for c in zip(*got))
            more = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(times)).astype(np.int32)),
                                            pa.array(others.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(h), pa.array(first.astype(np.int32)), more],
                                             ["doc_id", "h", "i", "more"])

    by_hash, by_doc = Window.partitionBy("h"), Window.partitionBy("doc_id").orderBy("i")
    # a window that repeats inside a document is one row, so a window's rows are no more than documents
    shared = (docs.mapInArrow(windows, "doc_id long, h long, i int, more array<int>")
              .withColumn("first", F.min("doc_id").over(by_hash)).withColumn("last", F.max("doc_id").over(by_hash))
              .where("first <> last")
              .select("doc_id", "first", F.explode(F.when(F.size("more") == 0, F.array("i")).otherwise(
                  F.concat(F.array("i"), "more"))).alias("i")))
    new = (F.col("i") - F.coalesce(F.lag("i").over(by_doc), F.lit(-WINDOW - 1)) > WINDOW).cast("int")
    return (shared.withColumn("new", new)
            .withColumn("run", F.sum("new").over(by_doc.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("doc_id", "run").agg(
                F.min("i").cast("long").alias("first_word"),
                (F.max("i") - F.min("i") + WINDOW).cast("long").alias("n_words"),
                F.min_by("first", F.struct("i", "first")).alias("first_doc_id"))
            .select("doc_id", "first_word", "n_words", "first_doc_id",
                    (F.col("doc_id") != F.col("first_doc_id")).alias("repeats")))


#: DuckDB SQL for ``repeated_passages``: all windows of all documents.
ORACLE = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL),
win AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - 48), lambda i: array_to_string(w[i:i+49], ' '))) AS k,
         unnest(range(0, len(w) - 49)) AS i
  FROM w WHERE len(w) >= 50),
shared AS (
  SELECT doc_id, i, first FROM (
    SELECT doc_id, i, min(doc_id) OVER g AS first, max(doc_id) OVER g AS last FROM win WINDOW g AS (PARTITION BY k))
  WHERE first <> last),
runs AS (
  SELECT *, sum(CASE WHEN i - before > 50 OR before IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run
  FROM (SELECT *, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM shared))
SELECT doc_id, min(i) AS first_word, max(i) - min(i) + 50 AS n_words, arg_min(first, i) AS first_doc_id,
       doc_id <> arg_min(first, i) AS repeats
FROM runs GROUP BY doc_id, run
"""
