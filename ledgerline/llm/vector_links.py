"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations, multiprobe, verified pairs.

Vectors of one label and length are compared by cosine. Each of ``tables`` hash tables turns a vector by ``hashes``
random rotations (three rounds of random signs and a fast Walsh-Hadamard transform) and takes the nearest signed
axis of each; a vector is put into the bucket of these axes and into its next best ones, ``probes``
in all, by how little each gives up. Two vectors meet if any of their buckets is the same: at 64
dimensions and a cosine of 0.93 with probability 0.85 in one table, so 6 tables miss about 1 pair in 100,000 (the
miss rate falls as the cosine rises).

Equal vectors are one class with a count. A bucket's members are verified by cosine in double precision where they are; a pair
counts in its first common bucket only, so links are counted without a list of all pairs, and each bucket gives
the tree of its links instead. Buckets over ``BLOCK`` members are cut into parts, and each two parts meet in a
task of their own, so no task gets more than 2 * BLOCK members of a bucket at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise
from ledgerline.llm.graph import components

BLOCK = 1024
PAIRS = 50_000  # verified at once


@dataclass(frozen=True)
class Hashing:
    tables: int = 6
    hashes: int = 2
    probes: int = 4
    seed: int = 20_240_501


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the length is a power of two."""
    n, d, h = len(x), x.shape[1], 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def bucket_codes(x: np.ndarray, how: Hashing) -> np.ndarray:
    """(rows, tables, probes) codes, the vector's own bucket first; codes of different tables differ."""
    n, d = x.shape
    wide = 1 << max(1, (d - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, wide - d)))
    rng = np.random.default_rng([how.seed, wide])
    axes, out = 2 * wide, []
    p = min(how.probes, wide)
    for table in range(how.tables):
        code, cost = np.full((n, 1), table, np.int64), np.zeros((n, 1))
        for _ in range(how.hashes):
            y = x
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], wide))
            best = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :p]
            value = np.take_along_axis(y, best, 1)
            axis, loss = best * 2 + (value < 0), np.abs(value[:, :1]) - np.abs(value)
            # the cheapest combinations of the tables so far with this rotation's axes
            code = (code[:, :, None] * axes + axis[:, None, :]).reshape(n, -1)
            cost = (cost[:, :, None] + loss[:, None, :]).reshape(n, -1)
            keep = np.argsort(cost, axis=1, kind="stable")[:, :how.probes]
            code, cost = np.take_along_axis(code, keep, 1), np.take_along_axis(cost, keep, 1)
        out.append(code)
    return np.stack(out, axis=1)


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _hashed(classes: DataFrame, how: Hashing) -> DataFrame:
    """id, lab, n, x, codes per class of equal vectors."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = b.column(3)
            lengths = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
            codes: list = [None] * b.num_rows
            for d in np.unique(lengths):
                at = np.flatnonzero(lengths == d)
                got = bucket_codes(_units(flat[starts[at][:, None] + np.arange(d)]), how)
                for k, c in zip(at, got.reshape(len(at), -1)):
                    codes[k] = c
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(codes, pa.list_(pa.int64()))],
                                             [*b.schema.names, "codes"])

    kind = classes.schema["x"].dataType.simpleString()
    return classes.select("id", "lab", "n", "x").mapInArrow(rows, f"id long, lab long, n long, x {kind}, codes array<long>")


def _links_in(ids: np.ndarray, n: np.ndarray, x: np.ndarray, codes: np.ndarray, code: np.ndarray, part: np.ndarray,
              apart: np.ndarray, starts: np.ndarray, sizes: np.ndarray, threshold: float
              ) -> tuple[np.ndarray, np.ndarray]:
    """Of rows in groups (starts, sizes): what each row links with, and each row's smallest linked row."""
    links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    counts = sizes * (sizes - 1) // 2
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    found = []
    for at in range(0, total, PAIRS):
        k = np.arange(at, min(at + PAIRS, total))
        g = np.searchsorted(ends, k, "right")
        r = k - (ends[g] - counts[g])
        # pair r of a group: (i, j) with i < j, r = j * (j - 1) / 2 + i
        j = ((1 + np.sqrt(1 + 8 * r.astype(np.float64))) / 2).astype(np.int64)
        j -= j * (j - 1) // 2 > r
        j += (j + 1) * j // 2 <= r
        i = r - j * (j - 1) // 2 + starts[g]
        j = j + starts[g]
        ok = ~apart[i] | (part[i] != part[j])
        i, j = i[ok], j[ok]
        ok = np.einsum("ij,ij->i", x[i], x[j]) >= threshold
        i, j = i[ok], j[ok]
        if len(i):
            # the first common bucket, by code, is this one
            same = codes[i][:, :, None] == codes[j][:, None, :]
            lowest = np.where(same.any(2), codes[i], np.iinfo(np.int64).max).min(1)
            ok = lowest == code[i]
            i, j = i[ok], j[ok]
            np.add.at(links, i, n[j])
            np.add.at(links, j, n[i])
            found.append((i, j))
    if found:
        i, j = (np.concatenate(a) for a in zip(*found))
        while True:
            low = np.minimum(root[i], root[j])
            before = root.copy()
            np.minimum.at(root, i, low)
            np.minimum.at(root, j, low)
            root = root[root]
            if (root == before).all():
                break
    return links, root


def _verified(rows: DataFrame, threshold: float) -> DataFrame:
    """From rows in groups (lab, size of x, code, p, q): (id, links, root), per group and class with links."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in batches:
            t = pa.Table.from_batches([b])
            rest = t if rest is None else pa.concat_tables([rest, t])
            key = np.column_stack([rest.column(c).to_numpy() for c in ("lab", "d", "code", "p", "q")])
            new = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            if len(new):  # the last group may go on
                cut = int(new[-1])
                yield from work(rest.slice(0, cut), key[:cut])
                rest = rest.slice(cut)
        if rest is not None and rest.num_rows:
            yield from work(rest, np.column_stack([rest.column(c).to_numpy() for c in ("lab", "d", "code", "p", "q")]))

    def work(t: pa.Table, key: np.ndarray) -> Iterator[pa.RecordBatch]:
        t = t.combine_chunks()
        # one length of vectors at a time
        for d in np.unique(key[:, 1]):
            at = np.flatnonzero(key[:, 1] == d)
            part, k = t.take(pa.array(at)).combine_chunks(), key[at]
            starts = np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1])
            sizes = np.diff(np.append(starts, len(k)))
            if sizes.max() < 2:
                continue
            ids = part.column("id").to_numpy()
            x = np.concatenate([c.flatten().to_numpy() for c in part.column("x").chunks]).reshape(-1, int(d))
            codes = np.concatenate([c.flatten().to_numpy() for c in part.column("codes").chunks]).reshape(len(ids), -1)
            links, root = _links_in(ids, part.column("n").to_numpy(), _units(x.astype(np.float64)), codes, k[:, 2],
                                    part.column("part").to_numpy(), k[:, 3] != k[:, 4], starts, sizes, threshold)
            has = np.flatnonzero(links)
            if len(has):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[has]), pa.array(links[has]), pa.array(ids[root[has]])], ["id", "links", "root"])

    return rows.mapInArrow(pairs, "id long, links long, root long")


def vector_links(vectors: DataFrame, threshold: float = 0.93, how: Hashing = Hashing()) -> DataFrame:
    """vec_id, n_links, component_id, kept per row of vectors (vec_id, embedding, label; other columns are ignored).

    n_links: other vectors linked directly (cosine >= threshold, equal labels and lengths). component_id: the smallest
    vec_id reachable, itself included. kept: vec_id = component_id. Vectors that are null, empty, all zero or hold
    null or non-finite components, and rows with a null label, link with nothing. Equal rows of one vec_id count as
    one vector; if rows of one vec_id differ, each is compared and their links add up. A null
    vec_id has n_links 0, a null component_id and kept false. An empty table gives no rows.
    """
    label = F.col("label")
    if vectors.schema["label"].dataType.typeName() not in ("byte", "short", "integer", "long"):
        label = F.when(label.isNotNull(), F.xxhash64("label"))
    v = vectors.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("lab"),
                       F.col("embedding").alias("x"))
    good = v.where("""id IS NOT NULL AND lab IS NOT NULL AND size(x) > 0 AND exists(x, y -> y <> 0)
                      AND forall(x, y -> y IS NOT NULL AND NOT isnan(y) AND abs(y) < double('Infinity'))""").distinct()
    members = good.select("id", "lab", "x", F.xxhash64("x").alias("xh"))
    classes = materialise(members.groupBy("lab", "xh", "x").agg(F.min("id").alias("id"), F.count("*").alias("n")),
                          "vector-classes")
    of = materialise(members.join(classes.select("lab", "xh", "x", F.col("id").alias("first"), "n"), ["lab", "xh", "x"])
                     .select("id", "first", "n"), "vector-members")
    hashed = materialise(_hashed(classes, how).withColumn("d", F.size("x").cast("long")), "vector-hashes")

    keys = hashed.select("id", "lab", "d", F.explode("codes").alias("code"))
    met = keys.groupBy("lab", "d", "code").agg(F.count("*").alias("m")).where("m > 1")
    parts = (keys.join(met, ["lab", "d", "code"])
             .withColumn("k", F.ceil(F.col("m") / BLOCK).cast("long"))
             .withColumn("part", F.expr("pmod(xxhash64(id), k)"))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
             .select("id", "code", "part", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q")))
    rows = (parts.join(hashed, "id").select("id", "lab", "d", "code", "part", "p", "q", "n", "x", "codes")
            .repartition("lab", "d", "code", "p", "q").sortWithinPartitions("lab", "d", "code", "p", "q", "id"))
    found = materialise(_verified(rows, threshold), "vector-links")

    links = found.groupBy("id").agg(F.sum("links").alias("links")).withColumnRenamed("id", "first")
    edges = found.select(F.col("id").alias("u"), F.col("root").alias("v")).union(
        of.where("id <> first").select("id", "first"))
    comps = components(edges).withColumnRenamed("node", "id")
    counts = of.join(links, "first", "left").groupBy("id").agg(
        F.sum(F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    i = F.col("id")
    return (v.select("id").join(counts, "id", "left").join(comps, "id", "left")
            .select(i.alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "id").alias("component_id"),
                    F.coalesce(F.coalesce("component", "id") == i, F.lit(False)).alias("kept")))


#: DuckDB SQL for ``vector_links`` with the settings above: all pairs of a label.
ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda y: y <> 0)) > 0
    AND len(list_filter(embedding, lambda y: isfinite(y))) = len(embedding)),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.x) = len(b.x) WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
r(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM r JOIN links l ON r.b = l.a),
least_of AS (SELECT a, min(b) AS b FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(m.b, vec_id)) AS component_id,
       vec_id <= coalesce(m.b, vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN least_of m ON m.a = vec_id
"""
