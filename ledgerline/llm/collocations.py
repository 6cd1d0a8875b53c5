"""Phrase collocation mining in two passes: mergeable Misra-Gries summaries, then exact counts.

The hash space of n-grams (one word and more, a language's apart from another's) is cut into buckets, ranges of the
hash. In the first pass each task counts its n-grams' hashes and sends each bucket what fell into it; a bucket's parts
are merged into one Misra-Gries summary. Its capacity exceeds the bucket's mass (occurrences) divided by the threshold,
so all that merging takes off a counter stays under the threshold: every n-gram that is frequent enough survives,
and those whose counter and error together stay below the threshold can't be. The masses of a bucket come before its
counters, so the capacity is known when merging begins; memory is bounded by the capacity, and the number of
buckets grows with the text.

The second pass counts the words themselves, of n-grams whose hash survived (a bit set sized by the survivors, at
most 2**MOST_BITS bits; false hits cost work only, as the exact count is compared with the threshold). Hashes group
a task's words and n-grams, their bytes are compared before they count as equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise, prepare

LEAST = 10
LONGEST = 3
TOP = 2000
SHARE = 50  # percent
SHARES = 16  # parts of a language that are ranked by themselves first
BUCKET_BYTES = 16 << 20  # bytes of text a bucket of the hash space
WORDS = 1 << 19  # words counted at once in a task
BLOCK = 1 << 20  # bytes whose words are found at once
MOST_BITS = 28
NO_LANG = "und"

#: What a byte is: 0 part of a word, 1 blank, 2 end of a piece.
KIND = np.zeros(256, np.uint8)
KIND[list(b" \t")] = 1
KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _factors(salt: int) -> np.ndarray:
    return np.random.default_rng([salt, 11]).integers(0, 1 << 64, 1024, np.uint64) | np.uint64(1)


class Words:
    """The words of some texts, in order: hash, place and length in ``data`` (lower-cased bytes), piece, text."""

    def __init__(self, texts: list[str | None]) -> None:
        raw = [(t or "").encode().lower() for t in texts]  # bytes: A-Z only
        self.data = b"\n".join(raw)
        self.bytes = np.frombuffer(self.data, np.uint8)
        kind, parts, at, pieces = KIND[self.bytes], [], 0, 0
        while at < len(kind):
            to = self._cut(kind, at + BLOCK)
            word = np.zeros(to - at + 2, np.int8)
            word[1:-1] = kind[at:to] == 0
            edge = np.diff(word)
            start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            ends = np.cumsum(kind[at:to] == 2)
            parts.append((start + at, end - start, ends[start] + pieces))
            pieces += int(ends[-1])
            at = to
        small = np.int32 if len(self.data) < 1 << 31 else np.int64
        self.start, self.length, self.piece = (
            np.concatenate([p[k].astype(small) for p in parts]) if parts else np.zeros(0, small) for k in range(3))
        begins = np.cumsum([0, *(len(r) + 1 for r in raw)][:-1]) if raw else np.zeros(0, np.int64)
        self.text = (np.searchsorted(begins, self.start, "right") - 1).astype(np.int32)
        self.hash = self.hashed(0)

    @staticmethod
    def _cut(kind: np.ndarray, at: int) -> int:
        """The first byte from here on that is no part of a word."""
        while at < len(kind):
            found = np.flatnonzero(kind[at:at + BLOCK])
            if len(found):
                return at + int(found[0])
            at += BLOCK
        return len(kind)

    def hashed(self, salt: int) -> np.ndarray:
        factor, out, a, n = _factors(salt), np.zeros(len(self.start), np.uint64), 0, len(self.start)
        ends = np.cumsum(self.length, dtype=np.int64)
        while a < n:
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BLOCK, "right")))
            size = self.length[a:b]
            first = np.cumsum(size) - size
            off = np.arange(int(size.sum())) - np.repeat(first, size)
            value = self.bytes[off + np.repeat(self.start[a:b], size)].astype(np.uint64) + np.uint64(1)
            out[a:b] = np.add.reduceat(value * factor[off & 1023], first) + size.astype(np.uint64)
            a = b
        return _mix(out)

    def keys(self, seeds: np.ndarray, longest: int, at: int, to: int) -> list[np.ndarray]:
        """Per number of words, the hash of the n-gram that begins at each of the words at..to (seeds: a text's), and
        which of these words begin one."""
        out, n = [], len(self.hash)
        key = _mix(self.hash[at:to] + seeds[self.text[at:to]])
        out.append((key, np.ones(to - at, bool)))
        for k in range(1, longest):
            last = np.minimum(np.arange(at + k, to + k), n - 1)
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + self.hash[last])
            fits = (np.arange(at, to) + k < n) & (self.piece[last] == self.piece[at:to])
            out.append((key, fits))
        return out

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """A number per word, equal just for equal words, and where the first of each number stands."""
        salt, h = 0, self.hash
        while True:
            _, first, number = np.unique(h, return_index=True, return_inverse=True)
            if self._equal(np.arange(len(h)), first[number]):
                return number, first
            salt += 1  # two words share a hash: another one
            h = self.hashed(salt)

    def _equal(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Are the words at places a those at places b?"""
        other = a != b
        a, b = a[other], b[other]
        if not np.array_equal(self.length[a], self.length[b]):
            return False
        long = self.length[a] > 64
        if any(self.word(x) != self.word(y) for x, y in zip(a[long].tolist(), b[long].tolist())):
            return False
        a, b = a[~long], b[~long]
        x, y, size = self.start[a], self.start[b], self.length[a]
        for k in range(int(size.max(initial=0))):
            if k and (k & 3) == 0:
                more = size > k
                x, y, size = x[more], y[more], size[more]
            inside = np.minimum(k, size - 1)
            if not np.array_equal(self.bytes[x + inside], self.bytes[y + inside]):
                return False
        return True

    def word(self, k: int) -> bytes:
        at = int(self.start[k])
        return self.data[at:at + int(self.length[k])]


def _seeds(langs: list[str | None]) -> np.ndarray:
    """A number per text, by its language."""
    of = {v: int.from_bytes(hashlib.blake2b((v or NO_LANG).encode(), digest_size=8).digest(), "little") for v in set(langs)}
    return np.array([of[v] for v in langs], np.uint64)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Texts and languages, as many as hold some WORDS words or one text that holds more."""
    texts, langs, held = [], [], 0
    for b in batches:
        for t, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            texts.append(t)
            langs.append(v)
            held += len(t or "") + 1
            if held >= 6 * WORDS:
                yield texts, langs
                texts, langs, held = [], [], 0
    if texts:
        yield texts, langs


class Summary:
    """A Misra-Gries summary of hashes that takes counted parts, and other summaries' counters, in any order.

    ``error``: what was taken off every counter at most, under mass / capacity. Parts wait until they are as many as
    the counters, so each is sorted a bounded number of times."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._wait: list[tuple[np.ndarray, np.ndarray]] = []
        self._held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._wait.append((keys, counts))
        self._held += len(keys)
        if self._held >= max(self.capacity, 1 << 16):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self._wait)])
        counts = np.concatenate([self.counts, *(c for _, c in self._wait)])
        self._wait, self._held = [], 0
        if not len(keys):
            return
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, counts = keys[first], np.add.reduceat(counts[order], first)
        over = len(keys) - self.capacity
        if over > 0:
            off = int(np.partition(counts, over - 1)[over - 1])  # the largest counter that has no place
            self.error += off
            counts = counts - off
            left = counts > 0
            keys, counts = keys[left], counts[left]
        self.keys, self.counts = keys, counts

    def survivors(self, least: int) -> np.ndarray:
        self.merge()
        return self.keys[self.counts + self.error >= least]


PART = "bucket int, body boolean, mass long, ones binary, keys binary, counts binary"


def _parts(docs: DataFrame, buckets: int, longest: int) -> DataFrame:
    """First pass, in tasks: the counted hashes of each bucket, hashes that occur once apart from the others."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)
        for texts, langs in _texts(batches):
            words, seeds = Words(texts), _seeds(langs)
            for at in range(0, len(words.hash), WORDS):
                got = words.keys(seeds, longest, at, min(at + WORDS, len(words.hash)))
                keys, counts = np.unique(np.concatenate([k[fits] for k, fits in got]), return_counts=True)
                cut = [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]
                table = {n: [] for n in ("bucket", "body", "mass", "ones", "keys", "counts")}
                for b in range(buckets):
                    k, c = keys[cut[b]:cut[b + 1]], counts[cut[b]:cut[b + 1]]
                    if not len(k):
                        continue
                    more = c > 1
                    for body in (False, True):
                        cells = (k[~more], k[more], c[more].astype(np.uint32)) if body else (None, None, None)
                        blobs = [None if x is None else x.tobytes() for x in cells]
                        for n, x in zip(table, (b, body, None if body else int(c.sum()), *blobs)):
                            table[n].append(x)
                    if sum(map(len, filter(None, table["ones"]))) > 4 << 20:
                        yield _batch(table)
                        table = {n: [] for n in table}
                yield _batch(table)

    return docs.mapInArrow(rows, PART)


def _batch(table: dict[str, list]) -> pa.RecordBatch:
    kinds = {"bucket": pa.int32(), "body": pa.bool_(), "mass": pa.int64(), "ones": pa.binary(), "keys": pa.binary(),
             "counts": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(table[n], kinds[n]) for n in kinds], list(kinds))


def _survivors(parts: DataFrame, buckets: int, least: int) -> DataFrame:
    """A bucket's rows meet in one task, masses first. A row a bucket: n, keys (uint64, ascending)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, mass, summary = None, 0, None

        def done() -> pa.RecordBatch:
            found = summary.survivors(least)
            return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([len(found)], pa.int64()),
                                               pa.array([found.tobytes()], pa.binary())], ["bucket", "n", "keys"])

        for b in batches:
            for at, body, m, ones, keys, counts in zip(*(c.to_pylist() for c in b.columns)):
                if at != bucket:
                    if summary:
                        yield done()
                    bucket, mass, summary = at, 0, None
                if not body:
                    mass += m
                    continue
                if summary is None:
                    summary = Summary(mass // least + 1)
                once, many = np.frombuffer(ones, np.uint64), np.frombuffer(keys, np.uint64)
                summary.add(once, np.ones(len(once), np.int64))
                summary.add(many, np.frombuffer(counts, np.uint32).astype(np.int64))
        if summary:
            yield done()

    dealt = parts.repartitionById(buckets, "bucket").sortWithinPartitions("bucket", "body")  # a bucket a task
    return materialise(dealt.mapInArrow(rows, "bucket int, n long, keys binary"), "phrase-survivors")


def _bit_set(survivors: DataFrame, total: int):
    """A broadcast bit set with some 16 bits a survivor, up to 2**MOST_BITS bits in all, and the number of its bits."""
    bits = min(MOST_BITS, max(10, int(np.ceil(np.log2(16 * total + 1)))))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for keys in b.column(0).to_pylist():
                place = np.frombuffer(keys, np.uint64) >> np.uint64(64 - bits)
                if len(place):
                    first = int(place[0]) >> 3
                    held = np.zeros(8 * ((int(place[-1]) >> 3) + 1 - first), bool)
                    held[place.astype(np.int64) - 8 * first] = True
                    yield pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([np.packbits(held).tobytes()], pa.binary())],
                                                     ["first", "bits"])

    whole = np.zeros((1 << bits) >> 3, np.uint8)
    for r in survivors.select("keys").mapInArrow(rows, "first long, bits binary").toLocalIterator():
        part = np.frombuffer(r["bits"], np.uint8)
        whole[r["first"]:r["first"] + len(part)] |= part
    return survivors.sparkSession.sparkContext.broadcast(whole.tobytes()), bits


def counted(texts: list[str | None], langs: list[str | None], bit: np.ndarray, bits: int, longest: int) -> Iterator[pa.RecordBatch]:
    """Exact counts of some texts' n-grams whose hash is in the bit set."""
    words, seeds = Words(texts), _seeds(langs)
    number, first = words.distinct()
    name = [v or NO_LANG for v in langs]
    of = {v: k for k, v in enumerate(dict.fromkeys(name))}
    names, lang = list(of), np.array([of[v] for v in name], np.int32)[words.text]
    known: dict[int, bytes] = {}

    def spelled(k: int) -> bytes:
        got = known.get(k)
        if got is None:
            got = known[k] = words.word(int(first[k]))
        return got

    for at in range(0, len(words.hash), WORDS):
        for n, (key, fits) in enumerate(words.keys(seeds, longest, at, min(at + WORDS, len(words.hash))), 1):
            place = key >> np.uint64(64 - bits)
            hit = bit[(place >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (place & np.uint64(7)).astype(np.uint8))
            chosen = np.flatnonzero(fits & (hit & 1).astype(bool))
            if not len(chosen):
                continue
            order = np.argsort(key[chosen], kind="stable")
            where, same = chosen[order] + at, key[chosen[order]]
            ids = np.stack([lang[where], *(number[where + k] for k in range(n))])
            differ = np.concatenate([[True], (ids[:, 1:] != ids[:, :-1]).any(axis=0)])
            if (differ[1:] & (same[1:] == same[:-1])).any():  # two n-grams share a hash
                ids = ids[:, np.lexsort(ids)]
                differ = np.concatenate([[True], (ids[:, 1:] != ids[:, :-1]).any(axis=0)])
            begin = np.flatnonzero(differ)
            count = np.diff(np.append(begin, len(where)))
            for k in range(0, len(begin), 50_000):
                cols = ids[:, begin[k:k + 50_000]]
                spelt = zip(*(map(spelled, c.tolist()) for c in cols[1:]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[x] for x in cols[0].tolist()], pa.string()),
                     pa.array(list(map(b" ".join, spelt)), pa.binary()).cast(pa.string()),
                     pa.array(np.full(cols.shape[1], n, np.int32)), pa.array(count[k:k + 50_000], pa.int64())], COUNTED)
    totals = np.bincount(lang, minlength=len(of))
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([""] * len(of)),
                                      pa.array(np.zeros(len(of), np.int32)), pa.array(totals, pa.int64())], COUNTED)


COUNTED = ["lang", "phrase", "words", "f"]


def _exact(docs: DataFrame, held, bits: int, longest: int) -> DataFrame:
    """Second pass, in tasks: lang, phrase, words and how often, of n-grams whose hash survived. The row of no words
    has the number of all words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bit = np.frombuffer(held.value, np.uint8)
        for texts, langs in _texts(batches):
            yield from counted(texts, langs, bit, bits, longest)

    return docs.mapInArrow(rows, "lang string, phrase string, words int, f long")


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """lang, phrase, words, f: every n-gram of 1 to ``longest`` words that occurs ``least`` times or more in a language, with
    its exact count; and per language a row of the empty phrase with the number of all words.

    docs (text, lang; other columns are ignored): a null text is empty, a null lang is ``und``. Whole texts, of any
    length; repeated rows count as often as they stand there. An empty table gives no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    d = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = -(-size // BUCKET_BYTES) or 1
    survivors = _survivors(_parts(d, buckets, longest), buckets, least)
    total = survivors.agg(F.sum("n")).first()[0] or 0
    held, bits = _bit_set(survivors, total)
    counts = _exact(d, held, bits, longest).groupBy("lang", "phrase").agg(F.max("words").alias("words"), F.sum("f").alias("f"))
    return materialise(counts.filter((F.col("words") == 0) | (F.col("f") >= least)), "phrase-counts")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, share: int = SHARE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases of 2 to ``longest`` words that occur
    ``least`` times or more.

    a is a phrase's count, n all words of its language. Cut after its first k words it has l = count of the first
    part, r = count of the rest and score floor(1000000 * a * a / (l * r)); its lowest-scoring cut counts, of equal
    ones the first. Phrases that lie in a longer one of at least ``share`` percent of their count are left out. Order:
    score, then a, both descending, then the phrase by its UTF-8 bytes. Products are decimals of up to 38 digits.

    docs: as in ``phrase_counts``. An empty table, or one without frequent phrases, gives no rows.
    """
    counts = phrase_counts(docs, least, longest)
    wholes = counts.filter("words > 1")
    w = F.split("phrase", " ")
    cuts = [F.struct(F.lit(k).alias("k"), F.lit(left).alias("left"),
                     F.array_join(F.slice(w, 1, k) if left else F.slice(w, k + 1, F.greatest(F.col("words") - k, F.lit(0))), " ").alias("part"))
            for k in range(1, longest) for left in (True, False)]
    parts = wholes.select("lang", "phrase", "f", F.explode(F.filter(F.array(*cuts), lambda c: c["k"] < F.col("words"))).alias("c")) \
        .select("lang", F.col("phrase").alias("whole"), F.col("f").alias("a"), "c.k", "c.left", F.col("c.part").alias("phrase"))
    looked = parts.join(counts.filter("words > 0").select("lang", "phrase", "f"), ["lang", "phrase"])
    of = lambda k, left: F.max(F.when((F.col("k") == k) & (F.col("left") == left), F.col("f")))
    sides = looked.groupBy("lang", "whole").agg(
        F.max("a").alias("a"), *[of(k, left).alias(f"{'l' if left else 'r'}{k}") for k in range(1, longest) for left in (True, False)])
    big = "CAST({} AS DECIMAL(14, 0))".format
    score = [f"CASE WHEN l{k} IS NOT NULL THEN struct((CAST(1000000 AS DECIMAL(7, 0)) * ({big('a')} * {big('a')})) div ({big(f'l{k}')} * {big(f'r{k}')}) AS score, "
             f"{k} AS k, l{k} AS l, r{k} AS r) END" for k in range(1, longest)]
    best = F.expr(f"array_min(filter(array({', '.join(score)}), x -> x IS NOT NULL))")
    scored = sides.select("lang", F.col("whole").alias("phrase"), "a", best.alias("s")) \
        .select("lang", "phrase", "a", "s.l", "s.r", "s.score")
    # contiguous parts of two words and more, and the largest count of a phrase that holds them
    inner = [F.struct(F.array_join(F.slice(w, at, n), " ").alias("phrase"), (F.col("words") >= at + n - 1).alias("there"))
             for n in range(2, longest) for at in range(1, longest - n + 2)]
    if inner:
        within = wholes.select("lang", F.col("f").alias("longer"), F.explode(F.filter(
            F.array(*inner), lambda c: c["there"] & (c["phrase"] != F.col("phrase")))).alias("c"))
        within = within.groupBy("lang", F.col("c.phrase").alias("phrase")).agg(F.max("longer").alias("longer"))
        scored = scored.join(within, ["lang", "phrase"], "left")
        scored = scored.filter(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(share) * F.col("a")))
    # the best of each of some shares of a language first, so that its last ranking has a bounded number of rows
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share_of = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SHARES))).orderBy(*order)
    first = scored.withColumn("rank", F.row_number().over(share_of)).filter(F.col("rank") <= top)
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    n = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    return first.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: DuckDB, for the default parameters.
ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
grams AS (SELECT lang, s AS size, unnest(list_transform(range(1, len(w) - s + 2), lambda i: array_to_string(w[i:i + s - 1], ' '))) AS phrase
  FROM words, range(1, 4) t(s) WHERE len(w) >= s),
counts AS (SELECT lang, phrase, max(size) AS size, count(*) AS f FROM grams GROUP BY lang, phrase HAVING count(*) >= 10),
wholes AS (SELECT lang, phrase, size, f, string_split(phrase, ' ') AS w FROM counts WHERE size > 1),
cuts AS (SELECT c.*, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp
  FROM wholes c, range(1, 3) t(k) WHERE k < size),
scored AS (SELECT c.lang, c.phrase, c.size, c.f AS a, k, x.f AS l, y.f AS r,
    ((1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = lp JOIN counts y ON y.lang = c.lang AND y.phrase = rp),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(f) AS longer
  FROM wholes, range(1, 3) t(i) WHERE size = 3 GROUP BY 1, 2),
kept AS (SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase AND b.size = 2
  WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
