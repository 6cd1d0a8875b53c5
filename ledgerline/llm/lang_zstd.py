"""Language identification by compression: per language a zstandard raw-content dictionary of sample text; the
dictionary under which a text becomes smallest names its language.

Texts are compressed whole, in pieces of ``PIECE`` bytes, so that the dictionary counts for every part of a long
text and not for its beginning alone. A narrow margin between the two best totals rejects the prediction (column
``rejected``; the prediction itself stays the best language).

Learning: documents per language are counted over all labelled rows; a row is in the sample if a hash of its id is under
DOCS / count, which bounds the sample to about ``DOCS`` rows a language. A sampled row gives at most DICT_BYTES / rows
found bytes of folded text (1,048 at 500 rows; 256 at least), from a place in the whole text that a hash of its id gives: the
driver gets ``DOC_CHARS`` characters around there, and takes the bytes from a hashed place inside those. Shorter texts are
taken whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DOCS = 500  # sampled rows a language, about
DOC_CHARS = 4096  # of a sampled row that reach the driver
DICT_BYTES = 1 << 19
PIECE = 4096
LEVEL = 12
MARGIN = 0.004  # of the best size; under it a prediction is rejected
SCALE = 8.0  # bytes by which sizes differ for a factor e in the score
BUCKETS = 1_000_000_007


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _piece(text: Column, spot: Column) -> Column:
    """DOC_CHARS characters of a text from a place that a hash gives, all places alike; a shorter text as it is."""
    places = F.greatest(F.length(text) - (DOC_CHARS - 1), F.lit(1))
    return F.substring(text, (spot % places + 1).cast("int"), F.lit(DOC_CHARS))


def learn(docs: DataFrame, docs_per_language: int = DOCS) -> dict[str, bytes]:
    """Dictionary content by language, from rows with text, lang and a doc_id that isn't held out."""
    rows = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").where(~held_out())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, docs_per_language / n))])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS))
    spot = F.pmod(F.xxhash64("doc_id", F.lit("piece")), F.lit(BUCKETS))  # not place: that is small in the sample
    sample = rows.where(place < F.get(F.array(share), F.lit(0))[F.col("lang")] * BUCKETS).select(
        "lang", place.alias("place"), "doc_id", _piece(F.col("text"), spot).alias("text"), spot.alias("spot"))
    texts: dict[str, list[tuple[bytes, int]]] = {k: [] for k in counts}
    for r in sorted(sample.collect(), key=lambda r: (r["place"], r["doc_id"], r["text"])):
        texts[r["lang"]].append((folded(r["text"]), r["spot"]))
    out = {}
    for lang, found in texts.items():
        each = max(256, DICT_BYTES // max(1, len(found)))
        cut = [spot // DOC_CHARS % max(1, len(t) - each + 1) for t, spot in found]
        out[lang] = b" ".join(t[at:at + each] for (t, _), at in zip(found, cut))[:DICT_BYTES]
    return {k: v for k, v in out.items() if len(v) >= 8}


# ASCII letters to lower case, other ASCII bytes to spaces
_FOLD = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def folded(text: str) -> bytes:
    """What is compressed: the whole text in lower case, its words set apart by single spaces."""
    return b" ".join(text.lower().encode().translate(_FOLD).split())


class Judge:
    def __init__(self, contents: dict[str, bytes]) -> None:
        import zstandard as z

        self.names = sorted(contents)
        self.by: list = []
        for name in self.names:
            d = z.ZstdCompressionDict(contents[name], dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.by.append(z.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False,
                                            write_dict_id=False))

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether it is rejected."""
        if not text or not self.names or not any(map(str.isalpha, text)):
            return "und", 0.0, True
        data = folded(text)
        pieces = [data[k:k + PIECE] for k in range(0, len(data), PIECE)]
        sizes = [sum(map(len, map(c.compress, pieces))) for c in self.by]
        best = min(range(len(sizes)), key=lambda k: (sizes[k], k))
        least = sizes[best]
        score = 1.0 / sum(math.exp((least - s) / SCALE) for s in sizes)
        second = min((s for k, s in enumerate(sizes) if k != best), default=math.inf)
        return self.names[best], score, second - least < MARGIN * least


def languages(docs: DataFrame, docs_per_language: int = DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score (0 to 1), rejected per row of docs (doc_id, text, lang).

    lang_pred is a learned language, ``und`` where the text is null or has no letter (or nothing was learned; score 0,
    rejected). Equal sizes go to the first name. lang is read for learning alone, never for held-out rows.
    Rows that repeat give a row each; a null doc_id is neither learned from nor held out; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    contents = docs.sparkSession.sparkContext.broadcast(learn(docs, docs_per_language))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        j = Judge(contents.value)
        for b in batches:
            got = [j.judge(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.bool_())],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        rows, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
