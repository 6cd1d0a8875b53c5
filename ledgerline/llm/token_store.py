"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the ids of a run of documents, in ascending doc_id order, in blocks of 128 ids. A block stores its
minimum, a bit width and the differences to the minimum packed at that width. The width is what ``percentile`` of the
block's differences need; larger ones (outliers) are stored in the block's exception list, as place and difference.

Layout (little-endian): ``PFR1`` | blocks | block starts, uint64 each | documents: doc_id int64, ids before it in
the file uint64, has a doc_id uint8 (three arrays) | footer: ids, blocks, documents, places of the block starts and
of the documents (uint64 each), crc32 of all before the footer (uint32), ``PFR1``.
A block: minimum uint32, width uint8, exceptions uint8, 16 * width bytes, places uint8 each, differences uint32 each.

Documents are dealt by ranges of doc_id and sorted in each; a task writes one file under a name of its own attempt
and then gives it its final name, so a task that runs again leaves the same file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise, scratch, without_cycle_search

MAGIC = b"PFR1"
BLOCK = 128
PERCENTILE = 0.9
FOOTER = struct.Struct("<QQQQQI4s")
FLUSH = 512 * BLOCK  # ids packed at once
READ = 1 << 20  # ids read at once, but for a longer document
MAX_SEGMENTS = 1_300_000
END_ID = 0
JOINED = 1000  # new segments sent to the library as one text


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.frexp(x.astype(np.float64))[1].astype(np.int64)


def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[bytes, np.ndarray]:
    """Blocks of ids (uint32, a multiple of BLOCK) and each block's length in bytes."""
    a = ids.reshape(-1, BLOCK)
    low = a.min(axis=1)
    d = a - low[:, None]
    k = max(0, int(np.ceil(percentile * BLOCK)) - 1)
    width = _bits(np.partition(d, k, axis=1)[:, k])
    limit = ((1 << width) - 1).astype(np.uint32)
    out_of = d > limit[:, None]
    n_out = out_of.sum(axis=1)
    sizes = 6 + 16 * width + 5 * n_out
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    out = np.zeros(int(sizes.sum()), np.uint8)
    head = np.column_stack([low.astype("<u4").view(np.uint8).reshape(-1, 4), width.astype(np.uint8), n_out.astype(np.uint8)])
    out[starts[:, None] + np.arange(6)] = head
    d[out_of] = 0
    for w in np.unique(width):
        if not w:
            continue
        at = np.flatnonzero(width == w)
        v = np.ascontiguousarray(d[at].T)
        words = np.zeros((4 * w, len(at)), np.uint32)
        for i in range(BLOCK):
            word, off = divmod(i * int(w), 32)
            words[word] |= v[i] << np.uint32(off)
            if off + w > 32:
                words[word + 1] |= v[i] >> np.uint32(32 - off)
        packed = np.ascontiguousarray(words.T).astype("<u4").view(np.uint8).reshape(len(at), -1)
        out[(starts[at] + 6)[:, None] + np.arange(16 * w)] = packed
    r, c = np.nonzero(out_of)
    if len(r):
        rank = np.arange(len(r)) - np.concatenate([[0], np.cumsum(n_out)[:-1]])[r]
        tail = starts + 6 + 16 * width
        out[tail[r] + rank] = c
        value = (a[r, c] - low[r]).astype("<u4").view(np.uint8).reshape(-1, 4)
        out[(tail[r] + n_out[r] + 4 * rank)[:, None] + np.arange(4)] = value
    return out.tobytes(), sizes


def unpack(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ids (uint32) of the blocks that begin at ``starts`` in data (uint8)."""
    head = data[starts[:, None] + np.arange(6)]
    low = np.ascontiguousarray(head[:, :4]).view("<u4").ravel()
    width, n_out = head[:, 4].astype(np.int64), head[:, 5].astype(np.int64)
    d = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width):
        if not w:
            continue
        at = np.flatnonzero(width == w)
        words = np.ascontiguousarray(data[(starts[at] + 6)[:, None] + np.arange(16 * w)]).view("<u4").T
        words = np.ascontiguousarray(words)
        v, mask = np.empty((BLOCK, len(at)), np.uint32), np.uint32((1 << int(w)) - 1)
        for i in range(BLOCK):
            word, off = divmod(i * int(w), 32)
            x = words[word] >> np.uint32(off)
            if off + w > 32:
                x = x | (words[word + 1] << np.uint32(32 - off))
            v[i] = x & mask
        d[at] = v.T
    r = np.repeat(np.arange(len(starts)), n_out)
    if len(r):
        rank = np.arange(len(r)) - np.concatenate([[0], np.cumsum(n_out)[:-1]])[r]
        tail = starts[r] + 6 + 16 * width[r]
        value = np.ascontiguousarray(data[(tail + n_out[r] + 4 * rank)[:, None] + np.arange(4)]).view("<u4").ravel()
        d[r, data[tail + rank]] = value
    return (d + low[:, None]).ravel()


def _fs(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


class TokenWriter:
    """Writes one file; ``add`` documents in order, then ``close``."""

    def __init__(self, out: pa.NativeFile) -> None:
        self.out, self.at, self.crc, self.n = out, 0, 0, 0
        self.rest, self.held = [], 0
        self.sizes: list[np.ndarray] = []
        self.ids: list[int | None] = []
        self.starts: list[int] = []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.crc = zlib.crc32(data, self.crc)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.starts.append(self.n)
        self.n += len(ids)
        self.rest.append(ids)
        self.held += len(ids)
        if self.held >= FLUSH:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        a = np.concatenate(self.rest) if self.rest else np.zeros(0, np.uint32)
        cut = len(a) if last else len(a) // BLOCK * BLOCK
        whole, keep = a[:cut], a[cut:]
        if len(whole) % BLOCK:  # the last block is filled up with its last id
            whole = np.concatenate([whole, np.full(-len(whole) % BLOCK, whole[-1], np.uint32)])
        for k in range(0, len(whole), FLUSH):
            data, sizes = pack(whole[k:k + FLUSH])
            self._put(data)
            self.sizes.append(sizes)
        self.rest, self.held = [keep], len(keep)

    def close(self) -> int:
        self._flush(True)
        sizes = np.concatenate(self.sizes) if self.sizes else np.zeros(0, np.int64)
        at_blocks = self.at
        self._put((len(MAGIC) + np.cumsum(sizes) - sizes).astype("<u8").tobytes())
        at_docs = self.at
        self._put(np.array([i or 0 for i in self.ids], "<i8").tobytes())
        self._put(np.array(self.starts, "<u8").tobytes())
        self._put(np.array([i is not None for i in self.ids], np.uint8).tobytes())
        self.out.write(FOOTER.pack(self.n, len(sizes), len(self.ids), at_blocks, at_docs, self.crc, MAGIC))
        return self.n


class TokenFile:
    """Reads one file; any range of ids, by the block starts."""

    def __init__(self, f: pa.NativeFile) -> None:
        self.f = f
        self.n, self.n_blocks, self.n_docs, at_blocks, at_docs, self.crc, magic = FOOTER.unpack(
            f.read_at(FOOTER.size, f.size() - FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.blocks = np.frombuffer(f.read_at(8 * self.n_blocks, at_blocks), "<u8").astype(np.int64)
        self.end = at_blocks
        docs = f.read_at(17 * self.n_docs, at_docs)
        self.doc_ids = np.frombuffer(docs, "<i8", self.n_docs)
        self.starts = np.frombuffer(docs, "<u8", self.n_docs, 8 * self.n_docs).astype(np.int64)
        self.has_id = np.frombuffer(docs, np.uint8, self.n_docs, 16 * self.n_docs).astype(bool)

    def read(self, start: int, stop: int) -> np.ndarray:
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, -(-stop // BLOCK)
        begin = int(self.blocks[first])
        end = int(self.blocks[last]) if last < self.n_blocks else self.end
        got = unpack(np.frombuffer(self.f.read_at(end - begin, begin), np.uint8), self.blocks[first:last] - begin)
        return got[start - first * BLOCK:stop - first * BLOCK]

    def documents(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Runs of documents: index of the first, their ends among the ids that follow, and those ids."""
        stops = np.append(self.starts[1:], self.n)
        k = 0
        while k < self.n_docs:
            upto = max(k + 1, int(np.searchsorted(stops, self.starts[k] + READ, "right")))
            yield k, stops[k:upto] - self.starts[k], self.read(int(self.starts[k]), int(stops[upto - 1]))
            k = upto


class _Encoder:
    """A tokenizer file of the tokenizers library. The pattern before its merges can't cross a plain space or a single
    line end between other characters, so texts are cut there and ids of such segments are memoised, up to a bound.
    A segment is a word behind its space, or a line's first word with the line end before it. A full stop or comma
    behind a letter is a match of its own, so only the word before it goes to the library. With ``names``, texts that hold
    the name of an added token (rare) go to the library whole, which gives its id; without, the name is ordinary text."""

    def __init__(self, path: str, names: bool = False) -> None:
        from tokenizers import Tokenizer

        from ledgerline.llm.bpe_transducer import Codec

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.names = [t.content for t in self.whole.get_added_tokens_decoder().values()] if names else []
        self.t = Tokenizer.from_file(path)
        self.t.encode_special_tokens = True  # their strings in a text are ordinary text
        self.odd = Codec._ODD.search
        self.known: dict[str, bytes] = {}
        self.marks = dict(zip(".,", (a.tobytes() for a in self._ids([".", ","]))))
        # in a byte-level vocabulary a token's characters stand for a byte each
        vocab = self.t.get_vocab()
        self.n_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.n_bytes[i] = len(token)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.t.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, segments: list[str]) -> None:
        """Ids of segments. Many go to the library as one text; its ids are cut where a segment's bytes end, as
        each token stands for so many bytes."""
        known, marks, stops = self.known, self.marks, []
        whole = set()
        for s in segments:
            if s[-1:] in marks and s[-2:-1].isalpha():
                stops.append(s)
                if s[:-1] not in known:
                    whole.add(s[:-1])
            else:
                whole.add(s)
        alone = [s for s in ("", "\n") if s in whole]  # white space would join its neighbours'
        known.update(zip(alone, (a.tobytes() for a in self._ids([s or " " for s in alone]))))
        rest = list(whole.difference(alone))
        runs = [rest[k:k + JOINED] for k in range(0, len(rest), JOINED)]
        texts = ["".join([s if s[0] == "\n" else f" {s}" for s in run]) for run in runs]
        for run, text, ids in zip(runs, texts, self._ids(texts)):
            raw = np.frombuffer(text.encode(), np.uint8)
            ends = np.append(np.flatnonzero((raw == 32) | (raw == 10))[1:], len(raw))
            cuts = 4 * (np.searchsorted(np.cumsum(self.n_bytes[ids]), ends) + 1)
            data, at = ids.tobytes(), 0
            for s, cut in zip(run, cuts.tolist()):
                known[s] = data[at:cut]
                at = cut
        for s in stops:
            known[s] = known[s[:-1]] + marks[s[-1]]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        named = [k for k, t in enumerate(texts) if any(n in t for n in self.names)]
        if named:
            out = self._plain(["" if any(n in t for n in self.names) else t for t in texts])
            for k, e in zip(named, self.whole.encode_batch_fast([texts[k] for k in named], add_special_tokens=False)):
                out[k] = np.array(e.ids, "<u4")
            return out
        return self._plain(texts)

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > MAX_SEGMENTS:
            self.known.clear()
        get, heads, rows, new = self.known.get, [], [], set()
        for t in texts:
            plain = not ("  " in t or "\n " in t or " \n" in t or "\n\n" in t or self.odd(t))
            first, *rest = t.replace("\n", " \n").split(" ") if plain else [t]
            got = list(map(get, rest))
            lacks = [k for k, g in enumerate(got) if g is None] if None in got else []
            new.update([rest[k] for k in lacks])
            heads.append(first)
            rows.append((got, lacks, [rest[k] for k in lacks]))
        self._learn(list(new))
        out = []
        for head, (got, lacks, names) in zip(self._ids(heads), rows):
            for k, s in zip(lacks, names):
                got[k] = self.known[s]
            out.append(np.frombuffer(b"".join([head.tobytes(), *got]), "<u4"))
        return out


@lru_cache(maxsize=2)
def encoder(path: str, names: bool = False) -> _Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
    return _Encoder(path, names)


def write(docs: DataFrame, tokenizer: str, folder: str) -> DataFrame:
    """Write the ids of all documents to files in ``folder``; one row a file: shard, file, n_docs, n_ids.

    Files in the order of shard hold the documents in ascending doc_id order (null ids first; rows that
    share a doc_id in the order of their texts). Each document's ids are the library's with add_special_tokens=False (the
    name of an added token in a text becomes its id) and end with END_ID.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        fs, root = _fs(folder)
        name = f"ids-{shard:06d}.pfor"
        trial = f"{root}/.{name}-{uuid.uuid4().hex}"
        enc, writer, n_docs, n = encoder(tokenizer, True), None, 0, 0
        fs.create_dir(root, recursive=True)
        with without_cycle_search(), fs.open_output_stream(trial) as out:
            writer = TokenWriter(out)
            for b in batches:
                for at in range(0, b.num_rows, 500):
                    part = b.slice(at, 500)
                    coded = enc.encode([t or "" for t in part.column(1).to_pylist()])
                    for i, ids in zip(part.column(0).to_pylist(), coded):
                        writer.add(i, np.append(ids, np.uint32(END_ID)))
                        n_docs += 1
            n = writer.close()
        if not n_docs:
            fs.delete_file(trial)
            return
        fs.move(trial, f"{root}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([name]), pa.array([n_docs], pa.int64()),
                                          pa.array([n], pa.int64())], ["shard", "file", "n_docs", "n_ids"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = d.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return materialise(dealt.mapInArrow(rows, "shard long, file string, n_docs long, n_ids long"), "token-manifest")


def read_back(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 per document, from the files alone. The driver sees a row a file."""
    files = sorted((r["shard"], r["file"], r["n_ids"]) for r in manifest.collect())
    if not files:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    base, listed = 0, []
    for _, name, n in files:
        listed.append((name, base))
        base += n

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _fs(folder)
        for b in batches:
            for name, before in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with fs.open_input_file(f"{root}/{name}") as f:
                    t = TokenFile(f)
                    for k, ends, ids in t.documents():
                        data = memoryview(ids.astype("<u4").tobytes())
                        begins = np.concatenate([[0], ends[:-1]])
                        crc = [zlib.crc32(data[4 * s:4 * e]) for s, e in zip(begins.tolist(), ends.tolist())]
                        which = slice(k, k + len(ends))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(t.doc_ids[which], mask=~t.has_id[which]),
                             pa.array(before + t.starts[which]), pa.array(ends - begins), pa.array(crc, pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32"])

    # a file a task
    table = spark.createDataFrame(listed, "file string, base long").repartition(len(listed))
    return table.mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def store(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write and read back: doc_id, start (ids of all documents before it), n_tokens (with the end id), ids_crc32
    (of the ids as little-endian uint32) per row of docs (doc_id, text; other columns are ignored).

    Null and empty texts have the end id alone. An empty table gives no rows and no files.
    """
    folder = folder or scratch(docs.sparkSession, "token-ids")
    return read_back(docs.sparkSession, write(docs, tokenizer, folder), folder)
