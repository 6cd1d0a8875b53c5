"""Byte-level BPE of a tokenizer file by an index of pair occurrences, and its decoding.

The pieces of a partition that aren't known yet lie behind one another as symbols. An index maps each pair that the
merges know, by its rank, to all places where it stands. Active ranks are taken in ascending order: every occurrence
that still stands is merged, in all pieces at once (of overlapping ones the left one first), and the neighbours' new
pairs go to the lists of their own ranks. As a pair that holds a new symbol has a higher rank than the merge that
made it (checked when the file is read), this gives what merging each piece by itself gives.

Ids of pieces and of segments (a piece run behind a plain space) are remembered up to a bound in characters.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import prepare, without_cycle_search

#: The pattern that byte-level tokenizer files split texts by, with its white space spelled out.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
          rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: What no piece crosses: white space as the pattern has it, or all between two of these, with one plain space before.
SEGMENTS = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
UNEVEN = re.compile(r"  |\n\n|\n | \n|[\t\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
GAP = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")

MEMO_CHARS = 8 << 20  # characters of remembered pieces, and as many of segments
MEMO_ONE = 64  # the longest that is remembered
INDEXED = 1 << 20  # symbols indexed at once, but for a longer piece
CUT = 1 << 20  # characters of a text split at once


def byte_chars() -> dict[int, str]:
    """The character that stands for each byte in a byte-level file: printable ones for themselves, the others from
    U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + k) for k, b in enumerate(rest)}}


class PairIndex:
    """Merges pieces (bytes) by rank."""

    def __init__(self, vocab: dict[bytes, int], merges: list[tuple[bytes, bytes]]) -> None:
        if any(bytes([b]) not in vocab for b in range(256)):
            raise ValueError("every byte needs an id of its own")
        self.of_byte = np.array([vocab[bytes([b])] for b in range(256)], np.int32)
        made, pairs = {}, np.zeros((len(merges), 3), np.int64)
        for rank, (a, b) in enumerate(merges):
            if any(len(x) > 1 and x not in made for x in (a, b)) or a + b in made:
                raise ValueError(f"merge {rank} needs its parts before it, and a result of its own")
            made[a + b] = rank
            pairs[rank] = vocab[a], vocab[b], vocab[a + b]
        self.left, self.right, self.result = pairs.T.astype(np.int32)
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        self.rank_of = np.argsort(keys)
        self.keys = keys[self.rank_of]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """A pair's rank, or -1."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], -1)

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, as little-endian unsigned 32-bit integers."""
        out, part, held = [], [], 0
        for p in pieces:
            if part and held + len(p) > INDEXED:
                out += self._merged(part)
                part, held = [], 0
            part.append(p)
            held += len(p)
        return out + self._merged(part) if part else out

    def _merged(self, pieces: list[bytes]) -> list[bytes]:
        size = np.array([len(p) for p in pieces], np.int64)
        ends = np.cumsum(size)
        n = int(ends[-1])
        if not n or not len(self.keys):
            data = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)].astype("<u4").tobytes()
            return [data[4 * (e - s):4 * e] for s, e in zip(size.tolist(), ends.tolist())]
        sym = np.empty(n + 1, np.int32)
        sym[:n] = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        sym[n] = -1  # beyond a piece
        after = np.arange(1, n + 2, dtype=np.int32)
        before = np.arange(-1, n, dtype=np.int32)
        begins = (ends - size)[size > 0]
        after[ends[size > 0] - 1] = n
        before[begins] = n
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(places: np.ndarray) -> None:
            """Pairs that begin at these places join the lists of their ranks."""
            rank = self.ranks(sym[places], sym[after[places]])
            known = rank >= 0
            places, rank = places[known], rank[known]
            if not len(places):
                return
            order = np.argsort(rank, kind="stable")
            places, rank = places[order], rank[order]
            cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, group in zip(rank[np.concatenate([[0], cut])].tolist(), np.split(places, cut)):
                held = index.get(r)
                if held is None:
                    index[r] = [group]
                    heapq.heappush(active, r)
                else:
                    held.append(group)

        enter(np.arange(n))
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            places = lists[0] if len(lists) == 1 else np.concatenate(lists)
            left, right = self.left[r], self.right[r]
            places = np.unique(places[(sym[places] == left) & (sym[after[places]] == right)])
            if left == right and len(places) > 1:  # of a run that overlaps, every other one
                run = np.concatenate([[True], places[1:] != after[places[:-1]]])
                at = np.arange(len(places))
                places = places[(at - np.maximum.accumulate(np.where(run, at, 0))) % 2 == 0]
            if not len(places):
                continue
            gone = after[places]
            follow = after[gone]
            sym[places], sym[gone] = self.result[r], -2
            after[places] = follow
            before[follow] = places
            ahead = before[places]
            enter(np.concatenate([ahead[ahead < n], places]))
        ids = sym[:n][sym[:n] >= 0].astype("<u4").tobytes()
        cuts = np.concatenate([[0], np.cumsum(sym[:n] >= 0)])[np.concatenate([[0], ends])]
        return [ids[4 * a:4 * b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


class Codec:
    """A tokenizer file with byte-level pieces and merges; other kinds of files are refused."""

    def __init__(self, path: str, memo_chars: int = MEMO_CHARS) -> None:
        import regex

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, split = file["model"], file["pre_tokenizer"] or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
               if model.get(k)]
        if model["type"] != "BPE" or odd or file["normalizer"] or split.get("type") != "ByteLevel" \
                or split.get("add_prefix_space") or not split.get("use_regex", True) \
                or (file["decoder"] or {}).get("type") != "ByteLevel":
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        byte = {c: bytes([b]) for b, c in byte_chars().items()}
        spell = lambda token: b"".join([byte[c] for c in token])
        vocab = {spell(t): i for t, i in model["vocab"].items()}
        merges = [tuple(map(spell, m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
        self.index = PairIndex(vocab, merges)
        added = {t["content"]: t["id"] for t in file["added_tokens"]}
        if any(t[k] for t in file["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path}: added tokens that strip or need whole words")
        self.added = {t: np.array([i], "<u4").tobytes() for t, i in added.items()}
        longest_first = sorted(map(re.escape, added), key=len, reverse=True)
        self.marks = re.compile(f"({'|'.join(longest_first)})") if added else None
        self.bytes_of = {i: t for t, i in vocab.items()}
        self.bytes_of |= {i: b"".join([byte.get(c, c.encode()) for c in t]) for t, i in added.items()}
        self._found = regex.compile(PIECES).findall
        self._library, self.path = None, path
        self.memo_chars = memo_chars
        self.known: dict[str, bytes] = {}  # pieces
        self.heads: dict[str, bytes] = {}  # segments as they stand
        self.tails: dict[str, bytes] = {}  # segments behind a plain space
        self.known_chars = self.segment_chars = 0

    def pieces(self, text: str) -> list[str]:
        """A segment's pieces. Characters that Python's own tables don't know (newer ones, unassigned ones) are letters to
        one library's tables and not to the other's: such segments are split by the tokenizers library."""
        if text.isascii() or text.strip(" \n").isprintable():
            return self._found(text)
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def _blocks(self, text: str) -> Iterator[str]:
        """A long text in parts, cut before plain spaces between letters, where no piece crosses."""
        at = 0
        while len(text) - at > 2 * CUT:
            gap = GAP.search(text, at + CUT)
            if not gap:
                break
            yield text[at:gap.start()]
            at = gap.start()
        yield text[at:] if at else text

    def _learn(self, segments: list[str], memo: dict[str, bytes], before: str, once: dict[str, bytes]) -> None:
        """Ids of segments: their new pieces are indexed together. What is too long to be remembered goes to ``once``."""
        split = [self.pieces(before + s) for s in segments]
        known = self.known
        new = list({p for pieces in split for p in pieces if p not in known})
        coded = dict(zip(new, self.index.encode([p.encode() for p in new])))
        for s, pieces in zip(segments, split):
            got = b"".join([known[p] if p in known else coded[p] for p in pieces])
            if len(s) <= MEMO_ONE:
                memo[s] = got
                self.segment_chars += len(s)
            else:
                once[s] = got
        short = {p: c for p, c in coded.items() if len(p) <= MEMO_ONE}
        self.known_chars += sum(map(len, short))
        known.update(short)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        if self.known_chars > self.memo_chars:
            self.known.clear()
            self.known_chars = 0
        if self.segment_chars > self.memo_chars:
            self.heads.clear()
            self.tails.clear()
            self.segment_chars = 0
        heads, tails = self.heads.get, self.tails.get
        # per text: (memo, segments, their ids as far as known) or the ids of an added token
        plan: list[list] = []
        new_heads, new_tails = set(), set()
        for text in texts:
            parts: list = []
            for k, part in enumerate(self.marks.split(text) if self.marks else [text]):
                if k % 2:
                    parts.append((None, None, self.added[part]))
                    continue
                for block in self._blocks(part) if part else ():
                    if UNEVEN.search(block):
                        names = SEGMENTS.findall(block)
                        got = list(map(heads, names))
                        if None in got:
                            new_heads.update([s for s, g in zip(names, got) if g is None])
                        parts.append((True, names, got))
                        continue
                    for j, line in enumerate(block.split("\n")):
                        first, *names = line.split(" ")
                        lead = (["\n"] if j else []) + ([first] if first else [])
                        if lead:
                            got = list(map(heads, lead))
                            if None in got:
                                new_heads.update([s for s, g in zip(lead, got) if g is None])
                            parts.append((True, lead, got))
                        if names:
                            got = list(map(tails, names))
                            if None in got:
                                new_tails.update([s for s, g in zip(names, got) if g is None])
                            parts.append((False, names, got))
            plan.append(parts)
        once_heads: dict[str, bytes] = {}
        once_tails: dict[str, bytes] = {}
        if new_heads:
            self._learn(list(new_heads), self.heads, "", once_heads)
        if new_tails:
            self._learn(list(new_tails), self.tails, " ", once_tails)
        out = []
        for parts in plan:
            coded: list[bytes] = []
            for head, names, got in parts:
                if head is None:
                    coded.append(got)
                    continue
                if None in got:
                    memo, once = (self.heads, once_heads) if head else (self.tails, once_tails)
                    got = [(memo.get(s) if s in memo else once[s]) if g is None else g for s, g in zip(names, got)]
                coded += got
            out.append(b"".join(coded))
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids (little-endian unsigned 32-bit integers), added tokens with their names. Bytes that are no
        UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str, memo_chars: int = MEMO_CHARS) -> Codec:
    """The codec of a file; one per worker."""
    return Codec(path, memo_chars)


BATCH_CHARS = 4 << 20


def tokens(docs: DataFrame, path: str, ids: bool = False, decoded: bool = False, memo_chars: int = MEMO_CHARS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (with ``ids`` also ids, array<int>; with ``decoded`` also the decoded
    text) per row of docs (doc_id, text; other columns are ignored).

    path: a byte-level BPE tokenizer file that every executor has. Ids are those that the tokenizers library gives with
    add_special_tokens=False, without truncation and padding: names of added tokens in a text become their ids. The decoded
    text is made from the ids. A null or empty text has no ids and the digests of empty strings; whole texts of any length;
    repeated rows give a row each, a null doc_id stays null; an empty table gives no rows.
    """
    prepare(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, memo_chars)
        for b in batches:
            texts, at = [t or "" for t in b.column(1).to_pylist()], 0
            while at < len(texts):
                to, held = at, 0
                while to < len(texts) and (to == at or held + len(texts[to]) <= BATCH_CHARS):
                    held += len(texts[to])
                    to += 1
                with without_cycle_search():
                    coded = c.encode(texts[at:to])
                    back = [c.decode(x) for x in coded]
                cols = [b.column(0).slice(at, to - at), pa.array([len(x) // 4 for x in coded], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in coded], pa.string()),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back], pa.string())]
                if ids:
                    ends = np.cumsum([0, *(len(x) // 4 for x in coded)])
                    cols.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                                         pa.array(np.frombuffer(b"".join(coded), "<i4"), pa.int32())))
                if decoded:
                    cols.append(pa.array(back, pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names)
                at = to

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * ids, *["decoded"] * decoded]
    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids + ", decoded string" * decoded
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(rows, kinds)
