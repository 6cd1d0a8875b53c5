"""Byte-level BPE by a lazily determinised finite-state transducer, and a streaming decoder.

Merges by rank give every byte string one token sequence, and a sequence is that of its bytes just when each two
neighbours stay apart when merged by themselves. So a nondeterministic transducer reads bytes along the
vocabulary's trie, may end a token wherever the trie has one that stays apart from the token before, and has one accepting
path. It is made deterministic as texts need it: a state is the set of live paths (last token, trie node, tokens
not yet emitted), and a step emits what all live paths agree on. A path that ends no token within the longest
token's length dies, which bounds the lookahead. States are kept up to a bound, then built anew.

Pieces (matches of the pattern) are coded separately, the different ones of some hundred rows side by side: one array step reads
a byte of each, so Python runs once for a new step, not for a byte. A text is cut at plain spaces between other characters, where no
match can cross; ids of such segments and of uncut texts' pieces are memoised, also up to a bound.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import give_back, without_cycle_search

MAX_STATES = 400_000
MAX_SEGMENTS = 250_000  # and as many words of uncut texts
MAX_SEGMENT_CHARS = 64
CHUNK_IDS = 8192
MAX_PAIRS = 150_000
ROWS = 250  # whose ids are held at once
TRIED = 32
FEW = 32  # pieces left, which are read one by one
RUN = 1 << 16  # segments or words looked up at once
LATE = 1 << 12
_FAR = 1 << 60
_LOW = (1 << 32) - 1
_ALL = (1 << 64) - 1
_MIX = 0x9E3779B97F4A7C15


class Vocabulary:
    """Ranks, the trie of their bytes, and which neighbours stay apart."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.trie: dict[int, int] = {}  # node << 8 | byte: node
        self.token_at: dict[int, int] = {}
        below: dict[int, list[int]] = {}
        for token, r in ranks.items():
            node = 0
            for b in token:
                if node:
                    below.setdefault(node, []).append(r)
                node = self.trie.setdefault(node << 8 | b, len(self.trie) + 1)
            self.token_at[node] = r
        #: tokens that a path at a node may yet end, where these are few enough to be tried
        self.below = {n: tuple(x) for n, x in below.items() if len(x) <= TRIED}
        self.leaves = set(self.token_at) - set(below)
        self._hope: dict[int, bool] = {}
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._edges: dict[int, tuple[list[tuple[bytes, int]], list[tuple[bytes, int]]]] = {}
        self._apart: dict[int, bool] = {}
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every byte needs a rank of its own")

    def merged(self, data: bytes, below: int = _FAR) -> list[bytes]:
        """Plain merging by rank, of ranks under ``below``; used for the bytes of single tokens."""
        parts = [data[k:k + 1] for k in range(len(data))]
        while True:
            r, k = min(((self.ranks.get(parts[k] + parts[k + 1], _FAR), k) for k in range(len(parts) - 1)),
                       default=(_FAR, 0))
            if r >= below:
                return parts
            parts[k:k + 2] = [parts[k] + parts[k + 1]]

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte."""
        if token not in self._parts:
            data, got = self.bytes_of[token], None
            if len(data) > 1:
                two = self.merged(data, token)
                if len(two) != 2 or any(self.ranks[p] >= token and len(p) > 1 for p in two):
                    raise ValueError(f"token {token} isn't made by merging two tokens of lower rank")
                got = self.ranks[two[0]], self.ranks[two[1]]
            self._parts[token] = got
        return self._parts[token]

    def edges(self, token: int) -> tuple[list[tuple[bytes, int]], list[tuple[bytes, int]]]:
        """What stands at the token's right and left end while it is merged: (its bytes, rank of the merge that ends it)."""
        if token not in self._edges:
            both = []
            for side in (1, 0):
                line, t, until = [], token, _FAR
                while True:
                    line.append((self.bytes_of[t], until))
                    two = self.parts(t)
                    if two is None:
                        break
                    t, until = two[side], t
                both.append(line)
            self._edges[token] = both[0], both[1]
        return self._edges[token]

    def hope(self, last: int, node: int) -> bool:
        """May a path at this node still end a token that stays apart from the last one? True if too many would
        have to be tried; such a path dies later."""
        if node in self.leaves:
            return False
        tokens = self.below.get(node)
        if last < 0 or tokens is None:
            return True
        key = last << 32 | node
        got = self._hope.get(key)
        if got is None:
            if len(self._hope) > MAX_PAIRS:
                self._hope.clear()
            got = self._hope[key] = any(self.apart(last, t) for t in tokens)
        return got

    def apart(self, left: int, right: int) -> bool:
        """Do the bytes of both, merged by rank, give these two tokens?

        They don't if some merge across the border comes before the merges that use up either symbol there;
        of equal ranks the left one comes first."""
        key = left << 32 | right
        got = self._apart.get(key)
        if got is None:
            if len(self._apart) > MAX_PAIRS:
                self._apart.clear()
            got = self._apart[key] = self._stay(left, right)
        return got

    def _stay(self, left: int, right: int) -> bool:
        rank, line = self.ranks.get, self.edges(right)[1]
        for x, x_until in self.edges(left)[0]:
            for y, y_until in line:
                m = rank(x + y)
                if m is not None and m < x_until and m <= y_until:
                    return False
        return True


def _parts(data: bytes, stops: np.ndarray) -> list[bytes]:
    """The parts that end at these places."""
    return [data[a:b] for a, b in pairwise([0, *stops.tolist()])]


def _runs(flat: np.ndarray, stops: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The parts of ``flat`` with these numbers, one behind the other."""
    n = sizes[which]
    after = np.cumsum(n)
    return flat[np.arange(n.sum()) + np.repeat(stops[which] - after, n)]


class Steps:
    """Known steps of the transducer, state << 8 | byte: state << 32 | number of what is emitted. They lie in arrays, open
    addressed, and are looked up many at a time; a dict of them would take three times the memory."""

    def __init__(self) -> None:
        self.n, self.late = 0, {}  # entered in the arrays; not yet
        self._room(1 << 12)

    def __len__(self) -> int:
        return self.n + len(self.late)

    def _room(self, size: int) -> None:
        self.keys, self.values = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        self.shift = 65 - size.bit_length()

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(_MIX)) >> np.uint64(self.shift)).view(np.int64)

    def _enter(self, keys: np.ndarray, values: np.ndarray) -> None:
        at, last = self._places(keys), len(self.keys) - 1
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # of several at one place one stays, the others go on
            here = self.keys[at] == keys
            self.values[at[here]] = values[here]
            keys, values, at = keys[~here], values[~here], (at[~here] + 1) & last

    def settle(self) -> None:
        new = np.fromiter(self.late, np.int64, len(self.late)), np.fromiter(self.late.values(), np.int64, len(self.late))
        self.n += len(self.late)
        self.late.clear()
        if 2 * self.n > len(self.keys):
            have = np.flatnonzero(self.keys >= 0)
            old = self.keys[have], self.values[have]
            self._room(1 << (3 * self.n).bit_length())
            self._enter(*old)
        self._enter(*new)

    def add(self, key: int, value: int) -> None:
        """A step that isn't known yet."""
        self.late[key] = value
        if len(self.late) > LATE:
            self.settle()

    def one(self, key: int) -> int:
        """As ``get``, of one key."""
        got = self.late.get(key)
        if got is None:
            at, last = (key * _MIX & _ALL) >> self.shift, len(self.keys) - 1
            while (found := self.keys.item(at)) != key:
                if found < 0:
                    return -1
                at = (at + 1) & last
            got = self.values.item(at)
        return got

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values of keys; -1 for those not known."""
        if self.late:
            self.settle()
        at, last = self._places(keys), len(self.keys) - 1
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], -1)
        left = np.flatnonzero((found != keys) & (found >= 0))
        while len(left):
            at[left] = (at[left] + 1) & last
            found = self.keys[at[left]]
            hit = found == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (found >= 0)]
        return out


class Transducer:
    """Deterministic states, built when first reached."""

    def __init__(self, vocabulary: Vocabulary, max_states: int = MAX_STATES) -> None:
        self.v, self.max_states, self.built = vocabulary, max_states, 0
        self._reset()

    def _reset(self) -> None:
        #: emitted tokens by number, one behind the other, and where each ends
        self.numbers: dict[tuple[int, ...], int] = {(): 0}
        self.emitted, self.ends = array("I"), array("q", [0])
        self._no_states()

    def _no_states(self) -> None:
        # a state's paths, one behind the other in a flat tuple (nested ones take three times the memory): last token or
        # -1, trie node, number of tokens held back, and these; the path that has read whole tokens is the last
        self.keys: list[tuple[int, ...]] = []
        self.known: dict[tuple[int, ...], int] = {}
        self.steps = Steps()
        self.finals = array("i")
        self._state((-1, 0, 0), 0)

    def _state(self, key: tuple[int, ...], final: int) -> int:
        to = self.known.get(key)
        if to is None:
            to = self.known[key] = len(self.keys)
            self.keys.append(key)
            self.finals.append(final)
        return to

    def _number(self, tokens: tuple[int, ...]) -> int:
        k = self.numbers.get(tokens)
        if k is None:
            k = self.numbers[tokens] = len(self.ends)
            self.emitted.extend(tokens)
            self.ends.append(len(self.emitted))
        return k

    def _anew(self, states: list[int]) -> list[int]:
        """Drop all states but these; what was emitted keeps its number. The new numbers of these states."""
        kept = [(self.keys[s], self.finals[s]) for s in states]
        self._no_states()
        return [self._state(*x) for x in kept]

    def _build(self, state: int, byte: int) -> int:
        v, key = self.v, self.keys[state]
        trie, token_at, live, whole = v.trie, v.token_at, [], None
        at, end = 0, len(key)
        while at < end:  # paths in the order of where their open tokens begin
            last, node, n = key[at], key[at + 1], key[at + 2]
            at += 3 + n
            to = trie.get(node << 8 | byte)
            if to is None:
                continue
            held = key[at - n:at]
            if whole is None and (t := token_at.get(to)) is not None and (last < 0 or v.apart(last, t)):
                whole = t, 0, (*held, t)  # the one sequence of all bytes so far
            if v.hope(last, to):
                live.append((last, to, held))
        first = whole[2]
        agreed = len(first)
        for _, _, held in live:
            k, agreed = 0, min(agreed, len(held))
            while k < agreed and held[k] == first[k]:
                k += 1
            agreed = k
        live.append(whole)
        flat: list[int] = []
        for last, node, held in live:
            flat += (last, node, len(held) - agreed)
            flat += held[agreed:]
        self.built += 1
        return self._state(tuple(flat), self._number(first[agreed:])) << 32 | self._number(first[:agreed])

    def _read(self, piece: bytes, state: int) -> list[int]:
        """Numbers of what is emitted for the rest of a piece."""
        out = []
        for byte in piece:
            key = state << 8 | byte
            got = self.steps.one(key)
            if got < 0:
                got = self._build(state, byte)
                self.steps.add(key, got)
            state = got >> 32
            if got & _LOW:
                out.append(got & _LOW)
            if len(self.keys) > self.max_states:
                state = self._anew([state])[0]
        out.append(self.finals[state])
        return out

    def encode(self, piece: bytes) -> list[int]:
        return self.encode_all(np.frombuffer(piece, np.uint8), np.array([len(piece)]))[0].tolist()

    def encode_all(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, and how many each has. Pieces, of these sizes, stand one behind the other in ``flat``. They are read
        side by side, a byte of each at a time, the longest first; the last few to the end one by one."""
        if len(self.keys) > self.max_states or len(self.ends) > self.max_states:
            self._reset()
        order = np.argsort(-sizes, kind="stable")
        starts = (np.cumsum(sizes) - sizes)[order]
        falling = -sizes[order]
        state = np.zeros(len(sizes), np.int64)
        who, what = [], []  # pieces by their place in the order, and numbers of what is emitted for them
        n, at = len(sizes), 0
        while True:
            n, before = int(np.searchsorted(falling, -at)), n  # those with more than this many bytes
            who.append(np.arange(n, before))
            what.append(np.frombuffer(self.finals, np.int32)[state[n:before]])
            if n < FEW:
                break
            key = state[:n] << 8 | flat[starts[:n] + at]
            got = self.steps.get(key)
            if got.min() < 0:
                for k in np.unique(key[got < 0]).tolist():
                    self.steps.add(k, self._build(k >> 8, k & 255))
                got = self.steps.get(key)
            state[:n] = got >> 32
            out = got & _LOW
            some = np.flatnonzero(out)
            who.append(some)
            what.append(out[some])
            if len(self.keys) > self.max_states:
                live, back = np.unique(state[:n], return_inverse=True)
                # those at their end are done at the start of the next turn, so their states are live, too
                state[:n] = np.array(self._anew(live.tolist()), np.int64)[back]
            at += 1
        left = [(self.keys[x], self.finals[x]) for x in state[:n].tolist()]  # numbers may change on the way
        for k, x in enumerate(left):
            rest = self._read(flat[starts[k] + at:starts[k] - falling[k]].tobytes(), self._state(*x))
            who.append(np.full(len(rest), k))
            what.append(np.array(rest, np.int64))
        who, what = np.concatenate(who), np.concatenate(what).astype(np.int64)
        ends = np.array(self.ends)
        n_ids = np.diff(ends, prepend=0)
        counts = np.zeros(len(sizes), np.int64)
        counts[order] = np.bincount(who, n_ids[what], len(sizes)).astype(np.int64)
        what = what[np.argsort(order[who], kind="stable")]
        return _runs(np.array(self.emitted, np.uint32), ends, n_ids, what), counts


class Utf8Machine:
    """Incremental UTF-8: bytes come in any cuts, whole characters go out; a cut character waits for its rest.

    Its state is the bytes of an unfinished character, as far as they can still become one."""

    def __init__(self) -> None:
        self.waiting = b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """How many of the last bytes begin a character that isn't finished."""
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if b & 0xC0 == 0x80:
                continue
            need = 2 if 0xC2 <= b <= 0xDF else 3 if 0xE0 <= b <= 0xEF else 4 if 0xF0 <= b <= 0xF4 else 1
            if need <= back:
                return 0
            # bounds of a second byte: no overlong forms, surrogates or values over the last code point
            low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(
                b, (0x80, 0xBF))
            return back if back == 1 or low <= data[1 - back] <= high else 0
        return 0

    def feed(self, data: bytes, last: bool = False) -> str:
        data = self.waiting + data
        cut = len(data) if last else len(data) - self.unfinished(data)
        self.waiting = data[cut:]
        return data[:cut].decode("utf-8", "replace")


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str, max_segments: int = MAX_SEGMENTS) -> None:
        import regex

        self.vocabulary = Vocabulary(ranks)
        self.transducer = Transducer(self.vocabulary)
        self.pieces = regex.compile(pattern).findall
        self.segments: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.max_segments = max_segments
        names = [self.vocabulary.bytes_of.get(r, b"") for r in range(max(ranks.values()) + 1)]
        sizes = np.fromiter(map(len, names), np.int64, len(names))
        self.spelled = np.frombuffer(b"".join(names), np.uint8), np.cumsum(sizes), sizes

    #: White space beside " " and "\n"; with it, or with spaces in a row or beside line ends, texts aren't cut.
    _ODD = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

    def _known(self, known: dict[str, bytes], items: list[str], code: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """Ids of different segments or words, of the new ones by ``code``."""
        out: list[bytes] = []
        for at in range(0, len(items), RUN):
            run = items[at:at + RUN]
            new = [x for x in run if x not in known]
            if len(known) + len(new) > self.max_segments:
                known.clear()
                new = run
            if new:
                known.update(zip(new, code(new), strict=True))
            out += map(known.__getitem__, run)
            if len(known) > self.max_segments:
                known.clear()
            else:
                for x in new:
                    if len(x) > MAX_SEGMENT_CHARS:
                        del known[x]
        return out

    def _ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and how many each has."""
        ends = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, 8 * words.offset)
        flat = np.frombuffer(words.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
        return self.transducer.encode_all(flat, np.diff(ends))

    def _words(self, new: list[str]) -> list[bytes]:
        ids, counts = self._ids(pa.array(new, pa.large_string()))
        return _parts(ids.astype("<u4").tobytes(), 4 * np.cumsum(counts))

    def _whole(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that aren't cut."""
        cut = [self.pieces(t) for t in texts]
        words = list({p for c in cut for p in c})
        ids = dict(zip(words, self._known(self.words, words, self._words)))
        return [b"".join(map(ids.__getitem__, c)) for c in cut]

    def _segments(self, new: list[str]) -> list[bytes]:
        """Ids of segments, each with the space before it. All are matched in one text, where that space begins a piece."""
        pieces = pa.array(self.pieces(" ".join(["", *new])), pa.large_string())
        coded = pieces.dictionary_encode()
        ids, counts = self._ids(coded.dictionary)
        which = coded.indices.to_numpy()
        after = np.cumsum(counts[which])
        starts = np.flatnonzero(pc.starts_with(pieces, " ").to_numpy(zero_copy_only=False))
        return _parts(_runs(ids, np.cumsum(counts), counts, which).astype("<u4").tobytes(), 4 * after[[*starts[1:] - 1, -1]])

    def _cut(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that are cut at their spaces. A segment's ids are looked up once, then put wherever it stands."""
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        ends = lists.offsets.to_numpy()
        first, last = ends[:-1], ends[1:] - 1
        inner = np.ones(len(lists.values), bool)
        inner[first] = inner[last] = False  # the first has no space before it, the last may be empty or end in a line end
        coded = lists.values.filter(pa.array(inner)).dictionary_encode()
        ids = self._known(self.segments, coded.dictionary.to_pylist(), self._segments)
        which = np.empty(len(inner), np.int64)
        which[inner] = coded.indices.to_numpy()
        which[last] = np.arange(len(ids), len(ids) + len(texts))
        which[first] = np.arange(len(texts)) + len(ids) + len(texts)
        ids += self._whole([" " + t.rpartition(" ")[2] if " " in t else "" for t in texts])
        ids += self._whole([t.partition(" ")[0] for t in texts])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat, stops = np.frombuffer(b"".join(ids), np.uint32), np.cumsum(sizes)
        joined = b"".join([_runs(flat, stops // 4, sizes // 4, which[k:k + RUN]).tobytes() for k in range(0, len(which), RUN)])
        return _parts(joined, np.cumsum(sizes[which])[last])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        odd = ["  " in t or "\n " in t or " \n" in t or self._ODD.search(t) is not None for t in texts]
        whole = iter(self._whole([t for t, o in zip(texts, odd) if o]))
        cut = iter(self._cut([t for t, o in zip(texts, odd) if not o]))
        return [next(whole if o else cut) for o in odd]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def forget(self) -> None:
        """Drop states and memos, also what was found out about tokens, and give their memory back; ranks and trie stay."""
        self.segments.clear()
        self.words.clear()
        self.transducer._reset()
        v = self.vocabulary
        for memo in (v._hope, v._apart, v._edges, v._parts):
            memo.clear()
        gc.collect()  # also empties Python's lists of spare tuples, which keep whole blocks of memory
        give_back()

    def decode(self, ids: Iterable[np.ndarray]) -> Iterator[str]:
        """Texts of a stream of id chunks, each as soon as its characters are whole."""
        machine, spelled = Utf8Machine(), self.spelled
        for chunk in ids:
            yield machine.feed(_runs(*spelled, chunk).tobytes())
        yield machine.feed(b"", last=True)


@lru_cache(maxsize=2)
def codec(path: str, pattern: str, memo: int = MAX_SEGMENTS) -> Codec:
    """The codec of a rank file (a base64 token and its rank a line); one per worker."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return Codec(ranks, pattern, memo)


def tokens(docs: DataFrame, path: str, pattern: str, ids: bool = False, memo: int = MAX_SEGMENTS, forget: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, array<int>) per row of docs (doc_id, text).

    path: a rank file that every executor has. memo: segments and words that a worker keeps the ids of; with ``forget`` it
    drops them and its states at the end of each task, for jobs whose other stages need the memory. Whole texts; null counts
    as empty, which has no ids and the digests of empty strings. Other columns are ignored; repeated rows give a row each; a null
    doc_id stays null; an empty table gives no rows. The second digest is of the ids decoded again.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern, memo)
        for b in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            with without_cycle_search():
                coded = c.encode_all([t or "" for t in b.column(1).to_pylist()])
                back = []
                for x in coded:
                    h, a = hashlib.sha256(), np.frombuffer(x, "<u4")
                    for part in c.decode(a[k:k + CHUNK_IDS] for k in range(0, len(a), CHUNK_IDS)):
                        h.update(part.encode())
                    back.append(h.hexdigest())
            cols = [b.column(0), pa.array([len(x) // 4 for x in coded], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in coded], pa.string()), pa.array(back, pa.string())]
            if ids:
                flat = np.frombuffer(b"".join(coded), "<i4")
                ends = np.cumsum([0, *(len(x) // 4 for x in coded)])
                cols.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names)
        if forget:
            c.forget()

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * ids]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(
        rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids)
