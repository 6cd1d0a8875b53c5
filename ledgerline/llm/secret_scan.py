"""Secret scan by one combined deterministic automaton over bytes.

Rule expressions are parsed to a nondeterministic automaton over byte classes, made deterministic by subset
construction, minimised by partition refinement and stored as one transition array (state x byte class) and
one array of rule sets per state. One pass over a batch's bytes moves all rules at once.

The pass is vectorised: a batch's texts, set apart by a byte that no rule reads, are cut into equal lanes that
step together. Lanes start in the start state; where a lane's predecessor ended in another state, the lane is
walked again from there until it meets its recorded states, so the result is that of one walk.

Where a rule's bit shows, a region is known: from behind the last place with the automaton in its start state up to
the end of the run of bits. Inside it the rule's expression gives the leftmost greedy match, exactly.
Matches that don't reach their rule's length are dropped but still use up their text, as in a scan with the expression.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import as_bytes, give_back

try:  # the standard library's expression parser
    from re import _constants as _rc
    from re import _parser as _rp
except ImportError:  # before Python 3.11
    import sre_constants as _rc
    import sre_parse as _rp


@dataclass(frozen=True)
class Rule:
    """kind: name in spans. scan: what the automaton looks for, ``find`` or, where failing matches are frequent and
    can't cover others (whole runs), its form with the least length. find: the exact expression. group, least:
    the group that must have so many characters. Least lengths of rules with a fixed lead stay out of
    the automaton: several counters that run together would multiply its states."""

    kind: str
    scan: str
    find: str
    group: int = 0
    least: int = 0


# fixed values of the three base rules
_ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
           r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
BASE = (
    Rule("assign", _ASSIGN, _ASSIGN, 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", r"[0-9a-f]+", 0, 16),
)
#: Spans that the method adds: private key heads, and tokens with a fixed lead.
ADDED = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[opsu]_[0-9A-Za-z]+", r"gh[opsu]_[0-9A-Za-z]+", 0, 36),
    Rule("chat", r"xox[abprs]-[0-9A-Za-z-]+", r"xox[abprs]-[0-9A-Za-z-]+", 0, 20),
)
RULES = BASE + ADDED
BREAK = 0xFF  # never in UTF-8 text
LANES, PIECE = 4096, 6 << 20


class _Nfa:
    """Thompson's construction. edges[s]: (256 bools, target); free[s]: targets without input."""

    def __init__(self) -> None:
        self.edges: list[list[tuple[np.ndarray, int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.free.append([])
        return len(self.edges) - 1

    def build(self, tree, s: int) -> int:
        for op, arg in tree:
            s = self._one(op, arg, s)
        return s

    def _one(self, op, arg, s: int) -> int:
        if op is _rc.LITERAL or op is _rc.IN:
            t = self.state()
            self.edges[s].append((_bytes_of(op, arg), t))
            return t
        if op is _rc.SUBPATTERN:
            return self.build(arg[3], s)
        if op is _rc.BRANCH:
            end = self.state()
            for way in arg[1]:
                start = self.state()
                self.free[s].append(start)
                self.free[self.build(way, start)].append(end)
            return end
        if op is _rc.MAX_REPEAT:
            least, most, body = arg
            for _ in range(least):
                s = self.build(body, s)
            if most is _rc.MAXREPEAT:
                loop = self.state()
                self.free[s].append(loop)
                self.free[self.build(body, loop)].append(loop)
                return loop
            end = self.state()
            self.free[s].append(end)
            for _ in range(most - least):
                s = self.build(body, s)
                self.free[s].append(end)
            return end
        raise ValueError(f"not supported in a rule: {op}")


def _bytes_of(op, arg) -> np.ndarray:
    hit = np.zeros(256, bool)
    for kind, v in [(op, arg)] if op is _rc.LITERAL else arg:
        if kind is _rc.LITERAL and v < 128:
            hit[v] = True
        elif kind is _rc.RANGE and v[1] < 128:
            hit[v[0]:v[1] + 1] = True
        else:
            raise ValueError(f"not supported in a rule: {kind} {v}")
    return hit


@dataclass(frozen=True)
class Automaton:
    classes: np.ndarray  # byte to class, uint8
    step: np.ndarray  # (state, class) to state, int32, flat
    width: int  # classes
    bits: np.ndarray  # state to the number of the set of rules that end there; 0: none
    ends: np.ndarray  # rule, number of a set: does it hold the rule?
    start: int


def _moore(step: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The minimal automaton: blocks of equal bits, split until equal blocks step to equal blocks."""
    block, n = np.unique(bits, return_inverse=True)[1].ravel(), 0
    while n != (n := int(block.max()) + 1) or n == 0:
        block = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)[1].ravel()
    first = np.unique(block, return_index=True)[1]
    return block[step[first]], bits[first], int(block[0])


def compile_rules(expressions: tuple[str, ...], most_states: int = 60_000) -> Automaton:
    """One minimal automaton that reads bytes and shows, after each, which expressions end there."""
    nfa = _Nfa()
    start = nfa.state()
    final: dict[int, int] = {}
    for r, text in enumerate(expressions):
        s = nfa.state()
        nfa.free[start].append(s)
        final[nfa.build(_rp.parse(text), s)] = 1 << r
    # byte classes: bytes that no edge tells apart
    masks = [m for e in nfa.edges for m, _ in e]
    table = np.array(masks) if masks else np.zeros((1, 256), bool)
    _, first, classes = np.unique(table, axis=1, return_index=True, return_inverse=True)
    classes, width = classes.ravel().astype(np.uint8), len(first)
    moves = [[(np.flatnonzero(m[first]), t) for m, t in e] for e in nfa.edges]

    @lru_cache(None)
    def closure(s: int) -> frozenset[int]:
        seen, todo = {s}, [s]
        while todo:
            for t in nfa.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(x for x in seen if nfa.edges[x] or x in final)

    always = closure(start)  # a match may begin anywhere
    sets, known, rows = [always], {always: 0}, []
    while len(rows) < len(sets):
        to: list[set[int]] = [set(always) for _ in range(width)]
        for s in sets[len(rows)]:
            for hit, t in moves[s]:
                for c in hit:
                    to[c] |= closure(t)
        row = []
        for x in map(frozenset, to):
            if x not in known:
                known[x] = len(sets)
                sets.append(x)
                if len(sets) > most_states:
                    raise ValueError(f"the rules need more than {most_states} states")
            row.append(known[x])
        rows.append(row)
    # sets of rules by number, so their count has no bound
    number: dict[int, int] = {0: 0}
    bits = np.array([number.setdefault(sum({final[s] for s in x if s in final}), len(number)) for x in sets], np.int32)
    ends = np.array([[m >> r & 1 for m in number] for r in range(len(expressions))], bool).reshape(len(expressions), -1)
    step, bits, begin = _moore(np.array(rows, np.int64), bits)
    return Automaton(classes, np.ascontiguousarray(step, np.int32).ravel(), width, bits, ends, begin)


@lru_cache(None)
def _compiled(rules: tuple[Rule, ...]) -> tuple[Automaton, tuple[re.Pattern, ...]]:
    return compile_rules(tuple(r.scan for r in rules)), tuple(re.compile(r.find.encode()) for r in rules)


def walk(a: Automaton, data: np.ndarray, lanes: int = LANES) -> np.ndarray:
    """The state after each byte."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int32)
    length = -(-n // min(lanes, n))
    wide = -(-n // length)
    cls = np.full(wide * length, a.classes[BREAK], np.uint8)
    cls[:n] = a.classes[data]
    cls = np.ascontiguousarray(cls.reshape(wide, length).T)
    out = np.empty((length, wide), np.int32)
    s = np.full(wide, a.start, np.int32)
    for j in range(length):
        s = a.step[s * a.width + cls[j]]
        out[j] = s
    # lanes whose predecessor didn't end in the state that they began with
    begin = np.full(wide, a.start, np.int32)
    while True:
        true = np.concatenate([[a.start], out[-1, :-1]]).astype(np.int32)
        wrong = np.flatnonzero(true != begin)
        if not len(wrong):
            return out.T.ravel()[:n]
        begin[wrong] = true[wrong]
        s = true[wrong]
        for j in range(length):
            s = a.step[s * a.width + cls[j, wrong]]
            differ = out[j, wrong] != s
            if not differ.any():
                break
            out[j, wrong] = s
            wrong, s = wrong[differ], s[differ]


def _spans(text: bytes, states: np.ndarray, a: Automaton, rules: tuple[Rule, ...],
           finds: tuple[re.Pattern, ...]) -> list[tuple[int, int, int]]:
    """(start, end, rule) in bytes, by start and then rule."""
    sets = a.bits[states]
    at_start = np.flatnonzero(states == a.start)
    out = []
    for r, (rule, find) in enumerate(zip(rules, finds)):
        hits = np.flatnonzero(a.ends[r][sets])
        if not len(hits):
            continue
        runs = np.flatnonzero(np.diff(hits, prepend=-2) != 1)
        used = 0
        for first, last in zip(hits[runs], hits[np.append(runs[1:], len(hits)) - 1]):
            k = np.searchsorted(at_start, first) - 1
            begin = max(used, int(at_start[k]) + 1 if k >= 0 else 0)
            for m in find.finditer(text, begin, int(last) + 1):
                used = m.end()
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    out.append((m.start(), m.end(), r))
    return sorted(out, key=lambda x: (x[0], x[2]))


def scan_texts(texts: list[bytes], rules: tuple[Rule, ...] = RULES) -> list[list[tuple[int, int, int]]]:
    """Per text its spans (start, end, index of the rule), in bytes, by start and then rule. Texts are read whole,
    a few megabytes of them at a time (one long text by itself)."""
    a, finds = _compiled(rules)
    out: list[list[tuple[int, int, int]]] = []
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto]) < PIECE):
            size += len(texts[upto]) + 1
            upto += 1
        data = np.frombuffer(bytes([BREAK]).join(texts[at:upto]), np.uint8)
        states = walk(a, data)
        ends = np.cumsum([len(t) + 1 for t in texts[at:upto]])
        found = np.unique(np.searchsorted(ends, np.flatnonzero(a.bits[states]), "right"))
        got: list[list[tuple[int, int, int]]] = [[] for _ in range(at, upto)]
        for k in found:
            t = texts[at + k]
            got[k] = _spans(t, states[ends[k] - 1 - len(t):ends[k] - 1], a, rules, finds)
        out += got
        at = upto
    return out


def _points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte spans as code points."""
    if not spans or text.isascii():
        return spans
    before = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [(int(before[s]), int(before[e]), r) for s, e, r in spans]


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_added per row of docs (doc_id, text; others ignored).

    spans: kind:start:end (code points, end exclusive) by start, then kind in the rules' order, comma-joined. Null
    counts as empty text, which has no spans (an empty string; base_sha256 is that of an empty string).
    Spans of different kinds may overlap. Repeated rows give a row each; a null doc_id stays null; an empty table gives no
    rows. Texts are scanned whole, some 25 bytes of memory a byte of the longest one.
    """
    n_base = len(BASE)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            counts, sha, spans = [], [], []
            for t, found in zip(texts, scan_texts(texts, rules)):
                named = [(f"{rules[r].kind}:{s}:{e}", r) for s, e, r in _points(t, found)]
                base = ",".join(x for x, r in named if r < n_base)
                counts.append([sum(r == k for _, r in named) for k in range(n_base)] + [
                    sum(r >= n_base for _, r in named)])
                sha.append(hashlib.sha256(base.encode()).hexdigest())
                spans.append(",".join(x for x, _ in named))
            c = np.array(counts, np.int64).reshape(-1, n_base + 1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c[:, k]) for k in range(n_base)], pa.array(sha, pa.string()),
                 pa.array(spans, pa.string()), pa.array(c[:, n_base])],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_added"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes("text").alias("text")).mapInArrow(
        rows, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long")


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[redacted]") -> DataFrame:
    """docs with every span replaced by ``mark`` (overlapping spans by one mark); n_chars follows, if docs has it.

    All rows and columns are kept; null texts stay null, empty ones empty; an empty table stays empty.
    """
    put = mark.encode()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(k).to_pylist()
            new = []
            for t, found in zip(texts, scan_texts([t or b"" for t in texts], rules)):
                if found:
                    parts, at = [], 0
                    for s, e, _ in found:
                        if s >= at:
                            parts += [t[at:s], put]
                        at = max(at, e)
                    t = b"".join([*parts, t[at:]])
                new.append(t)
            cols = b.columns
            cols[k] = pa.array(new, pa.binary())
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)
        give_back()

    k = docs.columns.index("text")
    d = docs.withColumn("text", F.col("text").cast("binary"))
    d = d.mapInArrow(rows, d.schema)
    done = d.withColumn("text", F.col("text").cast("string"))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(
            F.col("text").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType))
    return done
