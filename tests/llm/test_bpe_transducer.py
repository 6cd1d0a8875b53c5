import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import no_docs, odd_docs, odd_rows, table
from ledgerline.llm import bpe_transducer as B

PATH = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
LIB = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODEC = B.codec(PATH, P.PATTERN)
BITS = st.sampled_from(["a", "the", " ", "  ", "\n", " \n", "\t", "é", "'s", "'", "12", "日本", "\x1c", "!?", "　", "😀", "x'll",
                        "\xa0", "<|endoftext|>"])


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(BITS, max_size=30).map("".join)))
def test_ids_are_the_librarys_and_decode_to_the_text(text):
    ids = np.frombuffer(CODEC.encode(text), "<u4")
    assert ids.tolist() == LIB.encode_ordinary(text)
    assert "".join(CODEC.decode(ids[k:k + 2] for k in range(0, len(ids), 2))) == text


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.binary(max_size=40), st.lists(st.sampled_from([b"a", b"aa", b"th", b"e ", b"\xc3", b"in"]), max_size=30)
                 .map(b"".join)))
def test_pieces_of_any_bytes(piece):
    if piece:
        assert CODEC.transducer.encode(piece) == LIB._core_bpe.encode_single_piece(piece)


def test_bounded_states_and_memos_change_nothing():
    r = random.Random(1)
    small = B.Codec(RANKS, P.PATTERN, max_segments=5)
    small.transducer.max_states = 20
    for _ in range(300):
        t = "".join(r.choice(["ab", "the", "ion", " ", "éa", "."]) for _ in range(20))
        assert np.frombuffer(small.encode(t), "<u4").tolist() == LIB.encode_ordinary(t)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from([b"A", b"\xc3", b"\xa9", b"\xe2", b"\x82", b"\xac", b"\xf0", b"\x9f", b"\x98", b"\x80", b"\xed", b"\xa0",
                                 b"\xff", b"\xc0", b"\xe0", b"\xf4", b"\x90"]), max_size=14), st.integers(1, 4))
def test_utf8_in_any_cuts(parts, step):
    data, m, out = b"".join(parts), B.Utf8Machine(), ""
    for k in range(0, len(data), step):
        out += m.feed(data[k:k + step])
    assert out + m.feed(b"", last=True) == data.decode("utf-8", "replace")


def test_a_vocabulary_needs_every_byte():
    with pytest.raises(ValueError):
        B.Vocabulary({b"a": 0})


@pytest.mark.parametrize("make", [lambda s: table(s, "documents"), odd_docs])
def test_tables(spark, make):
    d = make(spark)
    want = []
    for i, t in ((r["doc_id"], r["text"]) for r in d.select("doc_id", "text").collect()):
        ids = LIB.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest(), ids))
    got = [tuple(r) for r in B.tokens(d, PATH, P.PATTERN, ids=True).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert B.tokens(no_docs(spark), PATH, P.PATTERN).collect() == []
    assert len(odd_rows()) > 0


def test_a_codec_that_forgets_goes_on_as_before(spark):
    c = B.Codec(RANKS, P.PATTERN)
    for text in ("the river ran past the old mill", "é 12 日本", ""):
        want = LIB.encode_ordinary(text)
        assert np.frombuffer(c.encode(text), "<u4").tolist() == want
        c.forget()
        assert not c.words and not c.segments and len(c.transducer.keys) == 1 and not c.vocabulary._apart
        assert np.frombuffer(c.encode(text), "<u4").tolist() == want
    d = odd_docs(spark)
    keep, drop = (sorted(map(str, B.tokens(d, PATH, P.PATTERN, ids=True, forget=f).collect())) for f in (False, True))
    assert keep == drop


def test_a_worker_keeps_nothing_of_a_task_but_the_vocabulary():
    c = B.Codec(B.codec(PATH, P.PATTERN).vocabulary.ranks, P.PATTERN, 100)
    text = "Some words, and other words; über 12345 naïve  spaces."
    ids = c.encode(text)
    v = c.vocabulary
    assert v._edges and v._parts and c.transducer.steps
    c.forget()
    assert not any((v._hope, v._apart, v._edges, v._parts, c.segments, c.words, c.transducer.steps))
    assert c.encode(text) == ids == B.codec(PATH, P.PATTERN).encode(text)


def test_tokens_of_long_batches_come_in_short_ones(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(B, "ROWS", 3)
    df = spark.createDataFrame([(k, f"text {k}") for k in range(10)], "doc_id long, text string")
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, kind: f)
    f = B.tokens(df, PATH, P.PATTERN, ids=True, memo=100)
    for b in f([pa.RecordBatch.from_pydict({"doc_id": list(range(10)), "text": [f"text {k}" for k in range(10)]})]):
        sizes.append(b.num_rows)
    assert sizes == [3, 3, 3, 1]


def _words(n, seed=3):
    r = random.Random(seed)
    bits = ["th", "ion", "e", "é", "日", "qu", "zz", "ing", "o", "s'll", "1", "ß"]
    return ["".join(r.choice(bits) for _ in range(r.randint(1, 9))) for _ in range(n)]


def test_new_words_of_a_batch_are_read_side_by_side(monkeypatch):
    turns, alone = [], []
    get, read = B.Steps.get, B.Transducer._read
    monkeypatch.setattr(B.Steps, "get", lambda self, keys: turns.append(len(keys)) or get(self, keys))
    monkeypatch.setattr(B.Transducer, "_read", lambda self, piece, state: alone.append(piece) or read(self, piece, state))
    c, words = B.Codec(RANKS, P.PATTERN), _words(4000)
    texts = [" ".join(words[k:k + 40]) for k in range(0, 4000, 40)]
    for text, ids in zip(texts, c.encode_all(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == LIB.encode_ordinary(text)
    # a turn or two for each byte of the longest word, for inner, last and first segments; few words are left at its end
    assert len(turns) <= 6 * max(len(w.encode()) + 1 for w in words) and sum(turns) > 10_000
    assert len(alone) < 3 * B.FEW


@pytest.mark.parametrize("few", [1, 7, 10**9])
@pytest.mark.parametrize("max_states", [15, 300, 10**6])
def test_texts_together_are_coded_as_each_alone(monkeypatch, few, max_states):
    monkeypatch.setattr(B, "FEW", few)
    monkeypatch.setattr(B, "RUN", 50)
    r, words = random.Random(few + max_states), _words(600)
    c = B.Codec(RANKS, P.PATTERN, max_segments=40)
    c.transducer.max_states = max_states
    gaps = [" ", " ", " ", "\n", ", ", "\n\n", "!? "]
    texts = ["", " ", "\n", "a\n", "a \n", " a", "a ", "x" * 300, "日本" * 100, "a  b", "\ta b", "ab" * 700 + "." * 90 + " 日" * 40]
    texts += ["".join(x for _ in range(r.randint(1, 30)) for x in (r.choice(words), r.choice(gaps))) for _ in range(60)]
    r.shuffle(texts)
    for text, ids in zip(texts, c.encode_all(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == LIB.encode_ordinary(text), text
        assert "".join(c.decode([np.frombuffer(ids, "<u4")])) == text
    assert c.encode_all([]) == []


def test_states_stay_bounded_within_a_long_piece():
    c = B.Codec(RANKS, P.PATTERN)
    c.transducer.max_states = 50
    piece = "".join(_words(2000)).encode()
    assert c.transducer.encode(piece) == LIB._core_bpe.encode_single_piece(piece)
    assert c.transducer.built > 1000 and len(c.transducer.keys) <= 51
