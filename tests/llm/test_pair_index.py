import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cases import no_docs, odd_docs, odd_rows, table
from ledgerline.llm import pair_index as X

PATH = P.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)
LIB.no_truncation()
LIB.no_padding()
CODEC = X.codec(PATH)
BITS = st.sampled_from(["a", "the", " ", "  ", "\n", " \n", "\t", "é", "'s", "'", "12", "日本", "\x1c", "!?", "　", "😀", "x'll", "\xa0", "\x85",
                        "<|endoftext|>", "<|endof", "aaaa", "՘", "\U0003134b", "​", "."])


def ids_of(text):
    return LIB.encode(text, add_special_tokens=False).ids


@settings(max_examples=600, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.lists(BITS, max_size=30).map("".join)), min_size=1, max_size=4))
def test_ids_and_text_are_the_librarys(texts):
    for text, got in zip(texts, CODEC.encode(texts)):
        ids = np.frombuffer(got, "<u4").tolist()
        assert ids == ids_of(text)
        assert CODEC.decode(got) == LIB.decode(ids, skip_special_tokens=False)


def test_names_of_added_tokens():
    assert np.frombuffer(CODEC.encode(["end <|endoftext|> here"])[0], "<u4").tolist() == [437, 220, 50256, 994]


@pytest.mark.parametrize("block", [0, 1])
def test_every_kind_of_character(block):
    """Every 64th code point, and those around the letters that only newer tables know."""
    points = [*range(block * 0x8000 % 0x110000, 0x110000, 64), *range(0x530, 0x600), *range(0x860, 0x8a0), *range(0x1c80, 0x1c90)]
    texts = [f"a{chr(c)}a 1{chr(c)}1 !{chr(c)}! {chr(c)} {chr(c)}" for c in points if not 0xD800 <= c < 0xE000]
    for text, got in zip(texts, CODEC.encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == ids_of(text), hex(ord(text[1]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1).map(lambda x: x % 50257), max_size=20))
def test_any_ids_decode_as_the_library_does(ids):
    assert CODEC.decode(np.array(ids, "<u4").tobytes()) == LIB.decode(ids, skip_special_tokens=False)


def plain_merges(piece, index):
    sym = [int(index.of_byte[b]) for b in piece]
    rank = {(int(a), int(b)): r for r, (a, b) in enumerate(zip(index.left, index.right))}
    while True:
        r, k = min(((rank.get(p, 1 << 60), k) for k, p in enumerate(zip(sym, sym[1:]))), default=(1 << 60, 0))
        if r == 1 << 60:
            return sym
        sym[k:k + 2] = [int(index.result[r])]


def test_the_index_merges_as_piece_by_piece():
    r = random.Random(5)
    pieces = [bytes(r.choice(b"aabe nth\xc3\xa9\x00") for _ in range(r.randint(0, 40))) for _ in range(800)]
    pieces += [b"a" * n for n in range(20)] + [b"ab" * n for n in range(20)] + [b""]
    got = CODEC.index.encode(pieces)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [plain_merges(p, CODEC.index) for p in pieces]


def test_small_bounds_change_nothing(monkeypatch):
    for name, value in (("INDEXED", 16), ("CUT", 20), ("MEMO_ONE", 4)):
        monkeypatch.setattr(X, name, value)
    small, r = X.Codec(PATH, memo_chars=30), random.Random(3)
    for _ in range(300):
        texts = ["".join(r.choice(["ab", "the", "ion", " ", "éa", ".", "\n", "  ", " a"]) for _ in range(r.randint(0, 90))) for _ in range(3)]
        assert [np.frombuffer(g, "<u4").tolist() for g in small.encode(texts)] == [ids_of(t) for t in texts]


def test_long_texts():
    for text in ("x" * 500_000, "no stop " * 400_000, "a1!" * 100_000, "\n" * 200_000, "日本" * 100_000):
        assert np.frombuffer(CODEC.encode([text])[0], "<u4").tolist() == ids_of(text)


def test_files_of_other_kinds_are_refused(tmp_path):
    import json

    file = json.load(open(PATH))
    byte = {c: bytes([b]) for b, c in X.byte_chars().items()}
    assert len(byte) == 256
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": None}, {"model": {**file["model"], "ignore_merges": True}}):
        to = tmp_path / "t.json"
        to.write_text(json.dumps({**file, **change}))
        with pytest.raises(ValueError):
            X.Codec(str(to))
    with pytest.raises(ValueError):  # a merge before the one that makes its part
        X.PairIndex({**{bytes([b]): b for b in range(256)}, b"ab": 256, b"abc": 257}, [(b"ab", b"c"), (b"a", b"b")])


@pytest.mark.parametrize("make", [lambda s: table(s, "documents"), odd_docs])
def test_tables(spark, make):
    d = make(spark)
    want = []
    for i, t in ((r["doc_id"], r["text"]) for r in d.select("doc_id", "text").collect()):
        ids = ids_of(t or "")
        back = LIB.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest(), ids, back))
    got = [tuple(r) for r in X.tokens(d, PATH, ids=True, decoded=True).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert X.tokens(no_docs(spark), PATH).collect() == []
    assert len(odd_rows()) > 0
