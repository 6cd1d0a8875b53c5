import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cases import no_docs, odd_docs, table
from ledgerline.llm import token_store as T
from ledgerline.llm.common import scratch

PATH = P.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)
LIB.encode_special_tokens = True


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 5), st.sampled_from([1, 2, 60, 50_257, 2**32]), st.integers(0, 2**31), st.floats(0.0, 1.0))
def test_blocks_round_trip(n, high, seed, percentile):
    r = np.random.default_rng(seed)
    a = r.integers(0, high, n * T.BLOCK, dtype=np.uint64)
    a[r.integers(0, len(a), 4)] = high - 1
    a = a.astype(np.uint32)
    data, sizes = T.pack(a, percentile)
    assert (T.unpack(np.frombuffer(data, np.uint8), np.cumsum(sizes) - sizes) == a).all()


def test_outliers_go_to_the_exception_list_and_not_into_the_width():
    a = np.full(T.BLOCK, 1000, np.uint32)
    a[5], a[77] = 4_000_000_000, 900_000
    a[::2] += 3
    data, sizes = T.pack(a)
    assert data[4] == 2 and data[5] == 2 and len(data) == sizes[0] == 6 + 16 * 2 + 5 * 2
    assert (T.unpack(np.frombuffer(data, np.uint8), np.array([0])) == a).all()


def test_a_file_reads_any_range_and_its_documents():
    r = np.random.default_rng(1)
    docs = [(i if i % 5 else None, r.integers(0, 50_000, n).astype(np.uint32))
            for i, n in enumerate([0, 1, 300, 128, 5, 70_000, 0, 2_000])]
    sink = pa.BufferOutputStream()
    w = T.TokenWriter(sink)
    for i, ids in docs:
        w.add(i, ids)
    n = w.close()
    f = T.TokenFile(pa.BufferReader(sink.getvalue()))
    flat = np.concatenate([ids for _, ids in docs])
    assert n == f.n == len(flat)
    for a, b in ((0, n), (0, 0), (127, 129), (5000, 5001), (n - 1, n)):
        assert (f.read(a, b) == flat[a:b]).all()
    got = []
    for k, ends, ids in f.documents():
        got += [(int(f.doc_ids[k + j]) if f.has_id[k + j] else None, ids[s:e].tolist())
                for j, (s, e) in enumerate(zip([0, *ends[:-1]], ends))]
    assert got == [(i, ids.tolist()) for i, ids in docs]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.lists(st.sampled_from(
    ["a", " ", "  ", "\n", " \n", "é", "'s", "12", "日本", "\x1c", "!", "<|endoftext|>", "　", "x'll", "word"]), max_size=25)
    .map("".join)), max_size=6))
def test_cut_texts_have_the_librarys_ids(texts):
    got = T.encoder(PATH).encode(texts)
    assert [a.tolist() for a in got] == [e.ids for e in LIB.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("make", [lambda s: table(s, "documents"), odd_docs])
def test_tables(spark, make):
    d = make(spark)
    rows = sorted(((r["doc_id"], r["text"]) for r in d.select("doc_id", "text").collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, at = [], 0
    for i, t in rows:
        ids = np.array([*LIB.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = sorted((tuple(r) for r in T.store(d, PATH).collect()), key=lambda r: r[1])
    assert got == want


def test_empty_table_and_a_second_reading(spark):
    assert T.store(no_docs(spark), PATH).collect() == []
    folder = scratch(spark, "test-ids")
    manifest = T.write(table(spark, "documents"), PATH, folder)
    once, again = (sorted(map(tuple, T.read_back(spark, manifest, folder).collect()), key=str) for _ in range(2))
    assert once == again and len(once) == 200


NAMED = Tokenizer.from_file(PATH)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", " ", "word", "\n", "<|endoftext|>", "<|endof", "é"]), max_size=12).map("".join), max_size=5))
def test_names_of_added_tokens_are_the_librarys_ids(texts):
    got = T.encoder(PATH, True).encode(texts)
    assert [a.tolist() for a in got] == [e.ids for e in NAMED.encode_batch(texts, add_special_tokens=False)]


def test_a_stored_name_is_one_id(spark):
    from cases import docs

    d = docs(spark, {1: "end <|endoftext|> here", 2: "plain"})
    want = np.array([437, 220, 50256, 994, 0], "<u4")
    row = T.store(d, PATH).where("doc_id = 1").first()
    assert (row["n_tokens"], row["ids_crc32"]) == (5, zlib.crc32(want.tobytes()))
