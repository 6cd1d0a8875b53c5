import random
from collections import defaultdict

import numpy as np

from cases import WORDS, docs, no_docs, odd_docs, odd_rows, table
from ledgerline.llm import chunk_repeats as C


def passages(rows):
    """(doc_id, words, first holder) of every repeated passage."""
    holders = defaultdict(set)
    words = [(i, WORDS.findall(t or "")) for i, t in rows if i is not None]
    for i, w in words:
        for k in range(len(w) - C.WINDOW + 1):
            holders[tuple(w[k:k + C.WINDOW])].add(i)
    out = []
    for i, w in words:
        run = None
        for k in range(len(w) - C.WINDOW + 1):
            held = holders[tuple(w[k:k + C.WINDOW])]
            if len(held) > 1:
                if run and k - run[1] <= C.WINDOW:
                    run[1] = k
                else:
                    run = [k, k, min(held)]
                    out.append((i, run))
    return sorted((i, b - a + C.WINDOW, first) for i, (a, b, first) in out)


def found(df):
    return sorted((r["doc_id"], r["n_words"], r["first_doc_id"]) for r in C.repeated_passages(df).collect())


def test_whole_table_against_all_windows(spark):
    d = table(spark, "documents")
    rows = [tuple(r) for r in d.select("doc_id", "text").collect()]
    assert found(d) == passages(rows)
    text = dict(rows)
    for r in C.repeated_passages(d).collect():
        words = [WORDS.findall(text[i])[a:a + r["n_words"]] for i, a in [(r["doc_id"], r["first_word"])]][0]
        first = WORDS.findall(text[r["first_doc_id"]])
        assert len(words) == r["n_words"] and r["repeats"] == (r["doc_id"] != r["first_doc_id"])
        assert any(first[k:k + C.WINDOW] == words[:C.WINDOW] for k in range(len(first)))


def test_planted_passages_and_clean_documents(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, line = prose(120), prose(12)
    texts = {k: f"{prose(r.randint(0, 200))} {line}\n{prose(80)}" for k in range(30)}
    for k in range(30, 60):  # at any offset, behind insertions
        texts[k] = f"{prose(r.randint(0, 300))} {passage} {prose(r.randint(0, 100))}"
    d = docs(spark, texts).repartition(4)
    assert {i for i, *_ in found(d)} == set(range(30, 60))
    assert found(d) == passages(list(texts.items()))


def test_odd_cases(spark):
    assert found(odd_docs(spark)) == passages([r[:2] for r in odd_rows()])
    assert C.repeated_passages(no_docs(spark)).collect() == []


def test_chunks_cover_a_text_and_resist_shifts():
    r = np.random.default_rng(5)
    body = bytes(r.integers(97, 123, 20_000, dtype=np.uint8))
    ends = set(C.chunk_ends(np.frombuffer(body, np.uint8)).tolist())
    shifted = set((C.chunk_ends(np.frombuffer(b"inserted " + body, np.uint8)) - 9).tolist())
    assert len(ends) > 400 and len({e for e in ends if e > 40} - shifted) <= 1
    doc, start, length, digest = C.chunks([b"", body, b"a" * 9000, b"x"])
    assert length.max() <= C.MOST and (length >= C.SHORT).all() and set(doc) == {1, 2}


def test_copies_that_differ_in_white_space(spark):
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(3, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    texts = {}
    for k in range(0, 80, 4):
        w = prose(60).split(" ")
        wide = "\n".join(" ".join(w[a:a + 4]) for a in range(0, 60, 4))
        for j, copy in enumerate([" ".join(w), wide, "\t".join(w), "  ".join(w[:30]) + " \r\n\r\n " + "\r\n".join(w[30:])]):
            texts[k + j] = f"{prose(r.randint(5, 90))}{' ' * r.randint(1, 3)}{copy}\n{prose(r.randint(5, 90))}"
    want = passages(list(texts.items()))
    assert {i for i, *_ in want} == set(texts)
    assert found(docs(spark, texts).repartition(4)) == want


def test_passages_of_short_words_and_short_periods(spark):
    r = random.Random(17)
    kinds = [lambda: r.choice("0123456789"), lambda: r.choice("日本語文字列"), lambda: "".join(r.choices("ab1", k=2)),
             lambda: "".join(r.choices("abcde", k=3)), lambda: "same"]
    prose = lambda n: " ".join("".join(r.choices("abcdefghij", k=r.randint(2, 8))) for _ in range(n))
    texts = {}
    for word in kinds:
        for size in (50, 51) * 12:
            passage = " ".join(word() for _ in range(size))
            for _ in range(2):
                texts[len(texts)] = f"{prose(r.randint(0, 90))} {passage}\n{prose(r.randint(0, 90))}"
    period = " ".join(["ab", "c"] * 40)
    for k in range(5):
        texts[len(texts)] = f"{prose(k)} {period} {prose(20)}"
    want = passages(list(texts.items()))
    assert {i for i, *_ in want} == set(texts)
    assert found(docs(spark, texts).repartition(4)) == want


def test_any_window_holds_a_chunk_of_its_own():
    r = random.Random(23)
    for letters in ("a", "ab", "0123456789", "abcdefghijklmnopqrstuvwxyz"):
        for _ in range(100):
            window = " ".join(r.choice(letters) for _ in range(C.WINDOW)).encode()
            other = lambda: bytes(r.choices(range(97, 123), k=r.randint(0, 150)))
            a, b, alone = other() + b" " + window + b" " + other(), other() + b" " + window, window
            digests = [set(C.chunks([t])[3].tolist()) for t in (a, b, alone)]
            assert digests[2] and digests[2] <= digests[0] & digests[1]
