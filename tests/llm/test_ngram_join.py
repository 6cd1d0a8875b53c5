import random

from cases import PROSE, docs, near_components, no_docs, odd_docs, odd_rows, shingle_set, table
from ledgerline.llm import ngram_join as N


def check(df, rows):
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in N.jaccard_components(df).collect()), key=str)
    of = near_components(rows)
    assert got == sorted(((i, len(shingle_set(t)), of.get(i)) for i, t in rows), key=str)


def test_whole_table_against_all_pairs(spark):
    d = table(spark, "documents")
    check(d, [tuple(r) for r in d.select("doc_id", "text").collect()])


def test_odd_cases(spark):
    check(odd_docs(spark), [r[:2] for r in odd_rows()])
    assert N.jaccard_components(no_docs(spark)).collect() == []


def test_chains_hot_lines_and_edges_of_the_threshold(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    line = " ".join(word() for _ in range(30))
    base = [word() for _ in range(104)]  # 100 shingles
    texts = {}
    for k in range(60):  # copies with a changed tail: each links with the next few only
        texts[k] = " ".join(base[k // 2:] + [word() for _ in range(k // 2)])
    for k in range(60, 90):  # short documents that share a long line
        texts[k] = line + " " + " ".join(word() for _ in range(r.randint(0, 12)))
    for k in range(90, 130):  # near copies in many orders of rare words
        w = list(base)
        w[r.randrange(100)] = word()
        texts[k] = " ".join(w)
    check(docs(spark, texts).repartition(5), list(texts.items()))


def test_one_of_each_keeps_the_smallest_id_and_all_columns(spark):
    d = odd_docs(spark)
    got = N.one_of_each(d)
    assert got.columns == d.columns
    of = near_components([r[:2] for r in odd_rows()])
    ids = sorted((r["doc_id"] for r in got.collect()), key=str)
    assert ids == sorted([*{c for c in of.values()}, None, None], key=str)
    assert [r["doc_id"] for r in N.one_of_each(docs(spark, {5: PROSE, 3: PROSE, 9: PROSE + " end"})).collect()] == [3]
