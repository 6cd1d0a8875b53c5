from cases import docs, no_docs, odd_docs, odd_rows, table
from ledgerline.llm import lang_zstd as L


def test_held_out_accuracy(spark):
    d = table(spark, "documents", "/root/testdata/sf0.01")
    got = L.languages(d).join(d.select("doc_id", "lang", "n_chars"), "doc_id").toPandas()
    assert len(got) == d.count() and got.score.between(0, 1).all()
    held = got[got.held_out]
    assert 0.2 < len(held) / len(got) < 0.3
    assert (held.lang == held.lang_pred).mean() > 0.95
    assert (held.lang == held.lang_pred)[~held.rejected].mean() > 0.96


def test_held_out_labels_are_never_read(spark):
    d = table(spark, "documents")
    other = d.withColumn("lang", L.F.when(L.held_out(), "zz").otherwise(L.F.col("lang")))
    a, b = (sorted(map(tuple, L.languages(x).collect())) for x in (d, other))
    assert a == b


def test_no_letter_is_und_and_odd_cases(spark):
    d = odd_docs(spark).unionByName(odd_docs(spark).selectExpr(
        "doc_id + 1000 AS doc_id", "'ein Satz mit Worten und der Fluss an dem Haus' AS text", "'de' AS lang", "source", "n_chars",
        *odd_docs(spark).columns[5:]))
    got = {(r["doc_id"], r["lang_pred"]) for r in L.languages(d).where("doc_id < 1000").collect()}
    for i, text, *_ in odd_rows():
        if i is not None:
            assert ((i, "und") in got) == (not text or not any(c.isalpha() for c in text)), (i, text)
    assert len(L.languages(d).collect()) == 2 * len(odd_rows())
    assert L.languages(no_docs(spark)).collect() == []


def test_nothing_to_learn_from(spark):
    d = docs(spark, {1: "some text", 2: None}).withColumn("lang", L.F.lit(None).cast("string"))
    assert sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in L.languages(d).collect()) == [(1, "und", 0.0), (2, "und", 0.0)]


def test_samples_come_from_any_place_of_a_text(spark):
    header = "this page was sent to you by the keeper of the list and holds the same notice as every other page. "
    body = "".join(f"wort{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)} " for k in range(2000))
    for head, rest in ((header * 60, body), (header * 12, body[:2000])):  # longer and shorter than what the driver gets
        d = docs(spark, {k: head + rest for k in range(600)}).withColumn("lang", L.F.lit("de"))
        got = L.learn(d)["de"]
        assert got.count(b"wort") > 0.1 * len(got) / 8 and got.count(b"keeper") > 0
        assert len(got) <= L.DICT_BYTES and got == L.learn(d)["de"]
