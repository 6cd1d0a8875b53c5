import numpy as np

from cases import docs, no_docs, odd_docs, odd_rows, table
from ledgerline.llm import toxic_chain as X

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    d, y = table(spark, "documents", sf), table(spark, "labels", sf)
    half = y.where("doc_id % 2 = 0")
    got = X.toxicity(d, half).join(y.where("doc_id % 2 = 1").withColumnRenamed("toxic", "truth"), "doc_id").toPandas()
    hit = (got.toxic & (got.truth == 1)).sum()
    # about 180 rows to learn from: few false alarms, and what the words seen so far can tell
    assert hit / got.toxic.sum() > 0.9 and hit / (got.truth == 1).sum() > 0.55


def test_one_row_a_document_and_the_same_each_time(spark):
    d, y = table(spark, "documents"), table(spark, "labels")
    a, b = (sorted(map(tuple, X.toxicity(d, y).collect())) for _ in range(2))
    assert a == b and len(a) == d.count()
    assert all(0 <= p <= 1 and 0 <= q <= 1 for _, p, q, _ in a)


def test_later_models_see_earlier_probabilities_out_of_fold():
    r = np.random.default_rng(0)
    n = 300
    first = r.integers(0, 2, n)
    texts = [b"alpha " * int(f) + b"w%d v%d" % (k, r.integers(0, 9)) for k, f in enumerate(first)]
    noise = r.integers(0, 2, n)  # can't be learned: out of fold it must not look learned
    c = X.Chain(texts, np.column_stack([first, noise, first]), np.arange(n) % X.FOLDS)
    assert ((c.out_of_fold[:, 0] > 0.5) == (first == 1)).all()
    assert ((c.out_of_fold[:, 1] > 0.5) == (noise == 1)).mean() < 0.65
    assert len(c.extra[0]) == 0 and len(c.extra[2]) == 2 and c.extra[2][0] > 0
    assert c.predict(b"alpha")[2] > 0.5 > c.predict(b"w1")[2]


def test_fit_reaches_the_minimum(monkeypatch):
    monkeypatch.setattr(X, "MIN_TIE", 0.0)
    r = np.random.default_rng(1)
    x = X._Rows([np.unique(r.integers(0, 12, 4)) for _ in range(200)], 12)
    extra, y = r.normal(size=(200, 1)), r.integers(0, 2, 200).astype(float)
    w, e, b = X.fit(x, extra, y, rounds=200)
    res = X._predict(x, extra, (w, e, b)) - y
    assert np.abs(x.back(res) + X.PENALTY * w).max() < 1e-2 and abs(res.sum()) < 1e-2


def test_odd_cases(spark):
    d = odd_docs(spark)
    y = spark.createDataFrame([(1, 1, 0), (6, 0, 1), (6, 1, 0), (3, None, 1), (None, 0, 1), (7, 0, 1), (99, 1, 1)], LABELS)
    assert X.toxicity(d, y).count() == len(odd_rows())
    none = spark.createDataFrame([], LABELS)
    got = X.toxicity(docs(spark, {1: "some words", 2: None}), none).collect()
    assert len(got) == 2 and not any(r["toxic"] for r in got) and all(r["p_toxic"] <= 0.5 for r in got)
    assert X.toxicity(no_docs(spark), y).collect() == []


def test_the_sample_is_one_row_a_document_and_its_words(spark, monkeypatch):
    from cases import prepare

    prepare(spark)
    texts = {1: "Mean words, mean WORDS. " * 50_000, 2: "kind words", 3: None}
    d = spark.createDataFrame([(k, t) for k, t in texts.items() for _ in range(1 if k == 1 else 400)] + [(1, "other row")], "doc_id long, text string")
    y = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (3, 0, 0), (2, 0, 0)], LABELS)
    got = {}
    monkeypatch.setattr(X, "Chain", lambda bags, y, folds: got.update(bags=bags, y=y))
    X.learn(d.repartition(5), y)
    assert len(got["bags"]) == 3 and sum(map(len, got["bags"])) < 60
    found = {frozenset(X.words(b)) for b in got["bags"]}
    assert found in [{frozenset(x), frozenset({b"kind", b"words"}), frozenset()} for x in ({b"mean", b"words"}, {b"other", b"row"})]
