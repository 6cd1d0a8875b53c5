import duckdb

from cases import PROSE, WORDS, docs, no_docs, odd_docs, odd_rows, table
from harness import compare, duck
from ledgerline.llm import line_rules as L

SF = "/root/testdata/sf0.001"


def base(text):
    words = WORDS.findall(text or "")
    windows = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    again = {w for w in windows if windows.count(w) > 1} if len(windows) < 500 else {
        w for w, n in __import__("collections").Counter(windows).items() if n > 1}
    marked = {k + j for k, w in enumerate(windows) if w in again for j in range(5)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(marked), len(words) < 10 or 100 * len(marked) > 20 * len(words))


def test_sql_gives_the_same(spark):
    out = compare(L.quality(table(spark, "documents")), L.ORACLE, duck(SF))
    assert out["ok"], out


def test_base_counts_by_brute_force(spark):
    rows = [tuple(r) for r in table(spark, "documents").select("doc_id", "text").collect()]
    got = {r["doc_id"]: tuple(r[c] for c in L.FIELDS[:6]) for r in L.quality(table(spark, "documents")).collect()}
    assert got == {i: base(t) for i, t in rows}


def test_odd_cases(spark):
    got = sorted((tuple(r[c] for c in ["doc_id", *L.FIELDS[:6]]) for r in L.quality(odd_docs(spark)).collect()), key=str)
    assert got == sorted(((i, *base(t)) for i, t, *_ in odd_rows()), key=str)
    assert L.quality(no_docs(spark)).collect() == [] and L.cleaned(no_docs(spark)).collect() == []


def test_lines_that_fail_are_removed_and_clean_text_stays(spark):
    def long(k):  # no words in common with other lines
        return " ".join(f"{w}{chr(97 + k)}" for w in "a plain sentence with some words of its own and an end".split()) + "."

    body = "\n".join(long(k) for k in range(20))
    texts = {1: body, 2: "Home | About | Contact\n" + body + "\nClick here to read more.\nAll rights reserved",
             3: "\n".join(["Home | Shop | Cart | Help"] * 3 + ["Menu", "Login"]) + "\n" + long(1),
             4: PROSE, 5: body.replace("\n", "\n\n")}
    d = docs(spark, texts).selectExpr("*", "'x' AS rules", "'y' AS rule_words")
    got = {r["doc_id"]: r for r in L.cleaned(d).collect()}
    assert sorted(got) == [1, 2, 4, 5]
    assert got[2]["text"] == body and got[2]["n_chars"] == len(body) and got[2]["rules"] == "x"
    assert all(got[i]["text"] == texts[i] for i in (1, 4, 5))


def test_no_python_in_the_plan(spark):
    plan = L.quality(table(spark, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_odd_line_ends_and_folded_letters_follow_the_sql(spark):
    """A stop before U+0085, U+2028 or U+2029 doesn't end a line; letters fold beyond ASCII (long s, Kelvin sign)."""
    lines = ["one two three.", "one two three.\u0085", "one two three.\u2028", "one two three.\u2029", "please \u017fign up now, all of you here.",
             "\u212aclic\u212a here", "clic\u212a here to go on with it.", "SIGN UP."]
    texts = {k: "\n".join(["The river ran past the old mill and the miller counted his sacks by the door."] * 2 + [x] * (1 + k // 8) + [str(k)])
             for k, x in enumerate(lines * 3)}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, 'en', 's', 0)", list(texts.items()))
    out = compare(L.quality(docs(spark, texts)), L.ORACLE, con)
    assert out["ok"], out
