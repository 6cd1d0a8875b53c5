"""Small tables with the odd cases that every operator has to take."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm.common import prepare

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside, as a caller's own columns.
CLASHES = {"component_id": "'mine'", "n_words": "'mine'", "rules": "1", "rule_text": "2", "place": "3", "position": "4",
           "mix_hash": "5", "marked_id": "6", "id": "7", "h": "8", "n": "9", "spans": "10", "score": "11"}

PROSE = ("The river ran past the old mill and the miller counted his sacks by the door every evening. "
         "Nobody else in the valley had seen the water so high before the first snow of that year.")


def odd_rows() -> list[tuple]:
    """Null and empty texts, no words, one word, ties, repeated rows, very long texts, null ids and columns."""
    texts = [(1, PROSE), (2, PROSE), (3, None), (4, ""), (5, " \n\t \n"), (6, "word"), (7, "Word"), (8, "é"),
             (9, "a b c d"), (10, "A  b\nc d"), (11, "12345 !!! ..."), (12, "日本語 のテキスト。 😀😀"),
             (13, "x" * 70_000), (14, (PROSE + "\n") * 400), (15, PROSE + " token: abcdefgh12345678"), (16, PROSE),
             (16, PROSE), (17, "no end\n" * 30), (18, "one\x00two \x1c three"), (None, PROSE), (None, None)]
    return [(i, t, None if k % 5 == 0 else ("en", "de")[k % 2], None if k % 7 == 3 else f"s{k % 3}",
             None if t is None else len(t)) for k, (i, t) in enumerate(texts)]


def odd_docs(spark: SparkSession, clashes: bool = True) -> DataFrame:
    prepare(spark)
    d = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)
    return d.selectExpr("*", *[f"{v} AS {k}" for k, v in CLASHES.items()]) if clashes else d


def no_docs(spark: SparkSession) -> DataFrame:
    prepare(spark)
    return spark.createDataFrame([], SCHEMA)


def docs(spark: SparkSession, texts: dict[int, str | None]) -> DataFrame:
    prepare(spark)
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in texts.items()], SCHEMA)


def table(spark: SparkSession, name: str, sf: str = SF) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingle_set(text: str | None) -> set[tuple[str, ...]]:
    w = WORDS.findall(lower(text or ""))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def smallest_reachable(nodes, links) -> dict:
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_components(rows) -> dict[int, int]:
    """Brute force over (doc_id, text): component of each doc_id."""
    sets = [(i, s) for i, t in rows if i is not None and (s := shingle_set(t))]
    links = []
    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            both = len(x & y) if 100 * min(len(x), len(y)) >= 80 * max(len(x), len(y)) else 0
            if both and 100 * both >= 80 * (len(x) + len(y) - both):
                links.append((a, b))
    return smallest_reachable({i for i, _ in rows if i is not None}, links)
