"""Line-first cleaning with quality rules, in DataFrame functions only.

Every line is tried by itself against punctuation, navigation and boilerplate rules; failing lines are removed,
and a document that loses too much of its text is rejected. Before that a document must hold against the base
rules on its whole text (enough words, few repeated five-word windows).

Nothing is shuffled: a row's lines and words stay arrays in that row, and each helper array is bound once
(``_let``), so no lambda computes it again for each element.

- punctuation: the line doesn't end like a sentence (a closing mark, also before quotes and brackets) and has
  fewer than ``short_line`` words, or under half of its visible characters are letters, marks or digits.
- navigation: at least two menu separators (``SEPARATORS``), one or more for every five words.
- boilerplate: a phrase of ``BOILERPLATE`` in a line under ``boilerplate_line`` words.

Lines without a word fail nothing and count for nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import fresh

# fixed values of the word definition: ASCII white space, and the symbols that are counted
SPACE = " \t\n\u000b\f\r"
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

SEPARATORS = "|»›•·→"
ENDS = r"[.!?…。！？:;]['\"”’»)\]]*[\x20\x09-\x0D]*\z"  # \z: nothing behind, as $ means in the SQL; Java's $ also stops before a last line end
BOILERPLATE = (
    r"(?iu)(cookie (policy|settings|preferences)|(uses|accept( all)?) cookies|privacy policy|terms of (use|service)"
    r"|all rights reserved|enable javascript|javascript is (disabled|required)|skip to (main )?content"
    r"|click here|read more|sign (in|up)|log in|subscribe (now|to our)|back to top|share (this|on)"
    r"|follow us|add to cart|lorem ipsum)")


@dataclass(frozen=True)
class Rules:
    min_words: int = 10
    max_repeated_percent: int = 20
    short_line: int = 10
    boilerplate_line: int = 30
    max_lost_percent: int = 30


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once for the row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def _repeated_words(words: Column) -> Column:
    """Words inside five-word windows that occur twice or more.

    Window hashes that are all distinct prove that no window occurs twice; otherwise the windows
    themselves are compared, sorted."""

    def starts(w: Column) -> Column:
        return F.slice(w, 1, F.size(w) - (WINDOW - 1))

    def marked(w: Column) -> Column:
        windows = F.transform(starts(w), lambda x, i: F.struct(
            F.array_join(F.slice(w, i + 1, WINDOW), " ").alias("k"), i.alias("i")))
        again = _let(F.sort_array(windows), lambda s: F.filter(s, lambda x, j: (
            F.coalesce(F.get(s, j - 1)["k"] == x["k"], F.lit(False))
            | F.coalesce(F.get(s, j + 1)["k"] == x["k"], F.lit(False)))))
        places = F.sort_array(F.transform(again, lambda x: x["i"]))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
        return F.aggregate(places, start, lambda acc, p: F.struct(
            (acc["n"] + p + WINDOW - F.greatest(acc["end"], p)).cast("long").alias("n"),
            (p + WINDOW).alias("end")), lambda acc: acc["n"])

    def count(w: Column) -> Column:
        hashes = _let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.transform(
            starts(h), lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)])))
        distinct = _let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
        return F.when(F.size(w) <= WINDOW, F.lit(0).cast("long")).when(distinct, F.lit(0).cast("long")).otherwise(
            marked(w))

    return _let(words, count)


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def line_fails(line: Column, n: Column, rules: Rules) -> Column:
    """Does a line with n words, at least one, fail a rule?"""
    bare = _without(line, SPACE)
    separators = F.length(line) - F.length(_without(line, SEPARATORS))
    return (F.when((n < rules.short_line) & ~line.rlike(ENDS), True)
            .when((n < rules.boilerplate_line) & line.rlike(BOILERPLATE), True)
            .when(_let(separators, lambda k: (k >= 2) & (k * 5 >= n)), True)
            .when(F.length(F.regexp_replace(bare, r"[\p{L}\p{M}\p{N}]+", "")) * 2 > F.length(bare), True)
            .otherwise(False))


def with_rules(docs: DataFrame, rules: Rules = Rules()) -> tuple[DataFrame, str]:
    """docs with one more column, a struct of all counts and verdicts, and that column's name.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed, kept (boolean), n_lines,
    n_failed_lines, lost_chars (long; characters of failing lines), clean_text (string: the text without
    failing lines). A null text counts as none: all counts 0, base_failed, clean_text null.
    """
    t0, w0, l0, *counts, out = fresh(docs, "rule_text", "rule_words", "rule_lines", "rule_n", "rule_repeat", "rule_dup",
                                     "rule_parts", "rules")
    n0, r0, d0, p0 = map(F.col, counts)
    t, w, lines = F.col(t0), F.col(w0), F.col(l0)

    def tried(line: Column) -> Column:
        return _let(F.size(words_of(line)), lambda n: F.struct(
            line.alias("line"), (n > 0).alias("words"),
            F.when(n > 0, line_fails(line, n, rules)).otherwise(False).alias("fails")))

    def chars(which: str) -> Column:
        return F.aggregate(lines, F.lit(0).cast("long"),
                           lambda a, x: F.when(x[which], a + F.length(x["line"])).otherwise(a))

    def repeats(a: Column) -> Column:
        return F.size(a) - F.size(F.array_distinct(a))

    d = docs.withColumn(t0, F.coalesce(docs["text"].cast("string"), F.lit("")))
    d = d.withColumns({w0: words_of(t), l0: F.transform(F.split(t, "\n"), tried)})
    # columns of their own, so that each is computed once
    d = d.withColumns({
        counts[0]: F.size(w).cast("long"), counts[1]: _repeated_words(w),
        counts[2]: _let(F.transform(F.filter(lines, lambda x: x["words"]), lambda x: x["line"]), repeats).cast("long"),
        counts[3]: F.struct(chars("fails").alias("lost"), chars("words").alias("all"))})
    failed = (n0 < rules.min_words) | (100 * r0 > rules.max_repeated_percent * n0)
    verdict = F.struct(
        n0.alias("n_words"), F.length(_without(t, SPACE)).cast("long").alias("word_chars"),
        (F.length(t) - F.length(_without(t, SYMBOLS))).cast("long").alias("n_symbols"),
        d0.alias("n_dup_lines"), r0.alias("n_repeat_words"), failed.alias("base_failed"),
        (~failed & (100 * p0["lost"] <= rules.max_lost_percent * p0["all"])).alias("kept"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.filter(lines, lambda x: x["fails"])).cast("long").alias("n_failed_lines"),
        p0["lost"].alias("lost_chars"),
        F.when(docs["text"].isNotNull(), F.array_join(F.transform(
            F.filter(lines, lambda x: ~x["fails"]), lambda x: x["line"]), "\n")).alias("clean_text"))
    return d.withColumn(out, verdict).drop(t0, w0, l0, *counts), out


FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def quality(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Counts and verdicts per row of docs (doc_id and text; other columns are ignored): doc_id, ``FIELDS``,
    n_lines, n_failed_lines, lost_chars.

    Rows that repeat give a row each; ties don't arise; a null doc_id stays null; an empty table gives no rows.
    """
    d, c = with_rules(docs.select("doc_id", "text"), rules)
    return d.select("doc_id", *[F.col(c)[f].alias(f) for f in [*FIELDS, "n_lines", "n_failed_lines", "lost_chars"]])


def cleaned(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """docs without rejected documents (null, empty ones among them), and without the failing lines of those that stay (n_chars follows, if
    docs has it). All columns are kept."""
    d, c = with_rules(docs, rules)
    kept, = fresh(d, "rules_kept")
    # a generator, not a filter: a filter on the verdict would be pushed down and computed a second time
    d = d.select("*", F.explode(F.filter(F.array(F.col(c)), lambda x: x["kept"])).alias(kept))
    new = F.col(kept)["clean_text"]
    put = {"text": new}
    if "n_chars" in docs.columns:
        put["n_chars"] = F.length(new).cast(docs.schema["n_chars"].dataType)
    return d.withColumns(put).select(*docs.columns)


#: DuckDB SQL for ``quality`` with the settings above.
ORACLE = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         coalesce(text, '') AS t
  FROM documents),
win AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS k,
         unnest(range(1, len(w) - 3)) AS i
  FROM w WHERE len(w) >= 5),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS m FROM win) WHERE m > 1),
marked AS (
  SELECT doc_id, count(*) AS n_repeat_words
  FROM (SELECT DISTINCT doc_id, i + j AS place FROM again, range(0, 5) AS r(j)) GROUP BY doc_id),
lines AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w),
tried AS (
  SELECT doc_id, line, regexp_matches(line, '[^\x20\x09-\x0D]') AS has,
         len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n,
         length(line) - length(translate(line, '|»›•·→', '')) AS seps,
         translate(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS bare
  FROM lines),
failing AS (
  SELECT *, has AND (
      (NOT regexp_matches(line, '[.!?…。！？:;][''"”’»)\]]*[\x20\x09-\x0D]*$') AND n < 10)
      OR (seps >= 2 AND seps * 5 >= n)
      OR (n < 30 AND regexp_matches(line, '(?i)(cookie (policy|settings|preferences)|(uses|accept( all)?) cookies|privacy policy|terms of (use|service)|all rights reserved|enable javascript|javascript is (disabled|required)|skip to (main )?content|click here|read more|sign (in|up)|log in|subscribe (now|to our)|back to top|share (this|on)|follow us|add to cart|lorem ipsum)'))
      OR length(regexp_replace(bare, '[\p{L}\p{M}\p{N}]', '', 'g')) * 2 > length(bare)) AS fails
  FROM tried),
per AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE fails) AS n_failed_lines,
         count(*) FILTER (WHERE has) - count(DISTINCT line) FILTER (WHERE has) AS n_dup_lines,
         coalesce(sum(length(line)) FILTER (WHERE fails), 0)::BIGINT AS lost_chars,
         coalesce(sum(length(line)) FILTER (WHERE has), 0)::BIGINT AS all_chars
  FROM failing GROUP BY doc_id),
counted AS (
  SELECT w.doc_id, len(w)::BIGINT AS n_words,
         length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, n_lines, n_failed_lines, lost_chars, all_chars
  FROM w JOIN per ON per.doc_id = w.doc_id LEFT JOIN marked ON marked.doc_id = w.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * lost_chars <= 30 * all_chars AS kept,
       n_lines, n_failed_lines, lost_chars
FROM counted
"""
