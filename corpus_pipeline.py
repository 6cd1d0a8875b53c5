"""The corpus pipeline: quality rules, near duplicates, secrets, mixture, tokens.

STAGES are (name, function) pairs; each function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import bpe_transducer, line_rules, ngram_join, pfair_mix, secret_scan
from ledgerline.llm.common import prepare, materialise, read

RANKS = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; failing lines of the others go. A null or empty text has under ten words and goes. Repeated rows
    are judged each by itself, whole, however long; extra columns stay; an empty table stays empty."""
    return line_rules.cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the smallest doc_id, of rows that share it the one with the
    smallest text. Documents without words or without doc_id link with nothing and stay; extra columns stay; an empty table
    stays empty."""
    prepare(spark)
    return ngram_join.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets are replaced by a mark; overlapping ones by one. Every row stays, null texts stay null, long texts are read
    whole; extra columns stay; an empty table stays empty."""
    prepare(spark)
    return secret_scan.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the mix, sources by equal weights. Every row stays; a null source is a source of its own; rows
    without doc_id tie and may change places with each other; extra columns stay; an empty table stays empty."""
    return pfair_mix.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the text decoded from them. A null text counts as empty and has
    no ids; repeated rows give a row each, a null doc_id stays null; an empty table gives no rows."""
    prepare(spark)
    # a smaller memo than op9's, dropped after each task: workers go on to other stages, and keep what those left
    return bpe_transducer.tokens(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, ids=True, memo=80_000, forget=True)


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("secrets", secrets),
          ("mixture", mixture), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each stage but the last is written to the shared checkpoint folder."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs, f"pipeline-{k}")
    return docs


#: The near-duplicate and token stages have no form in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None
