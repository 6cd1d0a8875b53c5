"""Driver queries of this subpackage: each applies its operator, with production settings, to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import (
    bpe_transducer, chunk_repeats, collocations, lang_zstd, lexical_search, line_rules, ngram_join, pair_index, pfair_mix,
    secret_scan, token_store, toxic_chain, vector_links)
from ledgerline.llm.common import read


def op1_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links.vector_links(read(spark, sf_dir, "embeddings"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_store.store(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_chunk_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_repeats.repeated_passages(read(spark, sf_dir, "documents"))


def op4_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    weights = pfair_mix.target_weights(docs)
    return pfair_mix.mix(docs, weights, weights.get(None, 1))


def op5_lang_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_zstd.languages(read(spark, sf_dir, "documents"))


def op6_toxic_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_chain.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.quality(read(spark, sf_dir, "documents"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(read(spark, sf_dir, "documents"))


def op9_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_transducer.tokens(read(spark, sf_dir, "documents"),
                                 public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(read(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12_pair_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pair_index.tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_vector_links": op1_vector_links,
    "op2_token_store": op2_token_store,
    "op3_chunk_repeats": op3_chunk_repeats,
    "op4_pfair_mix": op4_pfair_mix,
    "op5_lang_zstd": op5_lang_zstd,
    "op6_toxic_chain": op6_toxic_chain,
    "op7_line_rules": op7_line_rules,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_bpe_transducer": op9_bpe_transducer,
    "op10_secret_scan": op10_secret_scan,
    "op11_collocations": op11_collocations,
    "op12_pair_index": op12_pair_index,
    "op13_lexical_search": op13_lexical_search,
}
#: Where SQL can say it; the others are tested against the named libraries, brute force or held-out rows.
ORACLE: dict[str, str] = {
    "op1_vector_links": vector_links.ORACLE,
    "op3_chunk_repeats": chunk_repeats.ORACLE,
    "op7_line_rules": line_rules.ORACLE,
    "op8_ngram_jaccard": ngram_join.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op13_lexical_search": lexical_search.ORACLE,
}
