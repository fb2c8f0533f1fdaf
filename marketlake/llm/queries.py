"""Registered queries of the subpackage: thin digests over the operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marketlake.llm import (decontamination, exact_topk, jaccard_join, language_id, nn_descent,
                            packing, quality_fm, secret_scan, spelling_variants, suffix_dedup,
                            token_alignment, token_counts, toxicity)
from marketlake.llm.common import documents, tune
from marketlake.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)
    QUERIES[fn.__name__] = run
    return run


@query
def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.quality_scores(documents(spark, sf_dir, "doc_id", "text", "n_chars"),
                                     read_table(spark, sf_dir, "labels"))


@query
def op2_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@query
def op3_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(documents(spark, sf_dir),
                                    read_table(spark, sf_dir, "labels"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir),
                                     public_tokenizers.path("piece_bpe_32k.model"))


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(documents(spark, sf_dir))


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(documents(spark, sf_dir),
                                         read_table(spark, sf_dir, "benchmark"))


@query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(documents(spark, sf_dir))


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_languages(documents(spark, sf_dir, "doc_id", "text", "lang"))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokens(documents(spark, sf_dir),
                                        public_tokenizers.path("byte_bpe_50k.json"),
                                        public_tokenizers.path("piece_bpe_32k.model"))


@query
def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.exact_top_k(read_table(spark, sf_dir, "embeddings"))


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(documents(spark, sf_dir))


ORACLE["op2_nn_descent"] = nn_descent.ORACLE
ORACLE["op5_secret_scan"] = secret_scan.ORACLE
ORACLE["op6_decontamination"] = decontamination.ORACLE
ORACLE["op7_jaccard_join"] = jaccard_join.ORACLE
ORACLE["op8_suffix_dedup"] = suffix_dedup.ORACLE
ORACLE["op12_exact_topk"] = exact_topk.ORACLE
ORACLE["op13_spelling_variants"] = spelling_variants.ORACLE
