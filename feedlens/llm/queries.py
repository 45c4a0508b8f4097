"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (alignment, attribution, bpe, byte_cnn, extraction, lsh_forest, merkle, packing, periodic_runs, pii, rp_forest,
               url_filter, warc)
from .common import table


def op1_bilstm_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.detect(docs, pii.fit(docs))


def op2_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"))


def op3_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_cnn.identify(table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.nearest(table(spark, sf_dir, "embeddings"))


def op6_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.token_counts(table(spark, sf_dir, "documents"),
                                    public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(table(spark, sf_dir, "documents"))


def op11_recompression_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(table(spark, sf_dir, "documents"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.fit())


def op13_spill_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (
    op1_bilstm_crf_pii, op2_lsh_forest, op3_byte_cnn, op4_byte_bpe, op5_rp_forest, op6_page_text, op7_token_counts, op8_warc, op9_packing, op10_merkle_fingerprints,
    op11_recompression_runs, op12_url_filter, op13_spill_alignment)}
SQL: dict[str, str] = {"op10_merkle_fingerprints": merkle.SQL}
