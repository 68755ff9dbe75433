"""One query for each operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import brown_lm, compression_classifier, html_extraction, merge_dropout, packing, quality_rules, record_output, simhash, suffix_dedup, transport_stream
from .common import table


def tokenizer_path(name: str) -> str:
    return public_tokenizers.path(name)


def op1_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest_with_passages(table(spark, sf_dir, "documents"))


def op3_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_dropout.digest(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_transport_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transport_stream.digest(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op7_record_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_output.output(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=0)


def op8_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.score(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.check_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=2)


QUERIES = {f.__name__: f for f in (op1_compression_classifier, op2_suffix_array_dedup, op3_merge_dropout, op4_simhash_near_dedup, op5_transport_stream, op6_html_extraction, op7_record_output, op8_brown_lm, op9_quality_rules, op10_hilbert_packing)}
ORACLE_SQL: dict[str, str] = {}
