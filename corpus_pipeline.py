"""The corpus pipeline: quality rules, quality classifier, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next one's docs. All but the last return the columns of documents. What a task holds in memory is kept small,
so that eight tasks in a heap of 1 GB do.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenmap.llm import compression_classifier, packing, quality_rules, simhash, suffix_dedup
from lumenmap.llm.common import cut, for_texts, small_buffers, table

TOKENIZER = "word_bpe_49k.json"


#: The repeated-passage stage: strings of so many bytes, and stretches of at least so many words ("over 50 words").
PASSAGE_BYTES, PASSAGE_GAP, PASSAGE_WORDS = 200, 80, 51


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base limits or the n-gram classifier reject go.

    A null or empty text has no words and goes; repeated rows are judged each for itself; other columns, whatever
    their names, stay as they are; an empty table gives an empty one.
    """
    small_buffers(spark)
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality_rules.verdict_column(model).getField("kept"))


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of under 0.3 go.

    The model is fitted on the whole documents table: of docs, the first stage has rejected most of label 0.
    Nulls, repeated rows, clashing names and empty tables as in the first stage; an empty text has a score too.
    """
    small_buffers(spark)
    model = compression_classifier.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.where(compression_classifier.score_column(model) >= 0.3)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the least id stays; see simhash.keep_one for odd rows."""
    for_texts(spark)
    small_buffers(spark)
    return simhash.keep_one(docs)


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words that occur elsewhere go; n_chars follows the text.

    A passage is a stretch that repeated strings of 200 bytes cover: 51 words with their spaces have as many bytes
    in the languages at hand. Null texts stay null; see suffix_dedup.without_repeats for other odd rows.
    """
    for_texts(spark)
    small_buffers(spark)
    got = suffix_dedup.without_repeats(docs, length=PASSAGE_BYTES, gap=PASSAGE_GAP, least_words=PASSAGE_WORDS)
    return got.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else got


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4,096 tokens along the Hilbert curve; a null text has its end id alone, an empty table no pieces."""
    for_texts(spark)
    small_buffers(spark)
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality rules", quality_rules_stage),
    ("quality classifier", quality_classifier_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("suffix-array dedup", repeated_passage_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Learnt models and tokenizers can't be said in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None
