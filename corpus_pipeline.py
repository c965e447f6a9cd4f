"""Corpus pipeline: the stages a training corpus goes through, in order.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor
kept and returns a DataFrame with the columns of ``documents`` (the last one
returns the tokens).  ``run`` writes each stage's result as Parquet in the
shared folder and reads it back as the next stage's input, so that a lost
executor costs one stage's tasks at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import bpe, decontaminate, exact_dedup, jaccard_join, language
from tillroll.llm.common import scratch_folder, table
from tillroll.llm.queries import VOCABULARY


#: Rows sent to a Python worker at a time.  Texts are long: at Spark's default of 10,000 rows a
#: batch takes tens of MB several times over, outside the executor's heap.
BATCH_ROWS = 1024


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that are in none of the corpus's languages."""
    _small_batches(spark)
    return language.drop_unknown(docs)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each normalised text, the one with the largest doc_id."""
    return exact_dedup.drop_duplicates(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, the smallest doc_id."""
    _small_batches(spark)
    return jaccard_join.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that repeat a passage of the benchmark."""
    _small_batches(spark)
    return decontaminate.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def tokenize_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids and the digests of ids and decoded text."""
    _small_batches(spark)
    return bpe.tokens(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("language ID", language_stage),
    ("exact dedup", exact_dedup_stage),
    ("n-gram Jaccard join", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("BPE", tokenize_stage),
]

#: Language ID, banded alignment and BPE cannot be told in SQL; tests/llm holds
#: the pipeline against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_folder(spark, "corpus")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
