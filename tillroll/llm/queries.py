"""Registered queries of the corpus operators: the operator over its whole
table, with the digest columns of the query contract."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat, clusters, decontaminate, exact_dedup, jaccard_join, language, neighbours, pii, secrets,
               toxicity, urls, whitening)
from .common import table

#: The public vocabulary of op4 and of the pipeline's last stage.
VOCABULARY = "byte_bpe_50k.json"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents (doc_id set) and all web pages (page_id set)."""
    records = language.documents_evidence(table(spark, sf_dir, "documents")).withColumn(
        "id", F.struct(F.col("id").alias("doc_id"), F.lit(None).cast("long").alias("page_id")))
    pages = language.pages_evidence(table(spark, sf_dir, "pages")).withColumn(
        "id", F.struct(F.lit(None).cast("long").alias("doc_id"), F.col("id").alias("page_id")))
    return language.identify(records.unionByName(pages)).select("id.*", "*").drop("id")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.inertia(table(spark, sf_dir, "embeddings"))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % neighbours.EVERY == 0)


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_secrets, op3_chat, op4_bpe, op5_toxicity, op6_jaccard_join, op7_url_filter, op8_exact_dedup, op9_pii, op10_decontaminate,
    op11_whitening, op12_clusters, op13_neighbours)}

ORACLE_SQL = {
    "op2_secrets": secrets.SQL, "op3_chat": chat.SQL, "op7_url_filter": urls.SQL, "op8_exact_dedup": exact_dedup.SQL,
    "op12_clusters": clusters.SQL,
}
