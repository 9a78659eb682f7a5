"""Registered queries of passages, packing, language-model scores and quality ranks.

None has a SQL twin: their results come from tokenizers, fitted models, or packings. Tests hold
them against brute force, round trips and held-out accuracy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlens.llm import packing, pairwise_quality, passages, ppm
from orbitlens.llm.queries_native import table


def fold(n: int) -> Column:
    """crc32 of the doc_id as text, modulo n."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % n


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op2_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learnt from the labels of the documents that are not held out."""
    described = pairwise_quality.describe(documents(spark, sf_dir))
    labels = table(spark, sf_dir, "labels").where(fold(5) != 0)
    ranker = pairwise_quality.fit(described, labels)
    return pairwise_quality.score(described, ranker).select(
        "doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted")


def op3_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(documents(spark, sf_dir), fold(10) == 0)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op7_id_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_matrices(documents(spark, sf_dir))


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_words"), 256).alias("kept_sha256"))


QUERIES = {
    "op2_quality_rank": op2_quality_rank, "op3_ppm": op3_ppm, "op4_packing": op4_packing,
    "op7_id_matrices": op7_id_matrices, "op10_passages": op10_passages,
}
