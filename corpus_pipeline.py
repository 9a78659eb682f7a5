"""A training corpus from raw documents: quality rules, near-dedup, passage removal, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes each result as Parquet to the
shared folder and reads it back as the next stage's documents. All stages but the last keep the columns of
``documents``. Rows are removed by decisions only: every stage works on all rows it gets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlens.llm import decontaminate, near_dups, packing, passages, quality_rules
from orbitlens.session import materialize

#: passages of this many words or more are removed where they repeat
PASSAGE_WORDS = 50


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8."""
    return near_dups.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id holds are cut out; a text cut to nothing stays as an empty one."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("others")
    cut = passages.remove_repeats(docs.select("doc_id", "text", others), PASSAGE_WORDS)
    done = F.col("n_removed") > 0
    own = F.col("others")["n_chars"]
    new = {"text": F.when(done, F.col("cut_text")).otherwise(F.col("text")),
           "n_chars": F.when(done, F.length("cut_text").cast(docs.schema["n_chars"].dataType)).otherwise(own)}
    return cut.select(*[new.get(c, F.col("others")[c]).alias(c) for c in docs.columns])


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", clean_of_benchmark),
    ("packing", packed),
]

#: near duplicates, packing and tokens are not SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
