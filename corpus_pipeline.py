"""The corpus pipeline: stages over ``documents``, each written and read again.

Each stage takes the documents that its predecessor kept, with their columns;
the last returns token digests of the mixed documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirespark.llm import line_dedup, minhash, mixing, pieces, quality_model
from quirespark.llm.common import checkpoint

#: No SQL: stages train models and segment by a vocabulary file.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly trained scorer keeps."""
    return quality_model.classify(docs).filter("kept").select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat earlier ones; n_chars follows the text."""
    out = line_dedup.dedup(docs)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8)."""
    return minhash.dedup(docs, minhash.PRODUCTION).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the curriculum, one row for each pass they are taken in."""
    return mixing.passes(docs).select(docs.columns)


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and the digests of the ids of every document taken."""
    # under the name of an output, so that workers are sent each text once
    texts = docs.select("doc_id", "source", F.col("text").alias("decoded"))
    return pieces.digests(pieces.encode_decode(texts, pieces.model_path(), text="decoded"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("sentencepiece", sentencepiece_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = checkpoint(docs)
    return docs
