"""The queries of this folder and their SQL, for ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, html_extract, line_dedup, media, minhash, mixing, pieces, quality_model, quality_rules, secrets
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_model.classify(docs).select("doc_id", "votes", "posterior", "score", "kept")


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digest(table(spark, sf_dir, "documents"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_format(table(spark, sf_dir, "conversations"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.digests(pieces.encode_decode(docs, pieces.model_path()).drop("text"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.link(table(spark, sf_dir, "documents"), minhash.CONTRACT)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.page_texts(table(spark, sf_dir, "pages"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.decisions(table(spark, sf_dir, "documents").select("doc_id", "text"), short=True)


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.withColumn("position_2", F.get("positions", F.lit(1))).drop("positions")


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_quality_classifier, op2_media_columns, op3_chat_formatting, op4_sentencepiece, op5_minhash_near_dedup, op6_quality_rules, op7_html_extraction, op8_line_dedup, op9_secret_scans, op10_mixing)}
ORACLE_SQL: dict[str, str] = {"op3_chat_formatting": chat.ORACLE, "op5_minhash_near_dedup": minhash.ORACLE, "op10_mixing": mixing.ORACLE}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
