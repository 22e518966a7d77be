"""Streams, run over the files that are there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..streaming import ingest


def st_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.to_table(ingest.latest_stage(ingest.events(spark, sf_dir)))


def st_stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An addition of ours: tumbling counts."""
    return ingest.to_table(ingest.stage_counts(ingest.events(spark, sf_dir)))


def st_incremental_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events taken up by two runs, of which the second finds nothing new."""
    folder = ingest.shared_folder(spark)
    ingest.append_once(ingest.events(spark, sf_dir), folder)
    return ingest.append_once(ingest.events(spark, sf_dir), folder).select("event_id", "user_id", "event_type")


CATALOG = {
    "st_latest_state": (st_latest_state, "SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, max(ts) AS ts FROM events GROUP BY user_id"),
    "st_stage_counts": (st_stage_counts, "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2"),
    "st_incremental_files": (st_incremental_files, "SELECT event_id, user_id, event_type FROM events"),
}
