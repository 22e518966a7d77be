"""Streams of stage events and of new files.

The library keeps a resumable state for each source: the latest stage. As a
stream this is an aggregation by key; new files are taken up once, as the file
source and its checkpoint remember what has been seen.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def events(spark: SparkSession, folder: str, pattern: str = "events*.parquet", files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def latest_stage(stream: DataFrame, key: str = "user_id") -> DataFrame:
    """The last stage of each key by event time; state is one row a key."""
    at = F.struct("ts", "event_id")
    return stream.groupBy(key).agg(F.max_by("event_type", at).alias("event_type"), F.max(at).alias("__at")).select(key, "event_type", F.col("__at.ts").alias("ts"))


def stage_counts(stream: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events by stage in tumbling windows; rows later than ``late`` are left out."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def ingest_once(stream: DataFrame, checkpoint: str, process: Callable[[DataFrame, int], None]) -> None:
    """Run ``process`` on what has arrived since the last run, then stop.

    A batch that fails is given again, with its number, on the next run.
    """
    query = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, or below a temporary one where Spark runs on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="quirespark-stream-")
    return f"{root}/stream-{uuid.uuid4().hex}"


def to_table(stream: DataFrame, folder: str | None = None) -> DataFrame:
    """The complete result of a stream over what is there now, as a table in ``folder``.

    Each batch replaces the table, so that the state never passes the driver and a
    batch that is run again does no harm.
    """
    spark = stream.sparkSession
    folder = folder or shared_folder(spark)

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/table")

    query = stream.writeStream.outputMode("complete").foreachBatch(put).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/table")


def append_once(stream: DataFrame, folder: str) -> DataFrame:
    """Add what has arrived since the last run to the table in ``folder``; a batch that is run again replaces itself."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/table/batch={number}")

    ingest_once(stream, f"{folder}/checkpoint", put)
    return stream.sparkSession.read.parquet(f"{folder}/table").drop("batch")


class Progress(StreamingQueryListener):
    """Calls ``report(name, batch, rows)`` after every batch of a stream."""

    def __init__(self, report: Callable[[str | None, int, int], None]):
        self.report = report

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.report(event.progress.name, event.progress.batchId, event.progress.numInputRows)

    def onQueryTerminated(self, event) -> None:
        pass
