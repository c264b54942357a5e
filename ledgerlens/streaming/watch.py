"""Structured Streaming: a watched folder of operations, and windowed counts of events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.operators.prepare import keep_first


def watch_folder(spark: SparkSession, folder: str, schema, checkpoint: str, publish: Callable[[DataFrame, int], None], key: str = "JobfileNumber", order: str = "load_seq") -> StreamingQuery:
    """Processes the Parquet files that arrive in ``folder`` and stops when there are no more (run it again for new ones).

    Each batch keeps the first row of each key by ``order`` and goes to ``publish``, which should merge by key and be
    idempotent in the batch's number: a batch may be delivered again after a failure.
    """

    def each(batch: DataFrame, number: int) -> None:
        publish(keep_first(batch, [key], [order]), number)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(folder)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Events and their value per hour and type; works on a stream (rows later than ``late`` are dropped there) and on a table."""
    if events.isStreaming:
        events = events.withWatermark("ts", late)
    per = events.groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"))
    return per.select(F.col("window.start").alias("window_start"), "event_type", "n")
