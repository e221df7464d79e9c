"""Log events as a stream: repeated events dropped, counted in windows with late data, run once per available batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def windowed_counts(events: DataFrame, time_column: str = "at", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, end, step, result, n) of ``events`` (id, step, result, at timestamp): distinct events per window; works on batches and streams."""
    timed = events.withColumn("at", F.col(time_column).cast("timestamp")).withWatermark("at", late)
    distinct = timed.dropDuplicatesWithinWatermark(["id"]) if events.isStreaming else timed.dropDuplicates(["id"])
    return distinct.groupBy(F.window("at", window).alias("w"), "step", "result").agg(F.count("*").alias("n")).select("w.start", "w.end", "step", "result", "n")


def run_once(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Every batch that is there now through ``handle`` and then the end; the checkpoint makes a rerun go on where it stopped."""
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
