"""Streams around the batch operators: incremental ingestion and counts over event time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def deliveries(spark: SparkSession, path: str, schema: str, late: str = "30 days", key: str = "key", time: str = "loaded_at") -> DataFrame:
    """A stream of a folder's deliveries with each key once within the watermark, so that the state
    doesn't grow with the stream."""
    rows = spark.readStream.schema(schema).parquet(path)
    rows = rows.withColumn(time, F.col(time).cast("timestamp"))
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def ingest(stream: DataFrame, apply: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Applies a batch operator to what has arrived and appends its result, one folder for each batch;
    a batch that is done again after a failure overwrites its own folder, so rows come once."""
    def write(df: DataFrame, number: int) -> None:
        apply(df).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tumbling(events: DataFrame, size: str = "1 hour", late: str = "1 day", slide: str | None = None) -> DataFrame:
    """Events (ts, event_type) counted by window and type, for streams and batches alike."""
    w = F.window(F.col("ts").cast("timestamp"), size, slide) if slide else F.window(F.col("ts").cast("timestamp"), size)
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    rows = rows.withWatermark("ts", late) if rows.isStreaming else rows
    return rows.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """Sessions of users: session_start, user_id and the number of events."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    rows = rows.withWatermark("ts", late) if rows.isStreaming else rows
    return rows.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select(F.col("w.start").alias("session_start"), "user_id", "n")
