"""Hourly error counts as a stream (M9).

The reference polls its logs every hour for errors. Here the events (or
parsed log lines) are a streaming source; an event-time window with a
watermark counts errors per hour, and state older than the watermark is
dropped. Each micro-batch's updated windows are written under their batch
id (an idempotent overwrite, so a retried batch is harmless); a reader takes
the latest count per window. With ``once_by`` rows that repeat within the
watermark (a log file delivered twice) count once; ``late_rows`` tells how many
rows came after the watermark and were left out. Checkpoints and output live in the shared
folder, so a lost executor or driver restart resumes from the last batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

WINDOW = "1 hour"
WATERMARK = "2 hours"


def hourly_error_counts(events: DataFrame, ts: str = "ts", kind: str = "event_type",
                        error_value: str = "error") -> DataFrame:
    """The batch twin: errors per event-time hour."""
    return events.where(F.col(kind) == error_value) \
        .groupBy(F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz").alias("window_start")) \
        .agg(F.count(F.lit(1)).alias("n_errors"))


def _count_and_write(errors: DataFrame, ts: str, out_path: str, checkpoint: str, window: str, watermark: str,
                     available_now: bool, once_by: Sequence[str] = ()):
    """Count error rows per event-time window into one folder per batch,
    which a retried batch overwrites; returns the StreamingQuery."""
    # watermarks need a session-zone timestamp, not timestamp_ntz
    timed = errors.select(F.col(ts).cast("timestamp").alias("event_time"), *once_by) \
        .withWatermark("event_time", watermark)
    if once_by:
        timed = timed.dropDuplicatesWithinWatermark(["event_time", *once_by])
    counted = timed \
        .groupBy(F.window("event_time", window).alias("w")) \
        .agg(F.count(F.lit(1)).alias("n_errors")) \
        .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "n_errors")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    writer = counted.writeStream.outputMode("update").foreachBatch(write_batch) \
        .option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def error_count_stream(spark: SparkSession, source: str, schema, out_path: str, checkpoint: str,
                       ts: str = "ts", kind: str = "event_type", error_value: str = "error",
                       glob: str | None = None, window: str = WINDOW, watermark: str = WATERMARK,
                       available_now: bool = True):
    """Start the streaming count; returns the StreamingQuery."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    errors = reader.parquet(source).where(F.col(kind) == error_value)
    return _count_and_write(errors, ts, out_path, checkpoint, window, watermark, available_now)


def read_error_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """The latest count of every window written by the stream."""
    rows = spark.read.parquet(out_path)
    return rows.groupBy("window_start").agg(F.max_by("n_errors", "batch_id").alias("n_errors"))


def log_error_stream(spark: SparkSession, log_dir: str, out_path: str, checkpoint: str,
                     window: str = WINDOW, watermark: str = WATERMARK, available_now: bool = True, once: bool = False):
    """M9 over raw log files: new text files in ``log_dir`` are parsed (the
    timestamp in the first 19 characters, the error words) and error lines
    are counted per event-time hour, as ``error_count_stream`` does. With
    ``once`` equal lines (the time is part of a line) count once."""
    from quarry.operators.monitor import parse_log

    lines = parse_log(spark.readStream.text(log_dir))
    errors = lines.where(F.col("is_error") & F.col("ts").isNotNull())
    return _count_and_write(errors, "ts", out_path, checkpoint, window, watermark, available_now, ["line"] if once else ())


def late_rows(query) -> int:
    """Rows that a query's batches left out as older than the watermark, as far
    as its progress is kept (``spark.sql.streaming.numRecentProgressUpdates``)."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])
