"""Event time and watermarks.

How Spark's watermark differs from a per-element one: it moves once per micro-batch, as the maximum
event time seen over all partitions minus the delay, and late rows are filtered with the watermark
of the batch before. Rows are therefore dropped later, never earlier, than a strict per-element rule
on one partition would; with several unevenly read partitions a zero delay can drop rows that
a per-partition watermark would keep, so real runs should allow some delay.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def has_watermark(rows: DataFrame, time: str) -> bool:
    """Whether a stream's column carries a watermark, which Spark notes in the column's metadata."""
    return rows.isStreaming and "spark.watermarkDelayMs" in rows.schema[time].metadata


def with_watermark(rows: DataFrame, time: str, delay: timedelta) -> DataFrame:
    """Bound lateness on a stream; a batch, or a stream bounded already, is returned as it is.

    Watermarks only take zoned timestamps, so a zoneless column is cast first.
    """
    if not rows.isStreaming or has_watermark(rows, time):
        return rows
    if isinstance(rows.schema[time].dataType, T.TimestampNTZType):
        rows = rows.withColumn(time, F.col(f"`{time}`").cast("timestamp"))
    return rows.withWatermark(time, f"{delay // timedelta(milliseconds=1)} milliseconds")


def payload_time(rows: DataFrame, epoch_seconds: str = "timestamp", name: str = "mytimestamp") -> DataFrame:
    """Event time from a field of the message that counts seconds since the epoch."""
    seconds = F.col(f"`{epoch_seconds}`").try_cast("bigint")
    return rows.withColumn(name, F.timestamp_seconds(seconds))


def record_time(rows: DataFrame, record: str = "timestamp", name: str = "mytimestamp") -> DataFrame:
    """Event time from the time the broker stamped on the message."""
    return rows.withColumn(name, F.col(f"`{record}`"))
