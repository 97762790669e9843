"""Recorded messages in files, read as a table or as a stream with the shape of a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.schemas import MESSAGE


def read_recorded(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    schema: T.StructType = MESSAGE,
    files_per_batch: int | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """A Parquet recording. ``pattern`` keeps the files of ``path`` whose names match it."""
    reader = (spark.readStream if stream else spark.read).schema(schema).format("parquet")
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def read_lines(
    spark: SparkSession, path: str, stream: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """Text files with one JSON message per line.

    Lines carry no broker time, so the record time is the time in the payload's epoch seconds.
    """
    reader = (spark.readStream if stream else spark.read).format("text")
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    seconds = F.get_json_object("value", "$.timestamp").try_cast("bigint")
    return reader.load(path).select("value", F.timestamp_seconds(seconds).alias("timestamp"))
