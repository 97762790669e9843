"""Broker topics as streams and tables.

Needs the Spark Kafka connector on the class path (``spark-sql-kafka-0-10``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Properties that are not passed on. Spark refuses the offset rule (it has
# startingOffsets), the group is replaced by the checkpoint, and the topics are arguments of ours.
NOT_PASSED = ("auto.offset.reset", "group.id", "read-topic", "write-topic")


def client_options(properties: Mapping[str, str]) -> dict[str, str]:
    """Client properties under the prefix Spark hands through to the Kafka client."""
    return {f"kafka.{k}": str(v) for k, v in properties.items() if k not in NOT_PASSED}


def reader_options(
    topic: str, properties: Mapping[str, str], starting: str = "earliest", max_offsets: int | None = None
) -> dict[str, str]:
    """Options of a topic reader.

    ``starting`` only counts while the query has no checkpoint: a query started with the checkpoint
    folder of an earlier run resumes where that run stopped, one with a new folder replays the topic.
    ``max_offsets`` bounds a micro-batch, which keeps the first batch of a replay in proportion.
    """
    if "bootstrap.servers" not in properties:
        raise ValueError("properties need bootstrap.servers")
    options = {**client_options(properties), "subscribe": topic, "startingOffsets": starting}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def writer_options(topic: str, properties: Mapping[str, str]) -> dict[str, str]:
    if "bootstrap.servers" not in properties:
        raise ValueError("properties need bootstrap.servers")
    return {**client_options(properties), "topic": topic}


def _messages(raw: DataFrame) -> DataFrame:
    return raw.selectExpr("CAST(value AS STRING) AS value", "timestamp")


def read_topic_stream(
    spark: SparkSession,
    topic: str,
    properties: Mapping[str, str],
    starting: str = "earliest",
    max_offsets: int | None = None,
) -> DataFrame:
    """A topic as a stream of message texts and record times."""
    options = reader_options(topic, properties, starting, max_offsets)
    return _messages(spark.readStream.format("kafka").options(**options).load())


def read_topic(spark: SparkSession, topic: str, properties: Mapping[str, str]) -> DataFrame:
    """All a topic holds now, as a table."""
    return _messages(spark.read.format("kafka").options(**reader_options(topic, properties)).load())
