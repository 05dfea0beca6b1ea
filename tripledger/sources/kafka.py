"""Kafka readers and writers. Needs the public spark-sql-kafka package on the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def source_options(
    servers: str,
    topics: Sequence[str],
    *,
    starting: str = "earliest",
    group_prefix: str | None = None,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of one subscription to all topics. `starting` is 'earliest' or 'latest'."""
    if starting not in ("earliest", "latest"):
        raise ValueError("starting is 'earliest' or 'latest'")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }
    if group_prefix:
        options["groupIdPrefix"] = group_prefix
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def since_options(servers: str, topics: Sequence[str], millis: str) -> dict[str, str]:
    """Options of a batch read of what has reached the topics since a time, headers included."""
    return {
        "kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingTimestamp": millis,
        "startingOffsetsByTimestampStrategy": "latest", "includeHeaders": "true",
    }


def _messages(records: DataFrame) -> DataFrame:
    return records.select(
        "topic", F.col("value").cast("string").alias("value"), F.col("timestamp").alias("arrival")
    )


def read_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Message text, topic and arrival time, as a stream."""
    return _messages(spark.readStream.format("kafka").options(**options).load())


def read_batch(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The same for what the topics hold now."""
    bounded = {k: v for k, v in options.items() if k != "maxOffsetsPerTrigger"}
    return _messages(spark.read.format("kafka").options(**bounded).load())


def write_stream(payload: DataFrame, servers: str, checkpoint: str, trigger: str):
    """Stream of (topic, key, value) rows to the topics they name."""
    return (
        payload.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=trigger)
        .start()
    )


def write_batch(payload: DataFrame, servers: str) -> None:
    payload.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
