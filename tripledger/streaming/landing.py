"""Landing raw messages as files, by topic and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger import fixed_values as fv
from tripledger.functions.messages import parse_messages

LANDED, QUARANTINE = "landed", "quarantine"
_LAYOUT = ("zone", "topic", "event_date", "batch")


def land_topics(messages: DataFrame, root: str, checkpoint: str, *, trigger: dict | None = None):
    """Starts the landing query and returns it.

    Messages keep their text. They go to `zone=landed/topic=…/event_date=…/batch=…`;
    messages that are no JSON object, or whose time is none between the years 1 and 9999, go to
    `zone=quarantine`. A repeated batch rewrites its own folders only, so every message lands
    exactly once.
    """
    trigger = trigger or {"processingTime": fv.STREAM_TRIGGER}
    return (
        messages.writeStream.foreachBatch(lambda batch, number: write_batch(batch, number, root))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def write_batch(batch: DataFrame, number: int, root: str) -> None:
    """One micro-batch in one pass."""
    # What is an object and what a time, the message parser decides: loaders and streams agree.
    parsed = parse_messages(batch.select("topic", "value"))
    # A time that is no time would start a folder of its own, or stop the stream.
    timed = F.col("event_time").isNotNull() | F.col("timestamp_text").isNull()
    placed = parsed.select(
        F.when((F.col("shape") == "json") & timed, LANDED).otherwise(QUARANTINE).alias("zone"),
        "topic",
        F.to_date("event_time").alias("event_date"),
        F.lit(number).alias("batch"),
        "value",
    )
    # Gathers small topics into few files and splits large ones.
    (
        placed.hint("rebalance", *_LAYOUT[:3])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*_LAYOUT)
        .text(root)
    )


def topic_path(root: str, topic: str, zone: str = LANDED) -> str:
    return f"{root}/zone={zone}/topic={topic}"
