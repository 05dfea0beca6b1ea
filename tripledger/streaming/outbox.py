"""Exactly-once messages: an outbox keyed by batch, and a publisher that can be run again.

A stream's sink may send a micro-batch twice: it is killed after sending and before its
checkpoint says so. Here the stream only writes each micro-batch to its own folder, which a
repeat overwrites with the same messages. The publisher then takes the folders in order: it notes
where the target stands, sends, and marks the folder as sent. If it finds a folder that is noted
but not marked, a former run died in between; it asks the target which messages came after the
note and sends only the others. A message is known by its batch and its place among equal ones.

One publisher runs at a time for an outbox.
"""

from __future__ import annotations

import json
import time
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripledger import fixed_values as fv
from tripledger.sources import kafka, paths

_BATCH = "batch="
MESSAGE = ("topic", "key", "value")


class Target(Protocol):
    """Where messages go. They have `message_id` besides `topic`, `key` and `value`."""

    def position(self) -> str:
        """A note of where the target stands, to be read back by `sent_since`."""

    def send(self, messages: DataFrame) -> None: ...

    def sent_since(self, position: str) -> DataFrame:
        """`message_id` of what has arrived after the note; more than that does no harm."""


def collect(payload: DataFrame, root: str, checkpoint: str, *, trigger: dict | None = None):
    """Starts the stream of (topic, key, value) rows into the outbox and returns it."""
    return (
        payload.writeStream.foreachBatch(lambda batch, number: put(batch, number, root))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": fv.STREAM_TRIGGER}))
        .start()
    )


def put(batch: DataFrame, number: int, root: str) -> None:
    """One micro-batch; written again, it is the same. Equal messages are numbered."""
    same = Window.partitionBy(*MESSAGE).orderBy(F.lit(1))
    content = F.sha2(F.to_json(F.struct(*MESSAGE)), 256)
    place = F.row_number().over(same).cast("string")
    numbered = batch.select(*MESSAGE, F.concat_ws("-", F.lit(str(number)), content, place).alias("message_id"))
    numbered.write.mode("overwrite").parquet(f"{root}/outbox/{_BATCH}{number:09d}")


def publish(spark: SparkSession, root: str, target: Target) -> int:
    """Sends every folder that is not marked as sent, each message once; returns their number."""
    folder, done = f"{root}/outbox", 0
    for name in paths.children(spark, folder) if paths.exists(spark, folder) else []:
        mark, note = f"{root}/sent/{name}", f"{root}/begun/{name}"
        if not paths.exists(spark, f"{folder}/{name}/_SUCCESS") or paths.exists(spark, mark):
            continue
        messages = spark.read.parquet(f"{folder}/{name}")
        if paths.put_if_absent(spark, note, json.dumps({"position": target.position()})):
            target.send(messages)
        else:
            position = json.loads(paths.read_text(spark, note))["position"]
            target.send(messages.join(target.sent_since(position).select("message_id"), "message_id", "left_anti"))
        paths.put_if_absent(spark, mark, json.dumps({"time": time.time()}))
        done += 1
    return done


class FolderTarget:
    """JSON lines in a folder, one sub-folder per send."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _names(self) -> list[str]:
        return paths.children(self.spark, self.path) if paths.exists(self.spark, self.path) else []

    def position(self) -> str:
        return str(len(self._names()))

    def send(self, messages: DataFrame) -> None:
        messages.select(*MESSAGE, "message_id").write.json(f"{self.path}/{len(self._names()):09d}")

    def read(self, names: list[str] | None = None) -> DataFrame:
        schema = ", ".join(f"{c} string" for c in (*MESSAGE, "message_id"))
        folders = [f"{self.path}/{n}" for n in (self._names() if names is None else names)]
        return self.spark.read.schema(schema).json(folders) if folders else self.spark.createDataFrame([], schema)

    def sent_since(self, position: str) -> DataFrame:
        return self.read(self._names()[int(position):])


class KafkaTarget:
    """Topics of a broker; the message id travels as a header. Needs the public connector."""

    def __init__(self, spark: SparkSession, servers: str, topics: list[str]):
        self.spark, self.servers, self.topics = spark, servers, topics

    def position(self) -> str:
        return str(int(time.time() * 1000) - 60_000)  # clocks may differ by a minute

    def send(self, messages: DataFrame) -> None:
        header = F.array(F.struct(F.lit("message_id").alias("key"), F.col("message_id").cast("binary").alias("value")))
        kafka.write_batch(messages.select(*MESSAGE, header.alias("headers")), self.servers)

    def sent_since(self, position: str) -> DataFrame:
        records = self.spark.read.format("kafka").options(**kafka.since_options(self.servers, self.topics, position)).load()
        ids = F.filter("headers", lambda h: h["key"] == "message_id")
        return records.select(F.element_at(F.transform(ids, lambda h: h["value"].cast("string")), 1).alias("message_id"))
