"""Message streams from files, and unions of streams. Kafka streams: `sources.kafka`."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BYTES_PER_TRIGGER = 1 << 30


def file_messages(
    spark: SparkSession, path: str, topic: str, *, bytes_per_trigger: int = BYTES_PER_TRIGGER
) -> DataFrame:
    """One message per line of the text files that appear under `path`."""
    return (
        spark.readStream.option("maxBytesPerTrigger", bytes_per_trigger)
        .option("recursiveFileLookup", "true")
        .text(path)
        .select(F.lit(topic).alias("topic"), "value")
    )


def file_rows(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    glob: str | None = None,
    bytes_per_trigger: int = BYTES_PER_TRIGGER,
) -> DataFrame:
    """Rows of the Parquet files that appear under `path`."""
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", bytes_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def union_streams(streams: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), streams)
