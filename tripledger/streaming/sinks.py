"""Starting a streaming query."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripledger import fixed_values as fv

AVAILABLE_NOW = {"availableNow": True}


def to_parquet(stream: DataFrame, path: str, checkpoint: str, *, trigger: dict | None = None):
    """Append to Parquet files; with its checkpoint a restarted query continues exactly once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": fv.STREAM_TRIGGER}))
        .start()
    )


def to_console(stream: DataFrame, checkpoint: str, *, trigger: dict | None = None):
    return (
        stream.writeStream.format("console")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": fv.STREAM_TRIGGER}))
        .start()
    )
