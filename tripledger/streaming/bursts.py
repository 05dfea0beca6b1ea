"""Bursts in a stream: sliding event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger import fixed_values as fv


def burst_stream(
    txns: DataFrame,
    *,
    count: int = fv.BURST_COUNT,
    window: str = f"{fv.BURST_SECONDS} seconds",
    slide: str = "5 seconds",
    lateness: str = "1 minute",
) -> DataFrame:
    """Users and aligned windows with at least `count` transactions.

    Windows start at multiples of `slide`, so a burst that straddles two of them counts in
    neither; the trailing range of `operators.burst.burst_detect` sees it. Rows fold before
    the shuffle, so a busy user costs one row per window and task.
    """
    return (
        txns.withWatermark("event_time", lateness)
        .groupBy("user_id", F.window("event_time", window, slide).alias("w"))
        .agg(F.count(F.lit(1)).alias("txn_count"))
        .filter(F.col("txn_count") >= count)
        .select("user_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "txn_count")
    )
