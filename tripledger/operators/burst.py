"""Bursts: many transactions of one user within a short trailing range."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripledger import fixed_values as fv
from tripledger.operators.skew import KeyProfile, among, not_among, profile_keys


def burst_detect(
    txns: DataFrame,
    *,
    count: int = fv.BURST_COUNT,
    seconds: int = fv.BURST_SECONDS,
    skew: KeyProfile | None = None,
) -> DataFrame:
    """Adds `burst_count`, the user's transactions in the closed range `[t - seconds, t]`,
    and `is_burst`. A transaction without a user or a time is in no burst.

    Users with very many rows fold to one row per distinct time first, and their history is
    cut into stretches of the range's length; no other user pays for that. They are looked
    for when the input is large; `skew` takes a profile made before (`KeyProfile()` for none).
    """
    if skew is None:
        skew = profile_keys({"txns": txns}, "user_id")["txns"]
    micros = seconds * 1_000_000
    timed = txns.withColumn("_at", F.unix_micros(F.col("event_time").cast("timestamp")))
    user = F.col("user_id")
    parts = []
    if skew.null_keys:
        parts.append(timed.filter(user.isNull()).withColumn("burst_count", F.lit(0).cast("long")))
        timed = timed.filter(user.isNotNull())
    if skew.hot:
        parts.append(_stretched(timed.filter(among(user, skew.hot)), micros))
        timed = timed.filter(not_among(user, skew.hot))
    counted = reduce(DataFrame.unionByName, [_windowed(timed, micros), *parts])
    nowhere = user.isNull() | F.col("_at").isNull()
    known = F.when(nowhere, F.lit(0).cast("long")).otherwise(F.col("burst_count"))
    return (
        counted.withColumn("burst_count", known)
        .withColumn("is_burst", F.col("burst_count") >= count)
        .drop("_at")
    )


def _windowed(timed: DataFrame, micros: int) -> DataFrame:
    trailing = Window.partitionBy("user_id").orderBy("_at").rangeBetween(-micros, 0)
    return timed.withColumn("burst_count", F.count(F.lit(1)).over(trailing))


def _stretched(timed: DataFrame, micros: int) -> DataFrame:
    """A trailing range touches its own stretch and the one before. Every folded row is
    therefore placed in its stretch and, as context, in the next."""
    folded = timed.filter(F.col("_at").isNotNull()).groupBy("user_id", "_at").agg(
        F.count(F.lit(1)).alias("_n")
    )
    stretch = F.expr(f"_at DIV {micros}L - CASE WHEN _at % {micros}L < 0 THEN 1 ELSE 0 END")
    placed = folded.withColumn("_own", stretch).withColumn(
        "_stretch", F.explode(F.array(F.col("_own"), F.col("_own") + 1))
    )
    trailing = Window.partitionBy("user_id", "_stretch").orderBy("_at").rangeBetween(-micros, 0)
    counts = (
        placed.withColumn("burst_count", F.sum("_n").over(trailing))
        .filter(F.col("_stretch") == F.col("_own"))
        .select("user_id", "_at", "burst_count")
    )
    # One counted row per user and time; only the large side can be skewed, which a left
    # join may split.
    return timed.join(counts, ["user_id", "_at"], "left")
