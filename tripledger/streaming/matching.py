"""Continuous reconciliation: the three views of a payment meet in a session of their id.

The channels are one tagged stream, grouped by id and session: views whose times lie within
`apart` of each other are one session, which ends `apart` after its last view. Once the watermark
has passed that end, the session leaves the state and its views are matched as the full outer
join of the batch operator matches them. So an id needs one state row instead of three join
buffers, and no view is shuffled twice. No row passes through Python.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger import fixed_values as fv
from tripledger.functions.checks import CHANNELS
from tripledger.operators.reconcile import FACTS, judge


def reconcile_stream(
    bank: DataFrame,
    gateway: DataFrame,
    processor: DataFrame,
    **options,
) -> DataFrame:
    """Streaming form of `operators.reconcile.reconcile` (`key_mode="coalesced"`) over three streams;
    options as in `match_views`."""
    tagged = [f.withColumn("channel", F.lit(c)) for c, f in zip(CHANNELS, (bank, gateway, processor))]
    columns = [*FACTS, "transaction_id", "channel", *(["arrival"] if all("arrival" in f.columns for f in tagged) else [])]
    return match_views(reduce(DataFrame.unionByName, [f.select(*columns) for f in tagged]), **options)


def match_views(
    views: DataFrame,
    *,
    apart: str = "10 minutes",
    lateness: str = "1 hour",
    tolerance: float = fv.AMOUNT_TOLERANCE,
    exact: bool = False,
    dedupe: str | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """The report over one stream of views, whose `channel` says who sent them; append mode.

    A payment is reported once, when the watermark (the greatest time seen less `lateness`) has
    passed its session. A view that comes later is left out of the stream; Spark counts it in
    `numRowsDroppedByWatermark`, and the next batch run over the range finds it. Views of one id
    that lie further apart than `apart` are reported apart. A view without id is reported alone, as in batch;
    a view without a time, its own or that of its arrival, belongs to no session.

    An id that occurs n times in a channel gives n rows; `dedupe="latest"` keeps each channel's
    newest view, and the state of an id then has a fixed size.
    """
    if dedupe not in (None, "latest"):
        raise ValueError("dedupe is None or 'latest'")
    time = F.coalesce("event_time", "arrival") if "arrival" in views.columns else F.col("event_time")
    alone = F.concat(F.lit("\0"), F.expr("uuid()"))
    tagged = views.select(
        "channel", F.coalesce("transaction_id", alone).alias("key"), "transaction_id", time.alias("event_time"),
        *[f for f in FACTS if f != "event_time"])
    facts = F.struct("event_time", *[f for f in FACTS if f != "event_time"])
    fold = F.collect_list if dedupe is None else F.max
    sessions = tagged.withWatermark("event_time", lateness).groupBy(
        "key", F.session_window("event_time", apart)
    ).agg(
        F.max("transaction_id").alias("transaction_id"),
        *[fold(F.when(F.col("channel") == c, facts)).alias(c) for c in CHANNELS],
    )
    # One channel's views after the other: every combination, and NULLs where there is none.
    matched = sessions.select("transaction_id", *CHANNELS)
    if dedupe is None:
        for c in CHANNELS:
            others = [n for n in matched.columns if n != c]
            matched = matched.select(*others, F.explode_outer(c).alias(c))
    matched = matched.select(*[
        column for c in CHANNELS for column in (
            F.when(F.col(c).isNotNull(), F.col("transaction_id")).alias(f"{c}_id"),
            *[F.col(f"{c}.{f}").alias(f"{c}_{f}") for f in FACTS],
        )])
    return judge(matched, CHANNELS, tolerance, exact, as_of)

