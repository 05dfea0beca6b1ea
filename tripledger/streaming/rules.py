"""Fraud rules over an unbounded stream: keyed state per user."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Context, Decimal
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tripledger import fixed_values as fv
from tripledger.functions import alerts, messages, money

_CARRIED = ("transaction_id", "event_time", "amount", "status", "source")
_STATE = T.StructType(
    [T.StructField("n", T.LongType()), T.StructField("total", money.TOTAL), T.StructField("large", T.DoubleType())]
)
_EXACT = Context(prec=money.TOTAL.precision)
_OUT = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("txn_count", T.LongType()),
        T.StructField("total", money.TOTAL),
        T.StructField("large", T.DoubleType()),
    ]
)
#: Begins the key of rows that only pass through; no message has such a user.
_REJECTED = "\0rejected"
_ORDER = ["event_time", "transaction_id", "source", "amount", "status"]


def judged_messages(stream: DataFrame, value: str = "value") -> DataFrame:
    """Parsed and classified messages. One without a time of its own takes its `arrival` time
    where the source gives one."""
    judged = messages.classify(messages.parse_messages(stream, value))
    if "arrival" in stream.columns:
        judged = judged.withColumn("event_time", F.coalesce("event_time", "arrival"))
    return judged


def valid_messages(stream: DataFrame, value: str = "value") -> DataFrame:
    """Valid transactions of a message stream; the rest never touches state."""
    return judged_messages(stream, value).filter(F.col("row_class") == messages.VALID)


def verdict_lines(
    stream: DataFrame, *, threshold: float = fv.LARGE_AMOUNT, value: str = "value", **options
) -> DataFrame:
    """One text line per message of a stream: alert, normal, or why it was rejected.

    Every message is read and parsed once: rejected ones bring their line along and pass by the
    state, under keys of their own that spread them.
    """
    judged = judged_messages(stream, value)
    valid = F.col("row_class") == messages.VALID
    spread = F.concat(F.lit(_REJECTED), F.pmod(F.xxhash64(value), F.lit(1024)).cast("string"))
    keyed = judged.withColumns({
        "user_id": F.when(valid, F.col("user_id")).otherwise(spread),
        "line": F.when(~valid, alerts.rejected_text(value)),
    })
    good = fraud_rules_stream(keyed, threshold=threshold, **options)
    return good.select(F.coalesce("line", alerts.alert_text(threshold)).alias("value"))


def _ordering():
    """A function that orders a user's rows. Tasks get it by value, as they may not have this package."""

    def ordered(rows: pd.DataFrame) -> pd.DataFrame:
        times = rows["event_time"]
        if times.is_unique and not times.hasnans:  # by time alone takes a fraction of the time
            return rows.take(times.to_numpy().argsort(kind="stable"))
        return rows.sort_values(_ORDER, na_position="first", kind="stable")

    return ordered


_ordered = _ordering()


def fraud_rules_stream(
    txns: DataFrame,
    *,
    threshold: float = fv.LARGE_AMOUNT,
    forget_after: str | None = None,
    once_per_id: bool = False,
) -> DataFrame:
    """Streaming form of `operators.rules.fraud_rules`, append mode.

    Within a micro-batch a user's rows run in event-time order; across micro-batches they
    run in arrival order, so late rows see a later history than in batch. The size of a
    micro-batch, set at the source, bounds what one task holds for one user.

    Users are remembered for ever, or until the watermark passes `forget_after` (an interval
    like '30 days') beyond their last row. `once_per_id` counts a transaction once that
    arrives on several topics within that interval.
    """
    if once_per_id and not forget_after:
        raise ValueError("once_per_id needs forget_after: ids cannot be remembered for ever")
    if "source" not in txns.columns:
        txns = txns.withColumn("source", F.lit(None).cast("string"))
    timeout, forget_ms = GroupStateTimeout.NoTimeout, None
    if forget_after:
        txns = txns.withWatermark("event_time", forget_after)
        timeout = GroupStateTimeout.EventTimeTimeout
        forget_ms = int(pd.Timedelta(forget_after) / pd.Timedelta(milliseconds=1))
    if once_per_id:
        txns = txns.dropDuplicatesWithinWatermark(["transaction_id"])
    out = _OUT
    if "line" in txns.columns:
        out = T.StructType([*_OUT.fields, T.StructField("line", T.StringType())])
    keyed = txns.select(
        "user_id", *_CARRIED, *(["line"] if "line" in txns.columns else []),
        F.coalesce(money.fine("amount").cast(money.TOTAL), F.lit(0).cast(money.TOTAL)).alias("total"),
        F.coalesce(money.coarse("amount"), F.lit(0.0)).alias("large"),
    )

    def advance(
        key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        if str(key[0]).startswith(_REJECTED):
            for part in chunks:
                yield part.assign(txn_count=0)[out.names]
            return
        parts = list(chunks)
        rows = _ordered(parts[0] if len(parts) == 1 else pd.concat(parts))
        n, total, large = state.get if state.exists else (0, Decimal(0), 0.0)
        run = {
            "txn_count": range(n + 1, n + len(rows) + 1),
            "total": list(accumulate(rows["total"], _EXACT.add, initial=total))[1:],
            "large": list(accumulate(rows["large"], initial=large))[1:],
        }
        state.update((n + len(rows), run["total"][-1], float(run["large"][-1])))
        if forget_ms is not None:
            newest = rows["event_time"].max()
            if not pd.isna(newest):
                latest = max(int(newest.timestamp() * 1000), state.getCurrentWatermarkMs())
                state.setTimeoutTimestamp(latest + forget_ms)
        # One new frame: setting columns of many small ones costs more than their rows.
        yield pd.DataFrame({c: run[c] if c in run else rows[c].array for c in out.names})

    counted = keyed.groupBy("user_id").applyInPandasWithState(advance, out, _STATE, "append", timeout)
    totals = counted.withColumn("txn_total", money.known_total("total", F.nullif("large", F.lit(0.0))))
    totals = totals.drop("total", "large")
    return alerts.apply_rules(totals, threshold)
