"""Streams judged in event-time order, whatever order the rows arrive in.

Rows of a user wait in list state until the watermark has passed their time. Then a timer hands
all that are due over in (event time, id) order, so fraud rules see the history that the batch
operators see, also when it arrives shuffled over many micro-batches. State holds the rows of the
last `lateness` and a few numbers per user, kept outside the heap by the state store.

No row is dropped: a row that comes later than `lateness`, or has no time, is handed over when it
arrives, after what has been handed over before.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Context, Decimal
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tripledger import fixed_values as fv
from tripledger.functions import alerts, money

#: Stands for an unknown time: due at once, and first, as unknown times are in batch.
_NO_TIME = -(1 << 63)
_ORDER = ["at", "transaction_id", "source", "amount", "status"]
_EXACT = Context(prec=money.TOTAL.precision)


def _micros(interval: str) -> int:
    return int(pd.Timedelta(interval) / pd.Timedelta(microseconds=1))


class InOrder(StatefulProcessor):
    """Holds rows with a time `at` (microseconds) back until the watermark has passed them.

    Subclasses say what they keep (`memory_schema`) and what becomes of rows that are due
    (`release`), which come sorted by `order`.
    """

    memory_schema: T.StructType

    def __init__(self, columns: T.StructType, order: list[str]):
        self.columns, self.order = columns, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.columns)
        self.memory = handle.getValueState("memory", self.memory_schema)

    def release(self, key: tuple, rows: pd.DataFrame, mark: int) -> pd.DataFrame:
        raise NotImplementedError

    def keep_until(self) -> int | None:
        """The time up to which the memory must be kept, if it may be forgotten at all."""
        return None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        due = []
        for part in rows:
            part = part[self.columns.names]
            late = part["at"] <= mark
            due.append(part[late])
            self._hold(part[~late])
        due = pd.concat(due)
        if len(due):
            yield self._released(key, due, mark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        held = pd.DataFrame(list(self.waiting.get()), columns=self.columns.names)
        late = held["at"] <= mark
        if late.any():
            self.waiting.clear()
            self._hold(held[~late])
            yield self._released(key, held[late], mark)
        until = self.keep_until()
        if late.all() and until is not None and until <= mark:
            self.memory.clear()

    def close(self) -> None:
        pass

    def _hold(self, rows: pd.DataFrame) -> None:
        if len(rows):
            self.waiting.appendList(list(zip(*[rows[c].tolist() for c in self.columns.names])))
            self._wake(int(rows["at"].min()))

    def _wake(self, at: int) -> None:
        self.handle.registerTimer(-(-at // 1000))

    def _released(self, key: tuple, rows: pd.DataFrame, mark: int) -> pd.DataFrame:
        rows = rows.sort_values(self.order, na_position="first", kind="stable")
        out = self.release(key, rows, mark)
        until = self.keep_until()
        if until is not None:
            self._wake(until)
        return out


# ---------------------------------------------------------------- fraud rules

_HISTORY = T.StructType([
    T.StructField("transaction_id", T.StringType()), T.StructField("at", T.LongType()),
    T.StructField("amount", T.DoubleType()), T.StructField("status", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("total", T.StringType()),
    T.StructField("large", T.DoubleType()),
])
_JUDGED = T.StructType([
    T.StructField("user_id", T.StringType()), *_HISTORY.fields, T.StructField("txn_count", T.LongType())])


class History(InOrder):
    """Running count and total of a user."""

    memory_schema = T.StructType([
        T.StructField("n", T.LongType()), T.StructField("total", T.StringType()),
        T.StructField("large", T.DoubleType()), T.StructField("last", T.LongType())])

    def __init__(self, forget: int | None):
        super().__init__(_HISTORY, _ORDER)
        self.forget = forget

    def release(self, key, rows, mark):
        n, total, large, last = self.memory.get() if self.memory.exists() else (0, "0", 0.0, _NO_TIME)
        totals = list(accumulate(map(Decimal, rows["total"]), _EXACT.add, initial=Decimal(total)))[1:]
        larges = list(accumulate(rows["large"].tolist(), initial=large))[1:]
        last = max(last, int(rows["at"].max()))
        self.memory.update((n + len(rows), str(totals[-1]), float(larges[-1]), last))
        rows = rows.assign(user_id=key[0], total=[str(t) for t in totals], large=larges,
                           txn_count=range(n + 1, n + len(rows) + 1))
        return rows[_JUDGED.names]

    def keep_until(self):
        if self.forget is None or not self.memory.exists():
            return None
        return max(self.memory.get()[3], 0) + self.forget


def fraud_rules_ordered(
    txns: DataFrame, *, lateness: str, threshold: float = fv.LARGE_AMOUNT, forget_after: str | None = None
) -> DataFrame:
    """Streaming form of `operators.rules.fraud_rules` in event-time order, append mode.

    A row comes out once the watermark, the greatest time seen less `lateness`, has passed it. On
    rows that come no later than that the result equals the batch operator's. Users are remembered
    for ever, or until the watermark passes `forget_after` beyond their last row.
    """
    if "source" not in txns.columns:
        txns = txns.withColumn("source", F.lit(None).cast("string"))
    waiting = txns.withWatermark("event_time", lateness).select(
        "user_id", "transaction_id", "amount", "status", "source",
        # A plain number: Spark drops late rows by the column that bears the watermark.
        F.coalesce(F.unix_micros("event_time"), F.lit(_NO_TIME)).alias("at"),
        F.coalesce(money.fine("amount").cast(money.TOTAL), F.lit(0).cast(money.TOTAL)).cast("string").alias("total"),
        F.coalesce(money.coarse("amount"), F.lit(0.0)).alias("large"),
    )
    counted = waiting.groupBy("user_id").transformWithStateInPandas(
        History(_micros(forget_after) if forget_after else None), outputStructType=_JUDGED,
        outputMode="Append", timeMode="EventTime")
    total = F.col("total").cast(money.TOTAL)
    totals = counted.select(
        "user_id", "transaction_id", _time("at"), "amount", "status", "source", "txn_count",
        money.known_total(total, F.nullif("large", F.lit(0.0))).alias("txn_total"))
    return alerts.apply_rules(totals, threshold)


def _time(at: str):
    return F.when(F.col(at) != _NO_TIME, F.timestamp_micros(at)).alias("event_time")


# ---------------------------------------------------------------- bursts

_TIMED = T.StructType([T.StructField("transaction_id", T.StringType()), T.StructField("at", T.LongType())])
_COUNTED = T.StructType([
    T.StructField("user_id", T.StringType()), *_TIMED.fields, T.StructField("burst_count", T.LongType())])


class Trailing(InOrder):
    """Rows of a user in the closed range `[t - micros, t]`: a ring of the times that still matter."""

    memory_schema = T.StructType([
        T.StructField("times", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.LongType()))])

    def __init__(self, micros: int):
        super().__init__(_TIMED, ["at", "transaction_id"])
        self.micros = micros

    def release(self, key, rows, mark):
        at = rows["at"].to_numpy(np.int64)
        known = at != _NO_TIME
        if key[0] is None or key[0].startswith("\0"):
            return rows.assign(user_id=None, burst_count=0)[_COUNTED.names]
        times, counts = map(np.array, self.memory.get()) if self.memory.exists() else (np.zeros(0, np.int64),) * 2
        new, n = np.unique(at[known], return_counts=True)
        every, place = np.unique(np.r_[times, new].astype(np.int64), return_inverse=True)
        size = np.zeros(len(every), np.int64)
        np.add.at(size, place, np.r_[counts, n].astype(np.int64))
        before = np.r_[0, np.cumsum(size)]
        found = before[np.searchsorted(every, at, "right")] - before[np.searchsorted(every, at - self.micros)]
        # The next row due has a time beyond the mark.
        keep = every > max(mark, _NO_TIME + self.micros) - self.micros
        self.memory.update((every[keep].tolist(), size[keep].tolist()))
        return rows.assign(user_id=key[0], burst_count=np.where(known, found, 0))[_COUNTED.names]

    def keep_until(self):
        times = self.memory.get()[0] if self.memory.exists() else []
        return max(times[-1], 0) + self.micros + 1000 if len(times) else None


def burst_ordered(
    txns: DataFrame, *, count: int = fv.BURST_COUNT, seconds: int = fv.BURST_SECONDS, lateness: str = "1 minute"
) -> DataFrame:
    """Streaming form of `operators.burst.burst_detect`: `transaction_id`, `user_id`, `event_time`,
    `burst_count`, `is_burst`, in append mode.

    Windows trail every row, so no burst falls between two of them. A late row counts those of
    its range that are still remembered, and is counted by later rows only. A transaction without
    a user or a time is in no burst.
    """
    # Rows without user have nothing to do with each other: they spread.
    alone = F.concat(F.lit("\0"), F.pmod(F.xxhash64("transaction_id"), F.lit(1024)).cast("string"))
    waiting = txns.withWatermark("event_time", lateness).select(
        F.coalesce("user_id", alone).alias("user_id"), "transaction_id",
        F.coalesce(F.unix_micros("event_time"), F.lit(_NO_TIME)).alias("at"))
    counted = waiting.groupBy("user_id").transformWithStateInPandas(
        Trailing(seconds * 1_000_000), outputStructType=_COUNTED, outputMode="Append", timeMode="EventTime")
    return counted.select("transaction_id", "user_id", _time("at"), "burst_count",
                          (F.col("burst_count") >= count).alias("is_burst"))
