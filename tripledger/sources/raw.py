"""Batch reading of the raw topic folders."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripledger.schema import FIELDS, LOADED, TRANSACTION
from tripledger.functions import messages
from tripledger.sources import paths


def resolve_range(
    start: datetime | None = None,
    end: datetime | None = None,
    lookback: timedelta | None = None,
) -> tuple[int, int]:
    """Closed range in epoch milliseconds. An explicit start wins over the look-back.

    Naive datetimes are taken as UTC.
    """

    def millis(moment: datetime) -> int:
        if moment.tzinfo is None:
            moment = moment.replace(tzinfo=timezone.utc)
        return (moment - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(milliseconds=1)

    end = end or datetime.now(timezone.utc)
    if start is None:
        if lookback is None:
            raise ValueError("give start or lookback")
        start = end - lookback
    return millis(start), millis(end)


def empty_transactions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LOADED)


def with_event_time(df: DataFrame) -> DataFrame:
    return df.withColumn("event_time", messages.event_time("timestamp"))


#: Times and amounts are read as they stand: a typed field would turn a text into NULL.
_AS_TEXT = T.StructType([
    T.StructField(f.name, T.StringType() if f.name in ("timestamp", "amount") else f.dataType, True) for f in TRANSACTION])


def _typed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "timestamp": F.col("timestamp").try_cast("bigint"), "amount": F.trim("amount").try_cast("double")})


def observed(rows: DataFrame, seen: Observation, lo: int, hi: int) -> DataFrame:
    """The same rows; whoever runs them also counts those read, without a time, and out of range."""
    time = F.col("timestamp")
    return rows.observe(
        seen, F.count(F.lit(1)).alias("read"), F.count_if(time.isNull()).alias("unreadable"),
        F.count_if(~time.between(lo, hi)).alias("out_of_range"))


def load_topic(
    spark: SparkSession,
    path: str,
    lo: int,
    hi: int,
    *,
    on_missing: str = "error",
    multi_line: bool = False,
    fmt: str = "json",
    seen: Observation | None = None,
) -> DataFrame:
    """Transactions of one topic folder with `lo <= timestamp <= hi`.

    Folders partitioned by `event_date` (as the landing stream writes them) are pruned to
    the days of the range. A missing folder is an error unless `on_missing="empty"`.

    In JSON a time or an amount may be a text, as in messages. `seen` is given, by the first
    action on the result and without a pass of its own, how many rows were read, how many of them
    have no readable time, and how many lie outside the range.
    """
    if on_missing not in ("error", "empty"):
        raise ValueError("on_missing is 'error' or 'empty'")
    if on_missing == "empty" and not paths.exists(spark, path):
        return empty_transactions(spark)
    if fmt == "json":
        rows = _typed(spark.read.schema(_AS_TEXT).option("multiLine", str(multi_line).lower()).json(path))
    else:
        rows = spark.read.schema(TRANSACTION).format(fmt).load(path)
    if "event_date" in rows.columns:
        day = F.col("event_date").cast("date")
        rows = rows.filter(
            day.between(
                F.to_date(F.timestamp_millis(F.lit(lo))), F.to_date(F.timestamp_millis(F.lit(hi)))
            )
        )
    if seen is not None:
        rows = observed(rows, seen, lo, hi)
    rows = rows.filter(F.col("timestamp").between(lo, hi))
    return with_event_time(rows.select(*FIELDS))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """By-name union; a column absent from one side is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def load_topics(
    spark: SparkSession,
    roots: Sequence[str],
    lo: int,
    hi: int,
    **options,
) -> DataFrame:
    """`load_topic` over several folders, as one relation."""
    if not roots:
        return empty_transactions(spark)
    return union_all([load_topic(spark, path, lo, hi, **options) for path in roots])
