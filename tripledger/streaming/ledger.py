"""Fraud rules over a stream in large micro-batches, such as a backfill.

`streaming.rules` keeps a state per user and suits small, frequent batches. Here every
micro-batch runs through the batch operator, so a user with a third of its rows is sliced
like any other hot user, and no row passes through Python.

What users leave behind is a log: each micro-batch adds what its own users added, in buckets of
the user, and reads the log only in the buckets of its users. Every `COMPACT_EVERY` batches the log
so far is summed up to one row per user, and what that replaces is dropped one such sum later. A
batch that runs twice rewrites its own folders from the same opening balances; batches run in order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripledger import fixed_values as fv
from tripledger.functions import money
from tripledger.operators import rules
from tripledger.sources import paths
from tripledger.sources.scratch import materialize

BUCKETS = 32
COMPACT_EVERY = 50
_BATCH, _UPTO = "batch=", "upto="
_BALANCE = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("n", T.LongType()), T.StructField("total", money.TOTAL),
    T.StructField("large", T.DoubleType()), T.StructField("bucket", T.IntegerType())])


def fraud_rules_ledger(
    txns: DataFrame,
    root: str,
    checkpoint: str,
    *,
    threshold: float = fv.LARGE_AMOUNT,
    trigger: dict | None = None,
):
    """Starts the query and returns it. Judged rows go to `root/judged`."""
    return (
        txns.writeStream.foreachBatch(lambda batch, n: advance(batch, n, root, threshold))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": fv.STREAM_TRIGGER}))
        .start()
    )


def advance(
    batch: DataFrame, number: int, root: str, threshold: float = fv.LARGE_AMOUNT, compact_every: int = COMPACT_EVERY
) -> None:
    """One micro-batch: judged rows, and what its users added."""
    spark = batch.sparkSession
    rows = materialize(batch, "ledger-batch")  # read for the profile, the rules and the sums
    added = materialize(_bucketed(rules.balances(rows)), "ledger-added")
    opening = _opening(spark, root, number, added)
    judged = rules.fraud_rules(rows, threshold=threshold, opening=opening)
    judged.write.mode("overwrite").parquet(f"{root}/judged/{_BATCH}{number}")
    _write(added, f"{root}/added/{_BATCH}{number}")
    if number % compact_every == compact_every - 1:
        compact(spark, root, number)


def read_judged(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/judged").drop("batch")


def compact(spark: SparkSession, root: str, number: int) -> None:
    """Sums the log up to a batch. The sum before this one stays, with the log after it: the
    batch may have to run again from them."""
    log = _log(spark, root, number + 1, None)
    _write(_summed(log), f"{root}/sums/{_UPTO}{number}")
    earlier = [n for n in _finished(spark, f"{root}/sums", _UPTO) if n < number]
    before = max(earlier, default=-1)
    for folder, mark in (("sums", _UPTO), ("added", _BATCH)):
        for n in _finished(spark, f"{root}/{folder}", mark):
            if n < before or (n == before and folder == "added"):
                paths.drop_directory(spark, f"{root}/{folder}/{mark}{n}")


def _bucketed(balances: DataFrame) -> DataFrame:
    return balances.withColumn("bucket", F.pmod(F.xxhash64("user_id"), F.lit(BUCKETS)).cast("int"))


def _write(balances: DataFrame, path: str) -> None:
    # The hint gathers a bucket into few files, and splits a large one.
    balances.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def _summed(log: DataFrame) -> DataFrame:
    return log.groupBy("bucket", "user_id").agg(
        F.sum("n").alias("n"), F.sum("total").cast(money.TOTAL).alias("total"), F.sum("large").alias("large"))


def _finished(spark: SparkSession, folder: str, mark: str) -> list[int]:
    if not paths.exists(spark, folder):
        return []
    return [int(name[len(mark):]) for name in paths.children(spark, folder)
            if name.startswith(mark) and paths.exists(spark, f"{folder}/{name}/_SUCCESS")]


def _log(spark: SparkSession, root: str, number: int, buckets: list[int] | None) -> DataFrame | None:
    """The newest sum before a batch and what later batches before it added, in some buckets."""
    upto = max((n for n in _finished(spark, f"{root}/sums", _UPTO) if n < number - 1), default=-1)
    added = [n for n in _finished(spark, f"{root}/added", _BATCH) if upto < n < number]
    folders = [f"{root}/added/{_BATCH}{n}" for n in added] + ([f"{root}/sums/{_UPTO}{upto}"] if upto >= 0 else [])
    if not folders:
        return None
    parts = [spark.read.schema(_BALANCE).parquet(f) for f in folders]
    if buckets is not None:  # other folders are not opened
        parts = [p.where(F.col("bucket").isin(buckets)) for p in parts]
    return reduce(DataFrame.unionByName, parts)


def _opening(spark: SparkSession, root: str, number: int, added: DataFrame) -> DataFrame | None:
    """Balances of this batch's users before it."""
    buckets = [r[0] for r in added.select("bucket").distinct().collect()]  # at most BUCKETS
    log = _log(spark, root, number, buckets)
    if log is None:
        return None
    users = added.select(F.col("user_id").alias("_user"))
    mine = log.join(users, F.col("user_id").eqNullSafe(F.col("_user")), "left_semi")
    return _summed(mine).drop("bucket")
