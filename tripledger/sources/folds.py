"""Folded days of payments, kept as a Parquet table with one folder per day.

Folding a day again replaces its folder, so late payments and repeated runs are taken in by
folding their days anew. A window of whole days is the merge of its folders.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.operators import partials
from tripledger.sources import paths


def write_days(txns: DataFrame, path: str) -> None:
    """Folds whole days: `txns` has all payments of every day it has any of."""
    (
        partials.fold(txns).hint("rebalance", "day").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    )


def read_days(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Folded rows of a closed range of days, open where no end is named; other folders are not opened."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.where(F.col("day") >= F.lit(first.isoformat()).cast("date"))
    if last is not None:
        rows = rows.where(F.col("day") <= F.lit(last.isoformat()).cast("date"))
    return rows


def kept_days(spark: SparkSession, path: str) -> set[date]:
    if not paths.exists(spark, path):
        return set()
    names = [n.removeprefix("day=") for n in paths.children(spark, path) if n.startswith("day=")]
    return {date.fromisoformat(n) for n in names if n[0].isdigit()}
