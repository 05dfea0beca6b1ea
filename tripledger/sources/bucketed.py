"""Channel tables bucketed and sorted by transaction id, and their reconciliation without a shuffle.

A table is written once, hashed and sorted by id into the same number of buckets for every
channel. Joins on the id then read matching buckets side by side. A full join keeps no such
layout, so the three-way match is put together from joins that do: what the bank has, with the
gateway's and the processor's views; what the gateway has beyond that; what the processor has
beyond both. Rows without an id match nothing and pass by.

Buckets should be no fewer than the cores that read them, or Spark may rather shuffle. An id with
very many rows stays within its bucket; `operators.reconcile` salts such ids instead.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger import fixed_values as fv
from tripledger.functions.checks import CHANNELS
from tripledger.operators.reconcile import FACTS, judge

KEY = "transaction_id"


def write_bucketed(rows: DataFrame, table: str, path: str, buckets: int) -> None:
    """Writes a table of the session's catalog with its files under `path`: one per bucket."""
    spread = rows.repartition(buckets, KEY)
    spread.write.mode("overwrite").option("path", path).bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(table)


def reconcile_bucketed(
    spark: SparkSession,
    bank: str,
    gateway: str,
    processor: str,
    *,
    tolerance: float = fv.AMOUNT_TOLERANCE,
    exact: bool = False,
    as_of: datetime | None = None,
) -> DataFrame:
    """`operators.reconcile.reconcile` over three bucketed tables (names in the catalog)."""
    tables = dict(zip(CHANNELS, (bank, gateway, processor)))

    def side(c: str, known: bool = True) -> DataFrame:
        there = F.col(KEY).isNotNull()
        return spark.table(tables[c]).where(there if known else ~there).select(
            F.col(KEY).alias(f"{c}_id"), *[F.col(f).alias(f"{c}_{f}") for f in FACTS])

    def ids(c: str) -> DataFrame:
        return spark.table(tables[c]).where(F.col(KEY).isNotNull()).select(F.col(KEY).alias("other"))

    b, g, p = CHANNELS
    parts = []
    for k, c in enumerate(CHANNELS):
        rows = side(c)
        for earlier in CHANNELS[:k]:
            rows = _merged(rows, ids(earlier), F.col(f"{c}_id") == F.col("other"), "left_anti")
        for later in CHANNELS[k + 1:]:
            rows = _merged(rows, side(later), F.col(f"{c}_id") == F.col(f"{later}_id"), "left")
        parts += [rows, side(c, known=False)]
    matched = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    return judge(matched, CHANNELS, tolerance, exact, as_of)


def _merged(left: DataFrame, right: DataFrame, on, how: str) -> DataFrame:
    """Buckets are sorted and merged in their task; neither side is moved."""
    return left.join(right.hint("merge"), on, how)
