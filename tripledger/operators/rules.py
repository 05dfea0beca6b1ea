"""Fraud rules over a user's running history, in batch form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripledger import fixed_values as fv
from tripledger.functions import alerts, money
from tripledger.functions.messages import ALERT
from tripledger.operators.skew import KeyProfile, among, profile_keys
from tripledger.sources.scratch import materialize

TIE_BREAKERS = ("source", "amount", "status")
ROWS_PER_SLICE = 2_000_000
BROADCAST_ROWS = 100_000  # of five small columns, about 10 MB


def fraud_rules(
    txns: DataFrame,
    *,
    threshold: float = fv.LARGE_AMOUNT,
    order_by: Sequence[str] = ("event_time", "transaction_id"),
    skew: KeyProfile | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    opening: DataFrame | None = None,
) -> DataFrame:
    """Every valid transaction with its user's running count and total and the rules it breaks.

    History runs in `order_by` order, the current row included. Rows must already be valid
    (see `functions.messages.classify`): others never count.
    """
    counted = running_totals(
        txns, order_by=order_by, skew=skew, rows_per_slice=rows_per_slice, opening=opening
    )
    return alerts.apply_rules(counted, threshold)


def running_totals(
    txns: DataFrame,
    *,
    order_by: Sequence[str] = ("event_time", "transaction_id"),
    skew: KeyProfile | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    opening: DataFrame | None = None,
) -> DataFrame:
    """Adds `txn_count` and `txn_total` (summed without loss, given as double).

    Users with very many rows have their history cut into slices of about `rows_per_slice`
    rows; each slice is summed on its own and starts from the total of the slices before it.
    All other users take one window. Such users are looked for when the input is large;
    `skew` takes a profile made before (`KeyProfile()` for none).

    `opening` has what earlier rows left behind, one row per user, as `balances` makes it.
    """
    if skew is None:
        skew = profile_keys({"txns": txns}, "user_id")["txns"]
    order = [*order_by, *[c for c in TIE_BREAKERS if c in txns.columns and c not in order_by]]
    nobody = skew.null_keys > rows_per_slice  # rows without user share one history
    if not skew.hot and not nobody:
        return _finish(_windowed(txns, ["user_id"], order), opening)
    user = F.col("user_id")
    many = F.when(user.isNull(), F.lit(nobody)).otherwise(among(user, skew.hot))
    rows_of = {**skew.hot, **({None: skew.null_keys} if nobody else {})}
    cold = _windowed(txns.filter(~many), ["user_id"], order)
    hot = _sliced(txns.filter(many), order, rows_of, rows_per_slice)
    return _finish(cold.unionByName(hot), opening)


def balances(txns: DataFrame, opening: DataFrame | None = None) -> DataFrame:
    """Count `n`, exact `total` and `large` (see `functions.money`) per user after `txns`, on
    top of `opening`."""
    sums = txns.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(money.fine("amount")), F.lit(0)).cast(money.TOTAL).alias("total"),
        F.sum(money.coarse("amount")).alias("large"),
    )
    if opening is None:
        return sums
    return sums.unionByName(opening, allowMissingColumns=True).groupBy("user_id").agg(
        F.sum("n").alias("n"), F.sum("total").cast(money.TOTAL).alias("total"), F.sum("large").alias("large")
    )


def alert_payload(judged: DataFrame, threshold: float = fv.LARGE_AMOUNT) -> DataFrame:
    """Key and JSON value of every alert, for a message topic."""
    value = F.to_json(
        F.struct(
            "transaction_id", "user_id", "amount", "status", "txn_count", "txn_total",
            "is_large", "is_repeated", "is_bad_status",
            alerts.reasons(threshold).alias("reasons"),
        )
    )
    return judged.filter(F.col("row_class") == ALERT).select(
        F.lit(fv.ALERT_TOPIC).alias("topic"), F.col("transaction_id").alias("key"), value.alias("value")
    )


# ---------------------------------------------------------------- parts


def _windowed(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    run = (
        Window.partitionBy(*keys).orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumns(
        {
            "txn_count": F.count(F.lit(1)).over(run),
            "_total": F.sum(money.fine("amount")).over(run).cast(money.TOTAL),
            "_large": F.sum(money.coarse("amount")).over(run),
        }
    )


def _sliced(df: DataFrame, order: list[str], rows_of: dict[str, int], rows_per_slice: int) -> DataFrame:
    slices = max(1, -(-sum(rows_of.values()) // rows_per_slice))
    # Identical copies may be cut anywhere: the last sort key lets the range split them.
    copies = df.withColumn("_copy", F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in order]))
    ranged = copies.repartitionByRange(slices, "user_id", *order, "_copy").withColumn(
        "_slice", F.spark_partition_id()
    )
    # Two readers need the same cut, also after a lost task: it is written down once.
    ranged = materialize(ranged, "user-slices")
    within = _windowed(ranged, ["_slice", "user_id"], [*order, "_copy"])
    per_slice = ranged.groupBy("user_id", "_slice").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(money.fine("amount")).alias("total"),
        F.sum(money.coarse("amount")).alias("large"),
    )
    earlier = Window.partitionBy("user_id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    opening = per_slice.select(
        "user_id", "_slice",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_n_before"),
        F.sum("total").over(earlier).cast(money.TOTAL).alias("_total_before"),
        F.sum("large").over(earlier).alias("_large_before"),
    ).withColumnsRenamed({"user_id": "_user", "_slice": "_part"})
    # Ranges are contiguous, so there are at most hot users + slices such rows. No row of the
    # large side moves while they are few; beyond that the join is AQE's, on the slice.
    if slices + len(rows_of) < BROADCAST_ROWS:
        opening = F.broadcast(opening)
    joined = within.join(
        opening, (F.col("_slice") == F.col("_part")) & F.col("user_id").eqNullSafe(F.col("_user"))
    )
    return joined.select(
        *df.columns,
        (F.col("txn_count") + F.col("_n_before")).alias("txn_count"),
        _added("_total", "_total_before").cast(money.TOTAL).alias("_total"),
        _added("_large", "_large_before").alias("_large"),
    )


def _added(a: str, b: str):
    """Sum of two partial sums, either of which may have seen no amount."""
    return F.coalesce(F.col(a) + F.col(b), F.col(a), F.col(b))


def _finish(df: DataFrame, opening: DataFrame | None) -> DataFrame:
    if opening is not None:
        # One opening row per user; the rows are the left side, which may be split when skewed.
        before = opening.select(
            F.col("user_id").alias("_user"), F.col("n").alias("_n"),
            F.col("total").alias("_before"), F.col("large").alias("_large_before"),
        )
        df = df.join(before, F.col("user_id").eqNullSafe(F.col("_user")), "left").withColumns(
            {
                "txn_count": F.col("txn_count") + F.coalesce("_n", F.lit(0)),
                "_total": _added("_total", "_before").cast(money.TOTAL),
                "_large": _added("_large", "_large_before"),
            }
        ).drop("_user", "_n", "_before", "_large_before")
    return df.withColumn("txn_total", money.known_total("_total", "_large")).drop("_total", "_large")
