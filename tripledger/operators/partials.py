"""User features from partial aggregates that can be kept and merged.

`fold` reads every payment once and folds it, map-side, to rows of two kinds: the sums of a user
in an hour of a day, and each distinct place, device, address or card of a user on a day. `merge`
makes features from any number of such rows. Rows of different days never meet before `merge`,
so a table of folded days serves every window of whole days: a run folds its new days and merges
them with those kept (`sources.folds`).

Every step aggregates before it shuffles, by user and something else first, so that no task holds
or sorts one user's payments or distinct values.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger import fixed_values as fv
from tripledger.functions import money
from tripledger.functions.scores import risk_score

PERIODS = ("hourly", "daily", "weekly")
GRAINS = ("clock", "bucket")
#: Feature -> column whose distinct values it counts.
DIVERSITY = {
    "location_count": "location",
    "device_count": "device_id",
    "ip_count": "ip_address",
    "card_type_count": "card_type",
}
SUMS = "sums"
_ROW = {"hour": "int", "value": "string", "one": "int", "bad": "int", "x": "double",
        "fine": money.AMOUNT, "coarse": "double", "cents": "decimal(12,2)"}


def fold(txns: DataFrame, *, exact_amounts: bool = True) -> DataFrame:
    """`user_id`, `day`, `kind` and either an `hour` with its sums or a distinct `value`."""
    fine, coarse = money.parts("amount", exact_amounts)
    cents = money.whole_cents("amount") if exact_amounts else F.when(F.lit(False), money.whole_cents("amount"))
    day, hour = F.to_date("event_time"), F.hour("event_time")

    def row(kind: str, **known: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), *[
            known.get(name, F.lit(None)).cast(t).alias(name) for name, t in _ROW.items()])

    rows = F.array(
        row(SUMS, hour=hour, one=F.col("transaction_id").isNotNull(),
            bad=F.coalesce(F.col("status").isin(*fv.FAILED_STATUSES), F.lit(False)),
            x=F.col("amount"), fine=fine, coarse=coarse, cents=cents),
        *[row(column, value=F.col(column)) for column in DIVERSITY.values()],
    )
    spread = txns.select("user_id", day.alias("day"), F.inline(rows)).where(
        (F.col("kind") == SUMS) | F.col("value").isNotNull())
    return spread.groupBy("user_id", "day", "kind", "hour", "value").agg(
        F.sum("one").alias("n"),
        F.sum("bad").alias("failed"),
        F.sum("fine").alias("total"),
        F.sum("coarse").alias("large"),
        F.count("x").alias("n_amount"),
        F.count("cents").alias("n_cents"),
        F.sum("cents").alias("sum_cents"),
        F.sum(F.col("cents") * F.col("cents")).alias("sum_squares"),
        F.avg("x").alias("mean"),
        F.var_pop("x").alias("variance"),
        F.max("x").alias("high"),
        F.min("x").alias("low"),
    )


def merge(folded: DataFrame, *, grain: str = "clock", as_of: datetime | None = None) -> DataFrame:
    """The features of `operators.features.user_features` from folded rows."""
    periods = F.when(F.col("kind") == SUMS, F.array(*[
        F.struct(F.lit(p).alias("period"), slot.alias("slot")) for p, slot in zip(PERIODS, slots(grain))
    ])).otherwise(F.array(F.struct(F.col("kind").alias("period"), F.lit(0).cast("long").alias("slot"))))
    moment = F.when(F.col("kind") == SUMS, F.struct("n_amount", "mean", "variance"))
    spread = folded.select(*folded.columns, moment.alias("moment"), F.inline(periods))
    per_slot = spread.groupBy("user_id", "period", "slot", "value").agg(
        F.sum("n").alias("n"), F.sum("total").cast(money.TOTAL).alias("total"), F.sum("large").alias("large"),
        *[F.sum(c).alias(c) for c in ("failed", "n_amount", "n_cents")],
        # The types of a single sum, so that products of them keep their room.
        F.sum("sum_cents").cast("decimal(22,2)").alias("sum_cents"),
        F.sum("sum_squares").cast("decimal(35,4)").alias("sum_squares"),
        F.max("high").alias("high"), F.min("low").alias("low"),
        # At most the hours of a day.
        F.collect_list(F.when(F.col("period") == "daily", F.col("moment"))).alias("moments"),
    )

    def in_period(p: str, column: Column) -> Column:
        return F.when(F.col("period") == p, column)

    def over_days(name: str, kind: str) -> Column:
        return F.sum(in_period("daily", F.col(name))).cast(kind).alias(name)

    slot_total = money.known_total("total", "large")
    users = per_slot.groupBy("user_id").agg(
        *[F.max(in_period(p, F.col("n"))).alias(f"max_txn_count_{p}") for p in PERIODS],
        *[F.max(in_period(p, slot_total)).alias(f"max_txn_amount_{p}") for p in PERIODS],
        *[over_days(c, "long") for c in ("n", "failed", "n_amount", "n_cents")],
        over_days("total", f"decimal(38,{money.PLACES})"), over_days("large", "double"),
        over_days("sum_cents", "decimal(22,2)"), over_days("sum_squares", "decimal(35,4)"),
        F.max("high").alias("max_txn_amount"), F.min("low").alias("min_txn_amount"),
        *[F.count(in_period(column, F.lit(1))).alias(name) for name, column in DIVERSITY.items()],
        F.sort_array(F.flatten(F.collect_list("moments"))).alias("moments"),
    )
    n = F.col("n_amount")
    deviation = money.sample_stddev(F.col("sum_cents"), F.col("sum_squares"), F.col("n_cents"), n, _deviation("moments"))
    scored = users.select(
        "user_id",
        *[f"max_txn_count_{p}" for p in PERIODS], *[f"max_txn_amount_{p}" for p in PERIODS],
        money.mean(money.known_total("total", "large"), n).alias("avg_txn_amount"),
        deviation.alias("stddev_txn_amount"), "max_txn_amount", "min_txn_amount", *DIVERSITY,
        F.col("failed").alias("failed_txn_count"),
        F.try_divide(F.col("failed"), F.col("n")).alias("failed_txn_ratio"),
        (F.lit(as_of) if as_of else F.current_timestamp()).alias("feature_extraction_time"),
    )
    return scored.withColumn("risk_score", risk_score())


def slots(grain: str) -> tuple[Column, Column, Column]:
    """Hour, day and week of a folded row, as numbers."""
    if grain not in GRAINS:
        raise ValueError(f"grain is one of {GRAINS}")
    day = F.unix_date("day").cast("long")
    if grain == "clock":
        return F.col("hour").cast("long"), day, F.weekofyear("day").cast("long")
    week = F.unix_date(F.to_date(F.date_trunc("week", F.col("day")))).cast("long")
    return day * 24 + F.col("hour"), day, week


def _deviation(moments: str) -> Column:
    """Sample deviation from (rows, mean, population variance) of parts, as many as the hours seen."""
    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(a: Column, part: Column) -> Column:
        k = part["n_amount"].cast("double")
        n, apart = a["n"] + k, part["mean"] - a["mean"]
        both = F.struct(
            n.alias("n"), (a["mean"] + apart * k / n).alias("mean"),
            (a["m2"] + part["variance"] * k + apart * apart * a["n"] * k / n).alias("m2"))
        return F.when(k > 0, both).otherwise(a)

    def finish(a: Column) -> Column:
        return F.when(a["n"] > 1, F.sqrt(a["m2"] / (a["n"] - 1)))

    return F.aggregate(moments, start, add, finish)
