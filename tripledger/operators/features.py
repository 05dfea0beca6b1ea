"""Per-user fraud features.

All features of exact counts come from one scan that folds payments (`operators.partials`). The
parts alone, and sketched counts, come from two-step aggregations: rows fold into one row per user and hour
(map-side, so a user with very many rows costs no more than the hours it spans), and only
those rows are then gathered by user. Distinct counts fold to one row per user and value
before they are counted. No step sorts rows or holds one user's transactions in a task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripledger import fixed_values as fv
from tripledger.functions import money
from tripledger.functions.scores import percentage, risk_score
from tripledger.operators import partials
from tripledger.operators.partials import DIVERSITY, PERIODS
from tripledger.operators.partials import slots as _slots
from tripledger.sources.scratch import materialize



PROFILE = (
    "avg_txn_amount", "stddev_txn_amount", "max_txn_amount", "min_txn_amount", *DIVERSITY, "failed_txn_count", "failed_txn_ratio")


def user_features(
    txns: DataFrame,
    *,
    grain: str = "clock",
    distinct: str = "exact",
    exact_amounts: bool = True,
    as_of: datetime | None = None,
) -> DataFrame:
    """One row per user: activity maxima, amounts, diversity, failures and risk score.

    `grain="clock"` counts by hour of day, date and ISO week number, over all days and years
    of the input; `"bucket"` by calendar hour, date and calendar week. `distinct="approx"`
    counts distinct values with sketches. `exact_amounts=False` adds amounts as doubles, which
    is quicker, but a task that runs again may change the last digits.
    """
    if distinct == "exact":  # one scan
        return partials.merge(partials.fold(txns, exact_amounts=exact_amounts), grain=grain, as_of=as_of)
    volume = user_volume(txns, grain=grain, exact_amounts=exact_amounts)
    profile = user_profile(txns, distinct=distinct, exact_amounts=exact_amounts)
    merged = _merge_users(volume, profile)
    return merged.select(
        "user_id",
        *[c for c in merged.columns if c != "user_id"],
        (F.lit(as_of) if as_of else F.current_timestamp()).alias("feature_extraction_time"),
        risk_score().alias("risk_score"),
    )


def user_volume(txns: DataFrame, *, grain: str = "clock", exact_amounts: bool = True) -> DataFrame:
    """Greatest count and amount of a user in any hour, day and week."""
    per_hour = _per_user_hour(txns, exact_amounts).repartition("user_id")
    slots = per_hour.select(
        "user_id", "n", "total", "large", F.inline(F.array(*[
            F.struct(F.lit(p).alias("period"), slot.alias("slot"))
            for p, slot in zip(PERIODS, _slots(grain))
        ])),
    )
    # Everything below is local: the rows are partitioned by user.
    per_slot = slots.groupBy("user_id", "period", "slot").agg(
        F.sum("n").alias("n"), money.known_total(F.sum("total"), F.sum("large")).alias("total")
    )
    return per_slot.groupBy("user_id").agg(
        *[F.max(F.when(F.col("period") == p, F.col("n"))).alias(f"max_txn_count_{p}") for p in PERIODS],
        *[
            F.max(F.when(F.col("period") == p, F.col("total"))).alias(f"max_txn_amount_{p}")
            for p in PERIODS
        ],
    )


def user_profile(
    txns: DataFrame, *, distinct: str = "exact", exact_amounts: bool = True
) -> DataFrame:
    """Amount statistics, distinct places/devices/addresses/cards, failures of every user."""
    sums = txns.groupBy("user_id").agg(*_amount_parts(exact_amounts), *_failure_parts())
    sums = sums.select("user_id", *_amount_stats(), "failed_txn_count", _failed_ratio())
    # Exact distinct counts multiply the rows they read; the sums stay out of that.
    merged = _merge_users(sums, user_diversity(txns, distinct=distinct))
    return merged.select("user_id", *PROFILE)


def user_amounts(txns: DataFrame, *, exact_amounts: bool = True) -> DataFrame:
    return txns.groupBy("user_id").agg(*_amount_parts(exact_amounts)).select("user_id", *_amount_stats())


def user_diversity(txns: DataFrame, *, distinct: str = "exact") -> DataFrame:
    return txns.groupBy("user_id").agg(*_diversity(distinct))


def user_failures(txns: DataFrame) -> DataFrame:
    return (
        txns.groupBy("user_id").agg(*_failure_parts())
        .select("user_id", "failed_txn_count", _failed_ratio())
    )


def transaction_context(txns: DataFrame, *, grain: str = "clock") -> DataFrame:
    """Every transaction with the counts and amounts of its hour, day and week, and its
    user's amount, diversity and failure values (the row-level form of the features).

    The values are computed on the folded rows and joined back, instead of a window over
    all of a user's transactions; the large side of the join may be split when skewed.
    """
    hour_slot, day_slot, week_slot = _slots(grain)
    # Folded once, small, and read twice: payments are scanned for it and for the rows themselves.
    folded = materialize(partials.fold(txns), "folded")
    per_hour = (
        folded.filter(F.col("kind") == partials.SUMS).select("user_id", "day", "hour", "n", "total", "large")
        .repartition("user_id")
        .withColumns({"slot_hourly": hour_slot, "slot_daily": day_slot, "slot_weekly": week_slot})
    )
    columns: dict[str, Column] = {}
    for p in PERIODS:
        peers = Window.partitionBy("user_id", f"slot_{p}")
        columns[f"txn_count_{p}"] = F.sum("n").over(peers)
        columns[f"txn_amount_{p}"] = money.known_total(F.sum("total").over(peers), F.sum("large").over(peers))
    hours = per_hour.withColumns(columns).select("user_id", "day", "hour", *columns)
    users = partials.merge(folded, grain=grain).select("user_id", *PROFILE)
    context = hours.alias("h").join(users.alias("u"), F.col("h.user_id").eqNullSafe(F.col("u.user_id")))
    context = context.select("h.*", *[f"u.{c}" for c in users.columns if c != "user_id"])
    rows = txns.select("transaction_id", "user_id", "event_time", "amount", *_hour_key())
    return rows.alias("t").join(
        context.alias("c"),
        F.col("t.user_id").eqNullSafe(F.col("c.user_id"))
        & F.col("t.day").eqNullSafe(F.col("c.day"))
        & F.col("t.hour").eqNullSafe(F.col("c.hour")),
        "left",
    ).select(
        "t.transaction_id", "t.user_id", "t.event_time", "t.amount",
        *[f"c.{c}" for c in context.columns if c not in ("user_id", "day", "hour")],
    )


def high_risk(features: DataFrame, limit: float = fv.HIGH_RISK_ABOVE) -> DataFrame:
    return features.filter(F.col("risk_score") > limit)


def summarize(features: DataFrame, limit: float = fv.HIGH_RISK_ABOVE) -> DataFrame:
    """Users, high-risk users and their percentage."""
    counts = features.agg(
        F.count(F.lit(1)).alias("user_count"),
        F.count_if(F.col("risk_score") > limit).alias("high_risk_count"),
    )
    return counts.withColumn("high_risk_pct", percentage("high_risk_count", "user_count"))


# ---------------------------------------------------------------- parts


def _merge_users(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns of two relations with one row per user. Both are partitioned by user already;
    a union keeps the group of rows without user, which a join would lose."""
    both = left.unionByName(right, allowMissingColumns=True)
    return both.groupBy("user_id").agg(*[F.max(c).alias(c) for c in both.columns if c != "user_id"])


def _hour_key() -> list[Column]:
    return [F.to_date("event_time").alias("day"), F.hour("event_time").alias("hour")]


def _per_user_hour(txns: DataFrame, exact_amounts: bool = True) -> DataFrame:
    fine, coarse = money.parts("amount", exact_amounts)
    return (
        txns.select("user_id", "transaction_id", "amount", *_hour_key())
        .groupBy("user_id", "day", "hour")
        .agg(
            F.count("transaction_id").alias("n"),
            F.sum(fine).alias("total"),
            F.sum(coarse).alias("large"),
        )
    )


def _amount_parts(exact_amounts: bool = True) -> list[Column]:
    fine, coarse = money.parts("amount", exact_amounts)
    cents = money.whole_cents("amount")
    if not exact_amounts:
        cents = F.when(F.lit(False), cents)
    return [
        F.count("amount").alias("n_amount"),
        F.sum(fine).alias("sum_amount"),
        F.sum(coarse).alias("sum_large"),
        F.count(cents).alias("n_cents"),
        F.sum(cents).alias("sum_cents"),
        F.sum(cents * cents).alias("sum_squares"),
        F.stddev_samp("amount").alias("stddev_streamed"),
        F.max("amount").alias("max_txn_amount"),
        F.min("amount").alias("min_txn_amount"),
    ]


def _amount_stats() -> list[Column]:
    n = F.col("n_amount")
    deviation = money.sample_stddev(
        F.col("sum_cents"), F.col("sum_squares"), F.col("n_cents"), n, F.col("stddev_streamed")
    )
    return [
        money.mean(money.known_total("sum_amount", "sum_large"), n).alias("avg_txn_amount"),
        deviation.alias("stddev_txn_amount"),
        F.col("max_txn_amount"),
        F.col("min_txn_amount"),
    ]


def _diversity(distinct: str) -> list[Column]:
    count = {"exact": F.count_distinct, "approx": F.approx_count_distinct}[distinct]
    return [count(F.col(source)).alias(name) for name, source in DIVERSITY.items()]


def _failure_parts() -> list[Column]:
    return [
        F.count("transaction_id").alias("n_txn"),
        F.count_if(F.col("status").isin(*fv.FAILED_STATUSES)).alias("failed_txn_count"),
    ]


def _failed_ratio() -> Column:
    return F.try_divide(F.col("failed_txn_count"), F.col("n_txn")).alias("failed_txn_ratio")
