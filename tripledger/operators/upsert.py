"""Keyed latest-wins merging."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Up to so many incoming keys may be broadcast, about 130 bytes each in memory.
FEW_KEYS = 200_000


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """The newest row per key; ties go to the greater values of the remaining columns.

    The rank limit is applied before the shuffle as well as after it, so copies of one key
    meet only as one row per map task.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in [*order, *rest]])
    ranked = df.withColumn("_rank", F.row_number().over(newest))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def same_key(left: str, right: str, keys: Sequence[str]):
    """Equality of keys in which NULL equals NULL."""
    return reduce(and_, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def asked_keys(incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of `incoming` as the side `f` of a join by `same_key`.

    Spark expects of a table what its compressed files weigh, and would broadcast millions of
    keys to every task. It has the choice while they are few; else both sides are sorted.
    """
    named = incoming.select(*keys)
    if incoming.count() > FEW_KEYS:
        named = named.hint("merge")
    return named.alias("f")


def replace_keys(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`target` in which all rows of the incoming keys give way to all rows of `incoming`."""
    kept = target.alias("t").join(asked_keys(incoming, keys), same_key("t", "f", keys), "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def upsert_latest(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: str | Sequence[str]
) -> DataFrame:
    """`target` with `incoming` merged in: one row per key, the incoming row wins.

    Duplicates within `incoming` collapse to the newest. Applying the same `incoming` twice
    changes nothing.
    """
    fresh = dedupe_latest(incoming, keys, order_by)
    kept = target.alias("t").join(asked_keys(incoming, keys), same_key("t", "f", keys), "left_anti")
    return kept.unionByName(fresh)
