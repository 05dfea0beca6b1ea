"""Presence, amount and status comparisons between channels, and the verdict."""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripledger import fixed_values as fv
from tripledger.functions import money

CHANNELS = tuple(fv.TOPICS)


def any_of(conditions) -> Column:
    return reduce(or_, conditions)


def presence(id_column: Column) -> Column:
    return F.when(id_column.isNull(), fv.MISSING).otherwise(fv.PRESENT)


def amount_check(left: Column, right: Column, tolerance: float, exact: bool = False) -> Column:
    """'match' or 'mismatch'; NULL when either amount is unknown.

    `exact=True` compares decimals, so that one cent of difference is one cent.
    """
    if exact:
        fine = F.abs(money.fine(left) - money.fine(right)) > F.lit(str(tolerance)).cast(money.AMOUNT)
        apart = F.coalesce(fine, F.abs(left - right) > F.lit(float(tolerance)))
    else:
        apart = F.abs(left - right) > F.lit(float(tolerance))
    return F.when(apart, fv.MISMATCH).when(apart.isNotNull(), fv.MATCH)


def pair_name(left: str, right: str) -> str:
    return f"{left}_{right}_amount_check"


def status_differs(channels=CHANNELS) -> Column:
    """True if two known statuses differ; unknown statuses do not differ."""
    pairs = combinations(channels, 2)
    return any_of(F.col(f"{a}_status") != F.col(f"{b}_status") for a, b in pairs)


def verdict(channels=CHANNELS) -> Column:
    """First of: a channel misses it, amounts differ, statuses differ; else reconciled."""
    incomplete, amounts, statuses, fine = fv.VERDICTS
    gaps = any_of(F.col(f"{c}_presence") == fv.MISSING for c in channels)
    off = any_of(F.col(pair_name(a, b)) == fv.MISMATCH for a, b in combinations(channels, 2))
    return (
        F.when(gaps, incomplete)
        .when(off, amounts)
        .when(status_differs(channels), statuses)
        .otherwise(fine)
    )
