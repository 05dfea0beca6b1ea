"""Shares and the risk score."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripledger import fixed_values as fv


def percentage(part: str, whole: str) -> Column:
    """Percent with two decimals, rounded half up on integers; NULL when the whole is zero."""
    return F.expr(
        f"CASE WHEN {whole} > 0 "
        f"THEN CAST(({part} * 20000 + {whole}) DIV ({whole} * 2) AS DOUBLE) / 100.0D END"
    )


def risk_score() -> Column:
    """Weighted sum of the user features that `RISK_WEIGHTS` names, in that order."""
    return reduce(add, [F.col(name) * F.lit(weight) for name, weight in fv.RISK_WEIGHTS])
