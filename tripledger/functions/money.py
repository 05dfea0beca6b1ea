"""Sums of amounts that lose nothing and never fail.

Amounts are doubles of any size. Sums of doubles depend on the order in which shuffle blocks
arrive, so a retried task may change the last digits; decimals do not. An amount below 10^16
is therefore added as a decimal with ten places, far below any currency's smallest unit. From
10^16 on, doubles are whole numbers and are added as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FINE_BELOW = 1e16
PLACES = 10
AMOUNT = T.DecimalType(26, PLACES)
TOTAL = T.DecimalType(38, PLACES)
# Amounts of whole cents below this have squares whose exact sums fit a decimal.
CENTS_BELOW = 1e9
_CENTS = T.DecimalType(12, 2)


def _column(amount: Column | str) -> Column:
    return F.col(amount) if isinstance(amount, str) else amount


def fine(amount: Column | str) -> Column:
    """The amount as a decimal; NULL where it is unknown or `coarse` has it."""
    amount = _column(amount)
    return F.when(F.abs(amount) < FINE_BELOW, amount.cast(AMOUNT))


def coarse(amount: Column | str) -> Column:
    """The amount as a double where `fine` cannot hold it, else NULL."""
    amount = _column(amount)
    return F.when(~(F.abs(amount) < FINE_BELOW), amount)


def parts(amount: Column | str, exact: bool = True) -> tuple[Column, Column]:
    """`fine` and `coarse`, or all amounts as doubles."""
    if exact:
        return fine(amount), coarse(amount)
    return F.lit(None).cast(AMOUNT), _column(amount)


def known_total(fine_sum: Column | str, coarse_sum: Column | str) -> Column:
    """Both parts as one double; NULL if no amount is known."""
    fine_sum, coarse_sum = _column(fine_sum), _column(coarse_sum)
    double = fine_sum.cast("double")
    return F.when(coarse_sum.isNull(), double).otherwise(F.coalesce(double, F.lit(0.0)) + coarse_sum)


def mean(total: Column, n: Column) -> Column:
    """Mean of `n` amounts; NULL without rows."""
    return F.try_divide(total, n.cast("double"))


def whole_cents(amount: Column | str) -> Column:
    """The amount in decimals of two places where that is all of it and it is small, else NULL."""
    amount = _column(amount)
    cents = F.when(F.abs(amount) < CENTS_BELOW, amount.cast(_CENTS))
    return F.when(cents.cast("double") == amount, cents)


def sample_stddev(total: Column, squares: Column, n_cents: Column, n: Column, streamed: Column) -> Column:
    """Sample deviation; NULL below two rows.

    `total` and `squares` are exact sums over the `n_cents` amounts of whole cents. If those are
    all amounts, the difference is taken in decimals and no digits cancel before the division;
    otherwise `streamed`, the engine's own running deviation, stands.
    """
    spread = F.try_subtract(
        F.try_multiply(n.cast(T.DecimalType(20, 0)), squares), F.try_multiply(total, total)
    )
    pairs = n.cast("double") * (n.cast("double") - F.lit(1.0))
    exact = F.when(n_cents == n, F.sqrt(spread.cast("double") / pairs))
    return F.when(n > 1, F.coalesce(exact, streamed))
