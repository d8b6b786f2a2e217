"""Money, quantities and ratios. Sums stay decimal, so no result depends on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(18,4)"
FINE_AMOUNT = "decimal(18,6)"


def line_amount(quantity: str | Column, price: str | Column) -> Column:
    """quantity x price with the four decimals that two decimal(12,2) factors can give."""
    return (_col(quantity) * _col(price)).cast(AMOUNT)


def safe_ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Unrounded double quotient; NULL when the denominator is zero or NULL."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def growth(current: str | Column, previous: str | Column) -> Column:
    """Relative change against the previous value; NULL without one."""
    return safe_ratio(_col(current) - _col(previous), previous)


def allocate(amount: str | Column, part: str | Column, whole: str | Column) -> Column:
    """The share of `amount` that falls to `part` of `whole`, to six decimals; 0 if `whole` is not positive."""
    share = _col(amount).cast("double") * safe_ratio(part, whole)
    return F.coalesce(F.when(_col(whole) > 0, F.round(share, 6)), F.lit(0.0)).cast(FINE_AMOUNT)


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
