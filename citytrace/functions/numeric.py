"""Guards and roundings of doubles."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(value: Column) -> Column:
    """The value as a double; unreadable text, NaN and infinities become NULL."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < math.inf), number)


def at_least(value: Column, floor: float) -> Column:
    return F.greatest(value, F.lit(floor))


def clip(value: Column, low, high) -> Column:
    as_column = lambda bound: bound if isinstance(bound, Column) else F.lit(bound)
    return F.least(F.greatest(value, as_column(low)), as_column(high))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """Rounded percentage; 0 when the whole is empty."""
    share = F.try_divide(part.cast("double"), whole.cast("double")) * 100.0
    return F.round(F.coalesce(share, F.lit(0.0)), digits)


def weighted_sum(low: Column, low_share: Column, high: Column, high_share: Column) -> Column:
    """``low * low_share + high * high_share`` with the first product unrounded, as ``quantile_cont`` sums.

    A threshold compared with ``>=`` depends on the last bit. The rounding errors of the product and
    of the sum are found exactly (factors in halves of 26 bits) and added back. Factors that are too
    large to be halved are summed plainly.
    """
    split = F.lit(134217729.0)

    def halves(x: Column) -> tuple[Column, Column]:
        top = split * x - (split * x - x)
        return top, x - top

    (a, b), (c, d) = halves(low), halves(low_share)
    first, second = low * low_share, high * high_share
    lost = ((a * c - first) + a * d + b * c) + b * d
    total = first + second
    part = total - first
    gone = (first - (total - part)) + (second - part)
    return F.when(F.abs(low) < 1e290, total + (gone + lost)).otherwise(total)
