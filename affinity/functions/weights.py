"""Interaction-weight expressions.

NULL / NaN rules (ANSI mode is on, so no bare division):

- price NULL                                        -> ratio NULL (the row adds nothing)
- price NaN, max price missing / NaN / 0            -> ratio 1.0
- otherwise                                          -> price / max_price
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def price_ratio(price: Column, max_price: Column) -> Column:
    """Price over its canonical price, undefined ratios replaced by 1.0."""
    undefined = F.isnan(price) | max_price.isNull() | F.isnan(max_price) | (max_price == 0.0)
    return (
        F.when(price.isNull(), F.lit(None).cast("double"))
        .when(undefined, F.lit(1.0))
        .otherwise(F.try_divide(price, max_price))
    )


def price_weight(ratio: Column, strength: float) -> Column:
    """``ratio * s + (1 - s)``; s = 0 ignores price, s = 1 is proportional."""
    s = float(strength)
    return ratio * F.lit(s) + F.lit(1.0 - s)


def time_weight(days_ago: Column, strength: float) -> Column:
    """``exp(-k * days)``; k = 0 gives 1 for every row."""
    return F.exp(F.lit(-float(strength)) * days_ago)


def combined_weight(price_w: Column, time_w: Column) -> Column:
    """Product of the two weights."""
    return price_w * time_w


def positive_weight(weight: Column) -> Column:
    """F2 predicate: weight > 0 and a number (NaN > 0 is TRUE in Spark)."""
    return (weight > 0) & ~F.isnan(weight)
