"""Ratios and means that are safe under ANSI mode and under task retries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_of(part: Column, whole: Column) -> Column:
    """`part` as a percentage of `whole`, unrounded; NULL when `whole` is 0."""
    return part * F.lit(100.0) / F.nullif(whole, F.lit(0))


def percent_change(now: Column, before: Column) -> Column:
    """Change from `before` to `now` in percent, rounded to 2."""
    return F.round(percent_of(now - before, before), 2)


def mean_of_rounded(value: Column, scale: int) -> Column:
    """Average of doubles that were already rounded to `scale` decimals.

    The sum runs on decimals, which is exact for such values: a plain sum of
    doubles depends on the order in which tasks finish, and a retry could move
    a result across a rounding edge.
    """
    total = F.sum(value.cast(f"decimal(30,{scale})")).cast("double")
    return total / F.nullif(F.count(value), F.lit(0))
