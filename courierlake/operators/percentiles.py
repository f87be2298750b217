"""Exact percentiles of integers per group, without gathering any group.

The built-in exact percentile holds every distinct value of a group in one
buffer. Here the values are counted first and located in two steps: a running
count over slices of `SLICE` consecutive values finds the slice that holds a
wanted position, then a running count inside that slice finds the value. A
task never holds more than the slices of one group or the at most `SLICE`
values of one slice, and both windows spill.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = 1_000_000


# How a figure of a slice and that of its group are made; each may be applied twice.
FOLDS = {"sum": F.sum, "min": F.min, "max": F.max}


def grouped_percentiles(
    counted: DataFrame,
    key: str,
    value: str,
    weight: str,
    fractions: Mapping[str, str],
    figures: Mapping[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """Interpolated percentiles, one row per `key` and one column per fraction.

    `counted` has one row per (`key`, `value`) with the number of occurrences
    in `weight`; `value` is an integer. NULL keys form a group. Fractions are
    decimal texts such as "0.95": positions and interpolation are exact, and
    only the result is a double.

    `figures` are further columns of the result: the `sum`, `min` or `max` of
    an expression over the rows of `counted`. They are folded along with the
    slices, without a shuffle of their own.
    """
    figures = figures or {}
    in_group = Window.partitionBy(key).orderBy("_slice")
    to_here = in_group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = in_group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    sliced = counted.select(
        key,
        F.floor(F.col(value) / F.lit(SLICE)).alias("_slice"),
        F.col(value).alias("_value"),
        F.col(weight).alias("_weight"),
        *(expression.alias(f"_f_{name}") for name, (_, expression) in figures.items()),
    )
    # Each wanted fraction sits between two zero-based positions.
    ends = {
        (name, end): rounded(_position(fraction)).cast("bigint")
        for name, fraction in fractions.items()
        for end, rounded in (("low", F.floor), ("high", F.ceil))
    }
    slices = (
        sliced.groupBy(key, "_slice")
        .agg(
            F.sum("_weight").alias("_weight"),
            *(FOLDS[fold](f"_f_{name}").alias(f"_f_{name}") for name, (fold, _) in figures.items()),
        )
        .withColumns({f"_f_{name}": FOLDS[fold](f"_f_{name}").over(whole) for name, (fold, _) in figures.items()})
        .withColumn("_upto", F.sum("_weight").over(to_here))
        .withColumn("_total", F.sum("_weight").over(whole))
        .withColumn("_before", F.col("_upto") - F.col("_weight"))
    )
    hit = _holds_any(list(ends.values()), F.col("_before"), F.col("_upto"))
    wanted = slices.where(hit).select(
        F.col(key).alias("_key"),
        F.col("_slice").alias("_wanted"),
        "_before",
        "_total",
        *(F.col(f"_f_{name}").alias(name) for name in figures),
    )

    in_slice = (
        Window.partitionBy(key, "_slice")
        .orderBy("_value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    candidates = (
        sliced.select(key, "_slice", "_value", "_weight").join(
            wanted,
            F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_wanted")),
        )
        .withColumn("_upto", F.col("_before") + F.sum("_weight").over(in_slice))
        .withColumn("_from", F.col("_upto") - F.col("_weight"))
    )
    at_ends = candidates.groupBy(key).agg(
        F.max("_total").alias("_total"),
        *(F.max(name).alias(name) for name in figures),
        *(
            F.max(F.when(_holds(position, F.col("_from"), F.col("_upto")), F.col("_value"))).alias(
                f"_{name}_{end}"
            )
            for (name, end), position in ends.items()
        ),
    )
    return at_ends.select(
        key, *figures, *(_interpolated(name, fraction).alias(name) for name, fraction in fractions.items())
    )


def _position(fraction: str) -> Column:
    return F.lit(Decimal(fraction)) * (F.col("_total") - 1)


def _interpolated(name: str, fraction: str) -> Column:
    low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
    beyond = _position(fraction) - F.floor(_position(fraction))
    return (low + beyond * (high - low)).cast("double")


def _holds(position: Column, start: Column, end: Column) -> Column:
    return (position >= start) & (position < end)


def _holds_any(positions: list[Column], start: Column, end: Column) -> Column:
    found = F.lit(False)
    for position in positions:
        found = found | _holds(position, start, end)
    return found
