"""Approximate percentiles from summaries that are stored and merged.

A KLL sketch of a group holds a bounded number of values, whatever the group's
size, and sketches of days merge to one of all days. The rank of an answer is
off by at most `RANK_ERROR` of the group's rows; groups of fewer than `K` values
are exact. Where the exact value is wanted, see :mod:`percentiles`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# With 2,000 the sketch's own bound is 0.2 % at 99 % confidence; stated with room.
K, RANK_ERROR = 2000, 0.005


def summaries(df: DataFrame, keys: Sequence[str], value: str, k: int = K) -> DataFrame:
    """keys, _sketch: a summary of the whole number `value` per group; NULLs are left out."""
    rows = df.where(F.col(value).isNotNull())
    return rows.groupBy(*keys).agg(
        F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), F.lit(k)).alias("_sketch")
    )


def merged(parts: DataFrame, keys: Sequence[str], k: int = K) -> DataFrame:
    """One summary per group from those of its parts."""
    return parts.groupBy(*keys).agg(F.kll_merge_agg_bigint("_sketch", F.lit(k)).alias("_sketch"))


def approximate_percentiles(parts: DataFrame, keys: Sequence[str], fractions: Mapping[str, float]) -> DataFrame:
    """keys, the number of values, and one column per fraction."""
    return parts.select(
        *keys,
        F.kll_sketch_get_n_bigint("_sketch").alias("n"),
        *(F.kll_sketch_get_quantile_bigint("_sketch", F.lit(f)).alias(name) for name, f in fractions.items()),
    )


def rank_errors(
    found: DataFrame, counted: DataFrame, key: str, value: str, weight: str, fractions: Mapping[str, float]
) -> DataFrame:
    """key, n and per fraction how far the found value's rank is from it, as a share of the rows.

    `counted` holds the exact number of occurrences per (key, value). A value
    covers the ranks from the rows below it to those up to it.
    """
    rows = counted.join(found.drop("n"), key)
    sums = rows.groupBy(key).agg(
        F.sum(weight).alias("n"),
        *(
            F.sum(F.when(test, F.col(weight)).otherwise(0)).alias(f"_{side}_{name}")
            for name in fractions
            for side, test in (("below", F.col(value) < F.col(name)), ("upto", F.col(value) <= F.col(name)))
        ),
    )
    errors = {
        f"{name}_rank_error": F.greatest(
            F.col(f"_below_{name}") / F.col("n") - F.lit(f), F.lit(f) - F.col(f"_upto_{name}") / F.col("n"), F.lit(0.0)
        )
        for name, f in fractions.items()
    }
    return sums.select(key, "n", *(error.alias(name) for name, error in errors.items()))
