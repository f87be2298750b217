"""Joins of values with intervals, by bins instead of a comparison of all pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_bands(values: DataFrame, value: str, bands: DataFrame, low: str, high: str, width: float) -> DataFrame:
    """`values` LEFT JOIN `bands` on `value` between `low` and `high`, both ends included.

    Every band is listed in the bins of `width` that it touches, a value lies in
    one bin, so the join is on the bin and each pair meets once. Choose `width`
    near the usual length of a band. A NULL value, and one that no band covers,
    keeps its row with NULLs; one that several bands cover has a row for each.
    Bands with a NULL end, or whose ends are the wrong way round, cover nothing.
    """
    bin_of = lambda column: F.floor(F.col(column) / F.lit(width)).cast("bigint")
    listed = (
        bands.where(F.col(low) <= F.col(high))
        .withColumn("_bin", F.explode(F.sequence(bin_of(low), bin_of(high))))
        .withColumnsRenamed({low: "_low", high: "_high"})
    )
    placed = values.withColumn("_value_bin", bin_of(value))
    within = (F.col("_value_bin") == F.col("_bin")) & (F.col(value) >= F.col("_low")) & (F.col(value) <= F.col("_high"))
    return placed.join(listed, within, "left").drop("_value_bin", "_bin", "_low", "_high")
