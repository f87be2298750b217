"""Exact sets of days per key, as bitmaps that merge over batches.

A day is a bit. The bitmaps of two batches, or of a batch that came twice, are
or-ed, so a day counts once however often it is delivered, and what is stored
per key doesn't grow with its rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPOCH = dt.date(1970, 1, 1)


def day_sets(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """keys, _bucket, _days: the days of each key; rows without a day make an empty set.

    A bitmap spans 32,768 days, so there is a second bucket only for days
    some 90 years from 1970.
    """
    number = F.datediff(day, F.lit(EPOCH)).cast("bigint")
    return (
        df.groupBy(*keys, F.bitmap_bucket_number(number).alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_days"))
    )


def merged(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One set per key (and bucket) from the sets of several batches."""
    return sets.groupBy(*keys, "_bucket").agg(F.bitmap_or_agg("_days").alias("_days"))


def count_days(sets: DataFrame, keys: Sequence[str], name: str = "days") -> DataFrame:
    """The number of days of each key over merged sets."""
    return sets.groupBy(*keys).agg(F.sum(F.bitmap_count("_days")).alias(name))
