"""The choice of each key that weighs most."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def heaviest_choice(
    df: DataFrame, keys: Sequence[str], choice: str, weight: Column | None = None, name: str = "weight"
) -> DataFrame:
    """keys, `choice`, its weight as `name`, the key's `total_<name>` and number of `choices`.

    Weights (by default one per row) are added per key and choice first, which
    spreads a key with very many rows, then compared per key. Of equal weights
    the smallest choice wins. Rows without a key or a choice don't take part.
    """
    for column in (*keys, choice):
        df = df.where(F.col(column).isNotNull())
    per_choice = df.groupBy(*keys, choice).agg((F.sum(weight) if weight is not None else F.count(F.lit(1))).alias("_w"))
    best = F.min(F.struct((-F.col("_w")).alias("_minus"), F.col(choice).alias("_choice")))
    return (
        per_choice.groupBy(*keys)
        .agg(best.alias("_best"), F.sum("_w").alias(f"total_{name}"), F.count(F.lit(1)).alias("choices"))
        .select(
            *keys,
            F.col("_best._choice").alias(choice),
            (-F.col("_best._minus")).alias(name),
            f"total_{name}",
            "choices",
        )
    )
