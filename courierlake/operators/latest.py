"""One row per key, the latest one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RECENCY = ("_ingested_at", "_batch_id")


def latest_rows(
    df: DataFrame, keys: Sequence[str], recency: Sequence[str] = RECENCY
) -> DataFrame:
    """The most recently ingested row of each key.

    One batch has one ingest time, so the remaining columns break ties: the
    winner does not depend on how rows were spread over tasks.

    `row_number() = 1` lets Spark keep one row per key in every map task
    before the shuffle, so a key with very many copies stays cheap.
    """
    first = [name for name in recency if name in df.columns]
    rest = [name for name in df.columns if name not in first and name not in keys]
    order = [F.col(name).desc_nulls_last() for name in [*first, *rest]]
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_row_number", F.row_number().over(window))
        .where(F.col("_row_number") == 1)
        .drop("_row_number")
    )
