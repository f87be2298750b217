"""Parquet folders partitioned by day of which single days are replaced."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from courierlake.session import scratch_path
from courierlake.sources.lake import by_partition, whole_width


def distinct_days(df: DataFrame, day: str) -> list[dt.date | None]:
    """The days in `df`: one value per calendar day, so their number is bounded."""
    found = {row[0] for row in df.select(day).distinct().collect()}
    return sorted(found, key=lambda value: (value is not None, value))


def on_days(day: str, days: Iterable[dt.date | None]) -> Column:
    """Is the row's day among `days`; written with literals, so that partitions are pruned."""
    days = list(days)
    known = [value for value in days if value is not None]
    found = F.col(day).isin(known) if known else F.lit(False)
    return found | F.col(day).isNull() if None in days else found


def read_days(
    spark: SparkSession, path: str, schema: StructType, day: str, days: Iterable[dt.date | None] | None = None
) -> DataFrame:
    """The rows below `path`, of `days` or of all; none if nothing was written yet."""
    try:
        stored = spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return stored if days is None else stored.where(on_days(day, days))


def replace_days(df: DataFrame, path: str, day: str, days: Iterable[dt.date | None]) -> None:
    """Make `df` the whole content of `days` below `path`; other days stay as they are.

    `df` may read the same folder: it is written elsewhere first. A day that
    loses its last row is left with an empty file, as dynamic overwrite doesn't
    touch days that no row belongs to.
    """
    spark = df.sparkSession
    staged_path = scratch_path(spark, "days")
    df.write.parquet(staged_path)
    staged = spark.read.schema(df.schema).parquet(staged_path)
    empty = set(days) - set(distinct_days(staged, day))
    emptied = distinct_days(read_days(spark, path, df.schema, day, empty), day) if empty else []
    with whole_width(spark):
        rows = by_partition(staged, day).write.mode("overwrite").partitionBy(day)
        rows.option("partitionOverwriteMode", "dynamic").parquet(path)
    for value in emptied:
        name = "__HIVE_DEFAULT_PARTITION__" if value is None else value.isoformat()
        nothing = spark.createDataFrame([], df.drop(day).schema)
        nothing.write.mode("overwrite").parquet(f"{path}/{day}={name}")
