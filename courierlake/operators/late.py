"""Merging of late arrivals into an event table that is partitioned by day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.operators.latest import latest_rows
from courierlake.session import scratch_path, setting
from courierlake.sources.lake import by_partition
from courierlake.sources.schemas import RAW_TABLES

DAY = "event_date"
KEY = RAW_TABLES["delivery_events"].key


def with_event_date(events: DataFrame) -> DataFrame:
    return events.withColumn(DAY, F.col("event_ts").cast("date"))


def merge_late_events(stored: DataFrame, arrived: DataFrame) -> DataFrame:
    """Latest row per key over stored and newly arrived events, whatever their age."""
    return latest_rows(stored.unionByName(arrived), KEY)


def touched_days(
    stored: DataFrame, arrived: DataFrame, as_of: dt.datetime, hours: int = 48
) -> DataFrame:
    """The days that a merge may change; NULL stands for events without a time.

    These are the days of the arrivals, every stored day that holds a key that
    arrives again, and the stored days of the last `hours`.
    """
    same_key = F.lit(True)
    for name in KEY:
        same_key = same_key & F.col(f"s.{name}").eqNullSafe(F.col(f"a.{name}"))
    again = stored.alias("s").join(arrived.select(*KEY).alias("a"), same_key, "left_semi")
    first_day = (as_of - dt.timedelta(hours=hours)).date()
    recent = stored.where(F.col(DAY) >= F.lit(first_day))
    return arrived.select(DAY).union(again.select(DAY)).union(recent.select(DAY)).distinct()


def reprocess_recent(
    table: str, arrived: DataFrame, as_of: dt.datetime, hours: int = 48
) -> None:
    """Merge `arrived` into the day-partitioned `table`; every arrival counts.

    Only the touched days are rewritten, `hours` widens them. The merge is
    written to the shared folder first and read back: the table is never read
    while it is overwritten, and a failed run can be repeated. A day whose
    rows all moved to another day is dropped, because dynamic overwrite leaves
    days without new rows alone.
    """
    spark = arrived.sparkSession
    stored = spark.table(table)
    arrived = with_event_date(arrived).select(*stored.columns)

    days_path = scratch_path(spark, "late-days")
    touched_days(stored, arrived, as_of, hours).write.parquet(days_path)
    days = spark.read.parquet(days_path).withColumnRenamed(DAY, "_day")
    affected = stored.join(days, F.col(DAY).eqNullSafe(F.col("_day")), "left_semi")

    staged_path = scratch_path(spark, "late-events")
    merge_late_events(affected, arrived).write.parquet(staged_path)
    staged = spark.read.schema(stored.schema).parquet(staged_path)

    # At most one row per touched day.
    kept = staged.select(F.col(DAY).alias("_kept")).distinct()
    emptied = days.join(kept, F.col("_day").eqNullSafe(F.col("_kept")), "left_anti")
    gone = [row["_day"] for row in emptied.collect()]

    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        rows = by_partition(staged.select(*stored.columns), DAY)
        rows.write.insertInto(table, overwrite=True)
    for day in gone:
        value = "NULL" if day is None else f"DATE'{day}'"
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({DAY} = {value})")
