"""Events out of order within an order, and weeks without all their days."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courierlake.functions.cleaning import EVENT_TYPES
from courierlake.functions.temporal import week_start


def flag_invalid_sequence(events: DataFrame) -> DataFrame:
    """Add `_dq_invalid_sequence`: the event before this one, by time, belongs
    to a later stage of the order.

    `events` holds one row per (order_id, event_type), as silver does, so an
    order has at most one row per known stage. Rows of unknown type have no
    stage and get a group of their own, which keeps every window group small;
    so do rows without an order id. Both are never flagged.
    """
    place = F.array_position(F.array(*map(F.lit, EVENT_TYPES)), F.col("event_type"))
    # The last three types are alternative endings, hence one shared stage.
    stage = F.when(place > 0, F.least(place, F.lit(len(EVENT_TYPES) - 2)))
    outsider = F.when(F.col("_stage").isNull(), F.col("event_type"))
    window = Window.partitionBy("order_id", outsider).orderBy(
        F.col("event_ts").asc_nulls_last(), F.col("_stage"), "event_type"
    )
    late = F.lag("_stage").over(window) > F.col("_stage")
    return (
        events.withColumn("_stage", stage)
        .withColumn("_dq_invalid_sequence", F.coalesce(late, F.lit(False)))
        .drop("_stage")
    )


def flag_partial_weeks(orders: DataFrame, days_in_week: int = 7) -> DataFrame:
    """Days with orders per week, and whether any day is missing."""
    days = F.count_distinct("order_date")
    return (
        orders.select(week_start("order_date").alias("week_start"), "order_date")
        .groupBy("week_start")
        .agg(days.alias("days_with_data"))
        .withColumn("is_partial_week", F.col("days_with_data") < days_in_week)
    )
