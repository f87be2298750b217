"""Marts that follow late events: figures are stored by day, touched days made anew.

Each mart adds up what is stored per day of the orders: daily figures by city
and slot, by rider, and exact counts of preparation times by restaurant. A late
event changes the day of its order only, so a run reads the orders and events
of the touched days and rewrites those days' figures.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from courierlake.plans import marts
from courierlake.plans.staging import staged
from courierlake.plans.timeline import delivery_timeline, rider_daily
from courierlake.session import scratch_path
from courierlake.sources.schemas import schema_of
from courierlake.streaming import events
from courierlake.streaming.days import on_days, read_days, replace_days

DAY = events.DAY


def prep_daily(timeline: DataFrame) -> DataFrame:
    return marts.prep_time_counts(timeline, DAY)


# What is stored per day: how it is made, and its columns.
FIGURES: dict[str, tuple[Callable[[DataFrame], DataFrame], StructType]] = {
    "sla": (
        marts.sla_daily,
        schema_of(
            city="string",
            time_slot="string",
            total_orders="long",
            breached_orders="long",
            avg_delivery_time_minutes="double",
            avg_breach_minutes="double",
            order_date="date",
        ),
    ),
    "riders": (
        rider_daily,
        schema_of(
            rider_id="string",
            orders_delivered="long",
            late_deliveries="long",
            avg_delivery_time_minutes="double",
            order_date="date",
        ),
    ),
    "prep": (
        prep_daily,
        schema_of(restaurant_id="string", prep_us="long", orders="long", breached="long", order_date="date"),
    ),
}


def day_timeline(orders: DataFrame, store: events.EventStore, days: Iterable[dt.date | None]) -> DataFrame:
    """The timeline of the staged orders of `days`; `orders` should be partitioned by order_date."""
    days = list(days)
    spark = orders.sparkSession
    happened = staged("delivery_events", events.silver_events(spark, orders, store, days))
    return delivery_timeline(orders.where(on_days(DAY, days)), happened)


def refresh(orders: DataFrame, store: events.EventStore, path: str, days: Iterable[dt.date | None]) -> None:
    """Make the stored figures of `days` anew from their orders and events.

    The first build, and new orders, need the days of these orders as well.
    """
    days = list(days)
    if not days:
        return
    # Three figures are made of one timeline. A checkpoint would run its last
    # stage twice, once to count and once to write.
    made_of = day_timeline(orders, store, days)
    kept = scratch_path(orders.sparkSession, "timeline")
    made_of.write.parquet(kept)
    timeline = orders.sparkSession.read.schema(made_of.schema).parquet(kept)
    for name, (made, schema) in FIGURES.items():
        replace_days(made(timeline).select(*schema.names), f"{path}/{name}", DAY, days)


def figures(spark: SparkSession, path: str, name: str, days: Iterable[dt.date | None] | None = None) -> DataFrame:
    return read_days(spark, f"{path}/{name}", FIGURES[name][1], DAY, days)


def marts_of_figures(
    spark: SparkSession, path: str, restaurants: DataFrame, riders: DataFrame, as_of: dt.date | None = None
) -> dict[str, DataFrame]:
    """The delivery marts from the stored figures alone."""
    counts = (
        figures(spark, path, "prep")
        .groupBy("restaurant_id", "prep_us")
        .agg(F.sum("orders").alias("orders"), F.sum("breached").alias("breached"))
    )
    return {
        "mart_sla_breach_analysis": marts.sla_breaches_of_days(figures(spark, path, "sla")),
        "mart_rider_performance": marts.rider_performance_of_days(figures(spark, path, "riders"), riders, as_of),
        "mart_restaurant_prep_delays": marts.prep_delays_of_counts(counts, restaurants, as_of),
    }


def apply_arrivals(
    arrived: DataFrame, orders: DataFrame, store: events.EventStore, path: str, label: str
) -> list[dt.date | None]:
    """Merge arrived bronze events and refresh the figures of the days they touch; those days.

    Repeating a run changes nothing.
    """
    days = events.merge(arrived.sparkSession, arrived, orders, store, label)
    refresh(orders, store, path, days)
    return days
